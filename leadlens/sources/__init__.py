"""Sources and sinks: event shards, lead snapshot history, training/stage/model tables."""
