"""Structured Streaming: lead scoring with the same transformations as training."""
