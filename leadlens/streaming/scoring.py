"""Score arriving leads as a stream, hot-swapping models when the registry changes.

``readStream`` over a folder of lead payload files → ``foreachBatch``: at most once per
``reload_interval_s`` (0 or less: never after the first load) the live registry is re-read; segments
whose live version changed are reloaded (a failing segment keeps its previous model). The versions of
a batch are stored by its id before it is scored and hold for its replays. Each batch is scored with
``score_batch`` — the exact batch path — and written with the model version used into a folder of its own, which
becomes part of the sink by an entry of the sink's commit log under the batch's number. Readers (``read_sink``) follow the
log: a half-written batch is never seen, and a replay of a committed batch writes nothing.
Stream output equals batch output for the same models.
"""
from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..operators import model as M
from ..operators import registry as RG
from ..session import hadoop_fs
from ..sources.commits import CommitLog

VERSIONS = "segment string, version string, path string"


class LiveModels:
    """Per-segment live bundles keyed by registry version, refreshed on a throttle."""

    def __init__(self, spark: SparkSession, registry_path: str, reload_interval_s: float = config.RELOAD_INTERVAL_S):
        self.spark = spark
        self.registry_path = registry_path
        self.interval = reload_interval_s
        self.bundles: dict[str, M.ModelBundle] = {}
        self.versions: dict[str, str] = {}
        self.paths: dict[str, str] = {}
        self._loaded: dict[str, M.ModelBundle] = {}
        self._last = float("-inf")

    def maybe_reload(self, force: bool = False) -> list[str]:
        now = time.monotonic()
        if not force and (not self.interval or self.interval <= 0 or now - self._last < self.interval):
            return []
        self._last = now
        reg = RG.read_registry(self.spark, self.registry_path)
        live = {r["segment"]: r for r in RG.latest_per_segment(reg, "live").collect()}
        changed = []
        for seg, r in live.items():
            if self.versions.get(seg) == r["version"]:
                continue
            try:
                self.bundles[seg] = self._bundle(r["path"], RG.registered_hash(r["meta"]))
                self.versions[seg], self.paths[seg] = r["version"], r["path"]
                changed.append(seg)
            except Exception as e:  # noqa: BLE001 — keep serving the previous model
                print(f"segment {seg}: bundle {r['path']} is unreadable, the one in use stays ({e})")
        return changed

    def _bundle(self, path: str, expected: str | None = None) -> M.ModelBundle:
        """A bundle by its path; bundles are written once, so those in use need no second load."""
        if path not in self._loaded:
            keep = set(self.paths.values())
            self._loaded = {p: b for p, b in self._loaded.items() if p in keep}
            self._loaded[path] = M.ModelBundle.load(self.spark, path, expected)
        return self._loaded[path]

    def for_batch(self, marker: str) -> tuple[dict[str, M.ModelBundle], dict[str, str]]:
        """Bundles and versions of one micro-batch. The first try stores what is live in ``marker``; a replay reads
        it and scores with the same models, whatever has been promoted since."""
        fs, p = hadoop_fs(self.spark, marker)
        if fs.exists(p):
            rows = self.spark.read.schema(VERSIONS).json(marker).collect()
            return {r["segment"]: self._bundle(r["path"]) for r in rows}, {r["segment"]: r["version"] for r in rows}
        self.maybe_reload()
        if not self.bundles:
            self.maybe_reload(force=True)
        rows = [(s, v, self.paths[s]) for s, v in sorted(self.versions.items())]
        out = fs.create(p, False)
        out.write(bytearray("\n".join(json.dumps(dict(zip(("segment", "version", "path"), r))) for r in rows), "utf-8"))
        out.close()
        return dict(self.bundles), dict(self.versions)


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """All committed batches, with ``batch_id``; None of them: an error, as the schema is not known."""
    entries = CommitLog(spark, sink_dir).entries()
    if not entries:
        raise FileNotFoundError(f"{sink_dir} has no committed batch")
    return spark.read.parquet(*[f"{sink_dir.rstrip('/')}/{e['add']}" for e in entries])


def commit_batch(spark: SparkSession, sink_dir: str, batch_id: int, data: str) -> bool:
    """Make a written folder the content of a batch, unless the batch has one."""
    return CommitLog(spark, sink_dir).put(batch_id, {"add": data, "batch_id": batch_id})


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint_dir: str,
                 live: LiveModels, keep: list[str], max_files_per_trigger: int | None = None,
                 processing_time: str | None = None):
    """Run the scoring stream. By default until the source is drained (``availableNow``);
    with ``processing_time`` (e.g. ``"1 minute"``) it keeps running and the handle is returned."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id in CommitLog(spark, sink_dir).numbers():
            return
        bundles, versions = live.for_batch(f"{sink_dir}/_versions/batch_id={batch_id}.json")
        scored = M.score_batch(batch, bundles, keep)
        ver = F.create_map(*[x for s, v in versions.items() for x in (F.lit(s), F.lit(v))]) if versions else None
        out = scored.withColumn(
            "model_version", F.try_element_at(ver, F.col("model_segment")) if ver is not None else F.lit(None).cast("string"))
        data = f"_data/{batch_id}-{uuid.uuid4().hex}"
        out.withColumn("batch_id", F.lit(batch_id)).write.parquet(f"{sink_dir}/{data}")
        commit_batch(spark, sink_dir, batch_id, data)

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return read_sink(spark, sink_dir)
