"""End-to-end command line: snapshot → build → train (tiny budget) → score, in-process."""
import datetime as dt
import tempfile

from pyspark.sql import functions as F

from leadlens.__main__ import main
from leadlens.operators import registry as RG
from leadlens.sources import events as EV
from leadlens.sources import fixtures as fx
from leadlens.streaming.scoring import read_sink

from conftest import SF_MID


def test_cli_build_train_score(spark):
    root = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    EV.write_event_shards(fx.event_shards(spark, SF_MID), f"{root}/shards")
    fx.lead_table(spark, SF_MID).write.parquet(f"{root}/leads")
    main(["snapshot", "--leads", f"{root}/leads", "--history", f"{root}/history", "--today", "2024-01-30"])
    main(["build", "--shards", f"{root}/shards", "--history", f"{root}/history", "--out", f"{root}/table",
          "--execution-date", "2024-01-31", "--maturity-days", "7"])
    table = spark.read.parquet(f"{root}/table")
    assert table.count() == 430
    main(["train", "--table", f"{root}/table", "--root", f"{root}/models", "--n-iter", "1", "--n-folds", "2",
          "--search-rounds", "2", "--max-rounds", "4", "--n-seeds", "1"])
    reg_path = f"{root}/models/registry"
    reg = RG.read_registry(spark, reg_path)
    assert reg.filter(F.col("stage") == "candidate").count() == 2
    if reg.filter(F.col("stage") == "live").count() == 0:  # nothing passed the gate: operator promotion
        RG.append_registry(spark, RG.manual_promote(reg, dt.datetime(2024, 2, 1)), reg_path)
    main(["score", "--input", f"{root}/table", "--registry", reg_path, "--out", f"{root}/scored"])
    scored = spark.read.parquet(f"{root}/scored")
    assert scored.count() == 430
    main(["stream", "--source", f"{root}/table", "--registry", reg_path, "--sink", f"{root}/sink",
          "--checkpoint", f"{root}/ckpt", "--reload-interval", "0"])
    streamed = read_sink(spark, f"{root}/sink")
    key = lambda r: (r["ld_mcs_id"], round(r["score"], 12))
    assert sorted(map(key, streamed.collect())) == sorted(map(key, scored.collect()))
