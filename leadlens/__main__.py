"""Command line: the reference's jobs as Spark applications.

    python -m leadlens snapshot  --leads L --history H [--today D]
    python -m leadlens build     --shards S --history H --out T [--execution-date D] [--maturity-days N]
    python -m leadlens train     --table T --root R [--n-iter …] [--seed …]
    python -m leadlens score     --input I --registry R --out O
    python -m leadlens stream    --source I --registry R --sink O --checkpoint C

Paths are parquet folders (shards partitioned by ``suffix``, history by ``execution_date``).
``--master`` defaults to the cluster's; ``local[*]`` for a single machine.
"""
from __future__ import annotations

import argparse
import datetime as dt
import sys

from . import config


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _session(master: str | None):
    from pyspark.sql import SparkSession

    from .session import ensure_session
    b = SparkSession.builder.appName("leadlens").config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    return ensure_session(b.getOrCreate())


def cmd_snapshot(spark, a) -> None:
    from .sources import leads as L
    today = a.today or dt.datetime.now(dt.timezone.utc).date()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) if a.today is None else dt.datetime(today.year, today.month, today.day)
    L.append_snapshot(spark, L.read_lead_table(spark, a.leads), a.history, today, now)


def cmd_build(spark, a) -> None:
    from .operators.training import build_training_dag
    from .sources.events import event_bounds, read_event_shards
    from .sources.leads import read_history
    from .sources.sinks import write_table
    p = config.RunParams(execution_date=a.execution_date or dt.datetime.now(dt.timezone.utc).date(),
                         maturity_days=a.maturity_days, strict_params=not a.first_param, upper_bound=a.upper_bound)
    span = event_bounds(spark, a.shards, p.execution_date, p.lookback_months, p.upper_bound)
    d = build_training_dag(read_event_shards(spark, a.shards), read_history(spark, a.history), p, span)
    write_table(d.table, a.out)


def cmd_train(spark, a) -> None:
    from .operators.model import TrainBudget
    from .plans.training_run import train_segments
    budget = TrainBudget(n_iter=a.n_iter, n_folds=a.n_folds, search_rounds=a.search_rounds,
                         max_rounds=a.max_rounds, n_seeds=a.n_seeds, seed=a.seed)
    res = train_segments(spark, spark.read.parquet(a.table), f"{a.root}/bundles", f"{a.root}/registry", budget,
                         now=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), table_ref=a.table,
                         data_version=a.data_version)
    for r in res.decisions.collect():
        print(f"{r['segment']}: {'PROMOTED' if r['promoted'] else 'kept live'} — {r['reason']}")


def cmd_score(spark, a) -> None:
    from .operators import model as M
    from .operators import registry as RG
    bundles, _ = RG.load_live_models(spark, RG.read_registry(spark, a.registry))
    if not bundles:
        sys.exit("no live model in the registry")
    M.score_batch(spark.read.parquet(a.input), bundles, a.keep).write.mode("overwrite").parquet(a.out)


def cmd_stream(spark, a) -> None:
    from .streaming.scoring import LiveModels, score_stream
    schema = spark.read.parquet(a.source).schema
    live = LiveModels(spark, a.registry, reload_interval_s=a.reload_interval)
    q = score_stream(spark, a.source, schema, a.sink, a.checkpoint, live, a.keep,
                     processing_time=a.processing_time)
    if a.processing_time:
        q.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="leadlens")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("snapshot", help="append today's lead snapshot to the history")
    s.add_argument("--leads", required=True)
    s.add_argument("--history", required=True)
    s.add_argument("--today", type=_date)
    s = sub.add_parser("build", help="build the labelled training table")
    s.add_argument("--shards", required=True)
    s.add_argument("--history", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--execution-date", type=_date)
    s.add_argument("--maturity-days", type=int, default=config.MATURITY_DAYS)
    s.add_argument("--first-param", action="store_true", help="take the first of a repeated event parameter, not an error")
    s.add_argument("--upper-bound", action="store_true", help="read no shard after the execution date")
    s = sub.add_parser("train", help="train, evaluate, register and gate one model per segment")
    s.add_argument("--table", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--data-version", default="")
    s.add_argument("--n-iter", type=int, default=config.N_ITER)
    s.add_argument("--n-folds", type=int, default=config.N_FOLDS)
    s.add_argument("--search-rounds", type=int, default=config.SEARCH_ROUNDS)
    s.add_argument("--max-rounds", type=int, default=config.MAX_ROUNDS)
    s.add_argument("--n-seeds", type=int, default=config.N_SEEDS)
    s.add_argument("--seed", type=int, default=42)
    s = sub.add_parser("score", help="score a folder of leads with the live models")
    s.add_argument("--input", required=True)
    s.add_argument("--registry", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--keep", nargs="*", default=["ld_mcs_id"])
    s = sub.add_parser("stream", help="score leads as they arrive in a folder")
    s.add_argument("--source", required=True)
    s.add_argument("--registry", required=True)
    s.add_argument("--sink", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--keep", nargs="*", default=["ld_mcs_id"])
    s.add_argument("--processing-time", default=None)
    s.add_argument("--reload-interval", type=float, default=config.RELOAD_INTERVAL_S)
    a = ap.parse_args(argv)
    spark = _session(a.master)
    {"snapshot": cmd_snapshot, "build": cmd_build, "train": cmd_train, "score": cmd_score,
     "stream": cmd_stream}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
