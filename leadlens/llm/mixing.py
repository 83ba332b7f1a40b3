"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: every source has a weight; together the sources are to give ``share`` times the words of
the corpus, none more than ``epochs`` times its own, and what a capped source cannot take is shared
again by weight until no source is above its cap (a few aggregates over one row per source).

Seats are equal numbers of words: ``block_words``, or fewer where that is more than an eighth of the smallest target. The house has as many
seats as all targets make up, and they go to the sources by highest quotients ``target / (2 s + 1)`` up to each source's
cap: the divisor that fills the house is narrowed by a few aggregates over one row per source, and the last seats are
dealt by rank of their quotients. A source is dealt over shards by a hash of its rows, about ``shard_rows`` rows each, and
its seats go to the shards by highest quotients of their words, again with the cap. In a shard the texts stand in a seeded
order as one run of words: its seats, in words, give as many whole passes as they hold, counted by the words of the run,
and the rest falls on blocks at equal steps from a seeded start (blocks of ``block_words`` words, in small shards of one
word), so the number of words that each document gives is arithmetic on its place in the run.

Only (key, source, size, hash) rows are stored and shuffled, never texts; a hot source is spread
over its shards. Results depend on the rows and the seed alone, so reruns agree.

Edge cases: null and empty texts have size 0 and give 0; a null source is a source of its own and
comes last; rows with equal id and text are interchangeable and each gets a place of its own; an
empty table gives an empty result; an input column cannot clash, only id, text and source are read.
"""
from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import running_totals
from .common import WORD, by_value, free_names, small_batches, stored

by_value(__name__)


@dataclass(frozen=True)
class Mix:
    weights: tuple = (3, 1, 2)   # by source in code-point order, repeating
    share: float = 1.5           # words of the mix per word of the corpus
    epochs: int = 2              # no source beyond so many times its words
    block_words: int = 16
    shard_rows: int = 5000
    seed: int = 17


def targets(sources: DataFrame, spec: Mix) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per source (``source``, ``source_size``)."""
    ranked = running_totals(sources, [F.col("source").asc_nulls_last()]).frame
    weights = F.array(*[F.lit(float(w)) for w in spec.weights])
    src = stored(ranked.withColumn("weight", F.element_at(weights, ((F.col("rank") - 1) % len(spec.weights) + 1)
                                                          .cast("int"))).drop("rank"), "mix-sources")
    cap = (F.col("source_size") * spec.epochs).cast("double")
    goal = float(src.agg(F.sum("source_size")).first()[0] or 0) * spec.share
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else cap < F.col("weight") * F.lit(level)
        r = src.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
                    F.count(F.when(full, 1))).first()
        if r[2] == capped or not r[1]:
            break
        capped, level = r[2], (goal - r[0]) / r[1]
    level = float("inf") if level is None else level
    return src.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)) if goal else F.lit(0.0))


def seat_words(goal: DataFrame, spec: Mix) -> int:
    """Words of a seat: no more than an eighth of the smallest positive target, as its cap need not be whole seats."""
    least = goal.agg(F.min(F.when(F.col("target") > 0, F.col("target")))).first()[0]
    return max(1, min(spec.block_words, int(least / 8) if least else spec.block_words))


def seated(goal: DataFrame, seat: int, spec: Mix, rounds: int = 3, tries: int = 32) -> DataFrame:
    """Adds ``seats``: the house that all targets fill, dealt by highest quotients with each source's cap in seats."""
    cap = F.ceil(F.col("source_size") * spec.epochs / F.lit(seat))
    at = lambda d: F.least(cap, F.floor(F.col("target") / F.lit(float(d)) + 0.5))
    total = goal.agg(F.sum("target")).first()[0] or 0.0
    house = int(total / seat + 0.5)
    if not house:
        return goal.withColumn("seats", F.lit(0).cast("long"))
    low, high, dealt = seat / 4.0, seat * 4.0, -1  # divisors that deal too many (or all that caps allow), and too few
    for _ in range(rounds):
        ds = [low * (high / low) ** (k / (tries + 1)) for k in range(1, tries + 1)]
        sums = goal.agg(*[F.sum(at(d)).alias(f"s{k}") for k, d in enumerate(ds)]).first()
        fits = [d for d, s in zip(ds, sums) if s <= house]
        low, high = max([d for d, s in zip(ds, sums) if s > house], default=low), min(fits, default=high)
        dealt = max([s for s in sums if s <= house], default=-1)
        if dealt == house:
            break
    sure = at(high)
    dealt = int(goal.agg(F.sum(sure)).first()[0])
    if dealt == house:
        return goal.withColumn("seats", sure)
    # seats between the two divisors, by rank of their quotients
    more = goal.select("source", "target", F.explode(F.when(at(low) > sure, F.sequence(sure, at(low) - 1))).alias("s"))
    quotient = F.col("target") / (2 * F.col("s") + 1)
    won = more.orderBy(quotient.desc(), F.col("source").asc_nulls_last()).limit(house - dealt)
    won = won.groupBy(F.col("source").alias("w_source")).agg(F.count(F.lit(1)).alias("won"))
    return (goal.withColumn("_sure", sure).join(won, F.col("source").eqNullSafe(F.col("w_source")), "left")
            .withColumn("seats", F.col("_sure") + F.coalesce("won", F.lit(0))).drop("_sure", "w_source", "won"))


def highest_quotients(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Sainte-Lague seats for ``votes``; a party at its cap gets no more. Ties go to the earlier party."""
    won = np.zeros(len(votes), dtype=np.int64)
    total = float(votes.sum())
    if total > 0 and seats > 0:  # a sure lower bound, then the last seats one by one
        won = np.minimum(np.maximum(np.floor(votes * (max(0, seats - len(votes)) / total)).astype(np.int64) - 1, 0), caps)
    heap = [(-v / (2 * s + 1), i) for i, (v, s, c) in enumerate(zip(votes, won, caps, strict=True)) if s < c and v > 0]
    heapq.heapify(heap)
    left = seats - int(won.sum())
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        won[i] += 1
        left -= 1
        if won[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * won[i] + 1), i))
    return won


def shard_quotas(shards: pd.DataFrame, epochs: int, seat: int) -> pd.DataFrame:
    """Seats of one source dealt to its shards (one row per shard)."""
    s = shards.sort_values("shard")
    caps = -(-s["words"].to_numpy(dtype=np.int64) * epochs // seat)
    won = highest_quotients(s["words"].to_numpy(dtype=float), int(s["seats"].iloc[0]), caps)
    return s.assign(quota=won)[["source", "shard", "words", "block", "quota"]]


def mix(docs: DataFrame, spec: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """Per row: id, size, source_size, target, taken (and the row's ``row_hash`` and ``source``)."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
                              F.xxhash64(F.lit(spec.seed), id_col, text_col).alias("row_hash")), "mix-rows")
    src = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")),
                  spec)
    src = stored(src, "mix-goals")
    seat = seat_words(src, spec)
    src = stored(seated(src, seat, spec).withColumn("n_shards", F.ceil(F.col("n_rows") / spec.shard_rows)), "mix-targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    s = src.select(F.col("source").alias("s_source"), "source_size", "target", "n_shards", "seats")
    placed = (rows.join(s, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
              .withColumn("shard", F.pmod("row_hash", F.col("n_shards"))))
    shards = (placed.groupBy("source", "shard", "seats").agg(F.sum("size").alias("words"))
              .withColumn("block", F.when(F.col("words") >= 64 * spec.block_words, spec.block_words).otherwise(1).cast("long")))
    epochs = spec.epochs
    quotas = (shards.groupBy("source").applyInPandas(lambda pdf: shard_quotas(pdf, epochs, seat),
                                                     "source string, shard long, words long, block long, quota long"))
    give = F.least(F.col("quota") * seat, F.col("words") * epochs)
    quotas = quotas.withColumn("blocks", F.ceil(F.col("words") / F.col("block"))).withColumn("give", give)
    quotas = quotas.withColumn("passes", F.expr("give div greatest(words, 1)"))
    extra = F.least(F.floor((F.col("give") - F.col("passes") * F.col("words")) / F.col("block") + 0.5), F.col("blocks"))
    start = F.pmod(F.xxhash64(F.lit(spec.seed), "source", "shard"), F.greatest(F.col("blocks"), F.lit(1)))
    quotas = stored(quotas.withColumns({"extra": extra, "start": start}).drop("give"), "mix-quotas")
    w = (Window.partitionBy("source", "shard").orderBy("row_hash", "doc_id")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = placed.withColumn("end", F.sum("size").over(w)).withColumn("begin", F.col("end") - F.col("size"))
    q = quotas.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "block", "blocks", "passes",
                      "extra", "start")
    run = run.join(q, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")))
    b = F.col("block")
    picked = lambda k: F.expr(f"(({k}) * extra + start) div greatest(blocks, 1)")
    run = run.withColumns({"first": F.expr("begin div block"), "last": F.expr("greatest(end - 1, begin) div block")})
    head = (picked("first + 1") - picked("first")) * (F.least(F.col("end"), (F.col("first") + 1) * b) - F.col("begin"))
    inner = F.when(F.col("last") > F.col("first"), (picked("last") - picked("first + 1")) * b).otherwise(0)
    tail = F.when(F.col("last") > F.col("first"),
                  (picked("last + 1") - picked("last")) * (F.col("end") - F.col("last") * b)).otherwise(0)
    taken = F.when(F.col("size") > 0, F.col("passes") * F.col("size") + head + inner + tail).otherwise(F.lit(0))
    places = F.filter(F.sequence("first", "last"), lambda k: F.expr("extra > 0") & (
        F.floor(((k + 1) * F.col("extra") + F.col("start")) / F.col("blocks"))
        > F.floor((k * F.col("extra") + F.col("start")) / F.col("blocks"))))
    parts = F.transform(places, lambda k: F.struct((F.greatest(k * b, F.col("begin")) - F.col("begin")).alias("a"),
                                                   (F.least((k + 1) * b, F.col("end")) - F.col("begin")).alias("b")))
    return run.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source",
                      "row_hash", "passes", parts.alias("parts"))


def words_at(texts: pd.Series, parts: pd.Series) -> pd.Series:
    """The stretches of each text from word ``a`` to before word ``b``, one a line; neighbouring ones in one piece."""
    out = []
    for text, spans in zip(texts, parts):
        at = [(m.start(), m.end()) for m in re.finditer(WORD, text)]
        joined: list = []
        for s in spans:
            if joined and joined[-1][1] == s["a"]:
                joined[-1][1] = s["b"]
            else:
                joined.append([s["a"], s["b"]])
        out.append("\n".join(text[at[a][0]:at[b - 1][1]] for a, b in joined))
    return pd.Series(out, dtype=object)


def mixed(docs: DataFrame, spec: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", length_col: str | None = None) -> DataFrame:
    """The mix itself: a row for each whole pass over a text and one for the blocks of the last, partial pass, with
    the columns of ``docs`` (``length_col`` holds the characters of the text). Rows that repeat id and text get the
    same share each; a text of no words gives nothing to a mix and goes."""
    columns = docs.columns
    id_, hash_, passes, spans, row, turn = free_names(columns, 6)
    places = mix(small_batches(docs), spec, id_col, text_col, source_col)
    places = places.filter("taken > 0").groupBy("doc_id", "row_hash").agg(F.max(F.struct("passes", "parts")).alias("p"))
    places = places.select(F.col("doc_id").alias(id_), F.col("row_hash").alias(hash_),
                           F.col("p.passes").alias(passes), F.col("p.parts").alias(spans))
    hashed = docs.withColumn(row, F.xxhash64(F.lit(spec.seed), id_col, text_col))
    both = hashed.join(places, (F.col(row) == F.col(hash_)) & F.col(id_col).eqNullSafe(F.col(id_)))
    copies = F.when(F.col(passes) > 0, F.sequence(F.lit(1).cast("long"), F.col(passes)))
    none = F.array().cast("array<bigint>")
    turns = F.concat(F.coalesce(copies, none), F.when(F.size(spans) > 0, F.array(F.lit(0).cast("long"))).otherwise(none))
    both = both.withColumn(turn, F.explode(turns))
    whole = both.filter(F.col(turn) > 0).select(*columns)
    part = both.filter(F.col(turn) == 0).withColumn(text_col, F.pandas_udf(words_at, "string")(F.col(text_col), F.col(spans)))
    if length_col:
        part = part.withColumn(length_col, F.length(text_col).cast(dict(docs.dtypes)[length_col]))
    return whole.unionByName(part.select(*columns))
