"""Distributed ranking primitives and rank-based model metrics.

Core primitive — exact global order statistics without a single-partition window:

1. ``repartitionByRange`` on (group, order…) — AQE sizes the partition count — so every
   partition holds one contiguous slice of the total order (a tiebreak id makes keys unique, so a hot score or a hot
   group is split across partitions instead of landing in one task);
2. sort inside partitions and number rows locally
   (``monotonically_increasing_id`` keeps the record index in its low 33 bits);
3. checkpoint into the shared folder, so both consumers below see identical rows even if
   executors are lost;
4. per-(partition, group) counts/sums — at most ``partitions + groups`` rows — give each
   partition its offset by a running sum over them; they are broadcast (bounded by construction).

Rank-only consumers stay JVM-side with no further shuffle; running sums add one
hash-exchange of the (already aggregated) frame for the in-partition cumulative window.
Metrics that only need the score order (AP, ROC AUC, ROC points) work on the per-distinct-
score aggregate, never on per-row data. Cutoffs, decile bins and confusion counts need no rank:
their quantiles come from a distributed selection (``select_at``) that moves no row.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config
from ..session import durable

LOW33 = (1 << 33) - 1


@dataclass
class Ranked:
    """A frame with a 1-based ``rank`` inside each group plus per-group row counts."""
    frame: DataFrame
    group: list[str]
    counts: dict[tuple, int]
    score: str | None = None  # the ordering column of a distinct-score curve

    def n(self, g: tuple = ()) -> int:
        return self.counts.get(g, 0)


def running_totals(df: DataFrame, order: list[Column], group: list[str] | None = None,
                   sums: list[str] | None = None, rank_col: str = "rank",
                   num_partitions: int | None = None) -> Ranked:
    """Exact global row number (and running sums of ``sums``) in ``order`` within ``group``.

    ``order`` must be a total order (end it with a unique id) for a deterministic result.
    ``group`` is of low cardinality (segments, features): the offset table has at most
    ``partitions + groups`` rows, and one total per group comes back to the caller. Running sums are inclusive and named ``cum_<col>``.
    """
    group, sums = list(group or []), list(sums or [])
    spark = df.sparkSession
    keys = [F.col(g) for g in group] + list(order)
    # Without an explicit count AQE may merge adjacent ranges (small inputs → few tasks); the
    # partition id is read after the exchange, so merged ranges stay contiguous slices.
    parted = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    ranged = (parted.sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(LOW33))))
    ranged = durable(ranged)
    # one row per (partition, group): where the group starts in the partition and what came before it
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = (ranged.groupBy("_pid", *group)
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"),
                  *[F.coalesce(F.sum(F.col(s)), F.lit(0)).alias(f"_s_{s}") for s in sums]))
    before = lambda c, kind: F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast(kind)
    types = dict(df.dtypes)
    kind_of = {s: "bigint" if types[s] in ("tinyint", "smallint", "int", "bigint") else "double" for s in sums}
    o = durable(stats.select(F.col("_pid").alias("_o_pid"), *[F.col(g).alias(f"_o_{g}") for g in group], "_first", "_n",
                             before("_n", "bigint").alias("_off"),
                             *[before(f"_s_{s}", kind_of[s]).alias(f"_off_{s}") for s in sums]))
    totals = o.groupBy(*[F.col(f"_o_{g}").alias(g) for g in group]).agg(F.sum("_n").alias("_n")).collect()
    counts = {tuple(r[c] for c in group): int(r["_n"]) for r in totals if r["_n"] is not None}
    cond = F.col("_pid") == F.col("_o_pid")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    j = ranged.join(F.broadcast(o.drop("_n")), cond, "inner")  # at most partitions + groups rows
    rank = F.col("_off") + (F.col("_pos") - F.col("_first")) + F.lit(1)
    out = j.withColumn(rank_col, rank)
    if sums:
        w = (Window.partitionBy("_pid", *group).orderBy("_pos")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = out.withColumns({f"cum_{s}": F.col(f"_off_{s}") + F.sum(F.col(s)).over(w) for s in sums})
    drop = ["_pid", "_pos", "_first", "_off", "_o_pid"] + [f"_o_{g}" for g in group] + [f"_off_{s}" for s in sums]
    return Ranked(out.drop(*drop), group, counts)


def rank_by_score(scored: DataFrame, score: str = "score", id_col: str = "id",
                  group: list[str] | None = None, num_partitions: int | None = None) -> Ranked:
    """Stable descending score order; ties resolved by ascending id."""
    return running_totals(scored, [F.col(score).desc(), F.col(id_col).asc()], group, num_partitions=num_partitions)


# ----------------------------------------------------------------------------- helpers

def py_round(x: float) -> int:
    """Python's ``round`` (half to even) as an int."""
    return int(round(x))


def per_group(values: dict[tuple, object], group: list[str], dtype: str = "double") -> Column:
    """A literal value chosen by the row's group (bounded: one entry per group)."""
    if not group:
        v = values.get((), None)
        return F.lit(v).cast(dtype)
    if len(group) != 1:
        raise ValueError("metrics support at most one group column")
    items = [x for g, v in values.items() for x in (F.lit(g[0]), F.lit(v).cast(dtype))]
    if not items:
        return F.lit(None).cast(dtype)
    return F.try_element_at(F.create_map(*items), F.col(group[0]))


def _np_lerp(a: float, b: float, t: float) -> float:
    diff = b - a
    return b - diff * (1 - t) if t >= 0.5 else a + diff * t


#: rows of open intervals that may come to the driver in the last step of a selection
SELECT_ROWS = 10_000


def _grid(fractions: set[float], width: float = 1 / 2000) -> list[float]:
    """Percentages around each wanted one, close enough that what lies between holds about a thousandth of the rows."""
    around = {min(1.0, max(0.0, f + d)) for f in fractions for d in (-width, 0.0, width)}
    return sorted(around | {0.0, 1.0})


def select_at(df: DataFrame, value: str, positions: dict[tuple, set[int]], counts: dict[tuple, int],
              group: list[str] | None = None, finish_rows: int = SELECT_ROWS) -> dict[tuple, dict[int, float]]:
    """Exact values at 0-based ascending ``positions`` of each group, without sorting or moving its rows.

    A round has two passes with partial aggregates: sketch quantiles of the open intervals give pivots (observed values),
    then the rows equal to each pivot and between neighbours are counted exactly. A position that falls on a pivot is done;
    for the others the interval between two pivots is open in the next round, about a thousandth of it. When no more
    than ``finish_rows`` rows are open, these are fetched. The sketch only chooses pivots, so results are exact whatever
    its error, and every round leaves out its pivots, so the rounds end; a hot value is a pivot at the latest when its
    neighbours are.
    """
    group = list(group or [])
    found: dict[tuple, dict[int, float]] = {g: {} for g in counts}
    # open intervals: group → [(low, high, rows at or below low, rows inside, wanted positions)], ends exclusive
    todo = {g: [(None, None, 0, counts[g], set(ps))] for g, ps in positions.items() if ps and counts.get(g)}
    x = F.col(value).cast("double")
    while todo:
        flat = [(g, *interval) for g, parts in sorted(todo.items(), key=repr) for interval in parts]

        def inside(g, low, high):
            cond = x.isNotNull() & ~F.isnan(x)
            for i, c in enumerate(group):
                cond = cond & F.col(c).eqNullSafe(F.lit(g[i]))
            cond = cond if low is None else cond & (x > F.lit(low))
            return cond if high is None else cond & (x < F.lit(high))

        which = F.coalesce(*[F.when(inside(g, lo, hi), F.lit(i)) for i, (g, lo, hi, *_) in enumerate(flat)])
        rows = df.select(which.alias("_i"), x.alias("_x")).filter(F.col("_i").isNotNull())
        last = sum(n for *_, n, _ in flat) <= finish_rows
        if last:
            held: dict[int, list[float]] = {}
            for r in rows.collect():
                held.setdefault(r["_i"], []).append(r["_x"])
            for i, (g, _, _, below, _, wanted) in enumerate(flat):
                ordered = sorted(held.get(i, []))
                found[g].update({p: ordered[p - below] for p in wanted})
            return found
        fractions = {(p - below + 0.5) / n for _, _, _, below, n, wanted in flat for p in wanted}
        sketch = rows.groupBy("_i").agg(F.percentile_approx("_x", _grid(fractions), 10_000).alias("q")).collect()
        pivots = {r["_i"]: sorted(set(r["q"])) for r in sketch}
        mine = F.try_element_at(F.create_map(*[c for i, q in pivots.items() for c in (F.lit(i), F.array(*[F.lit(v) for v in q]))]),
                                F.col("_i"))
        # 2j: between the pivots j - 1 and j, 2j + 1: equal to pivot j
        slot = F.size(F.filter(mine, lambda p: p < F.col("_x"))) + F.size(F.filter(mine, lambda p: p <= F.col("_x")))
        sizes: dict[int, dict[int, int]] = {}
        for r in rows.groupBy("_i", slot.alias("_s")).agg(F.count(F.lit(1)).alias("n")).collect():
            sizes.setdefault(r["_i"], {})[r["_s"]] = r["n"]
        todo = {}
        for i, (g, low, high, below, _, wanted) in enumerate(flat):
            at, edges = below, [low, *pivots[i], high]
            for s in range(2 * len(pivots[i]) + 1):
                n = sizes[i].get(s, 0)
                here = {p for p in wanted if at <= p < at + n}
                if here and s % 2:
                    found[g].update({p: edges[s // 2 + 1] for p in here})
                elif here:
                    todo.setdefault(g, []).append((edges[s // 2], edges[s // 2 + 1], at, n, here))
                at += n
    return found


def select_quantiles(df: DataFrame, score: str, probs: list[float], group: list[str] | None = None,
                     finish_rows: int = SELECT_ROWS) -> dict[tuple, list[float]]:
    """Linear-interpolated quantiles (numpy's default) per group by distributed selection.

    ``group`` is of low cardinality. Scores that are null or NaN have no place in the order and are left out; a group without others has no entry.
    """
    group = list(group or [])
    x = F.col(score).cast("double")
    seen = df.filter(x.isNotNull() & ~F.isnan(x)).groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).collect()
    counts = {tuple(r[c] for c in group): int(r["_n"]) for r in seen if r["_n"]}
    plan: dict[tuple, list[tuple[int, int, float]]] = {}
    for g, n in counts.items():
        heights = [q * (n - 1) for q in probs]
        plan[g] = [(math.floor(h), min(math.floor(h) + 1, n - 1), h - math.floor(h)) for h in heights]
    want = {g: {p for lo, hi, _ in pts for p in (lo, hi)} for g, pts in plan.items()}
    val = select_at(df, score, want, counts, group, finish_rows)
    return {g: [_np_lerp(val[g][lo], val[g][hi], t) if hi != lo else val[g][lo] for lo, hi, t in pts] for g, pts in plan.items()}


# ----------------------------------------------------------------------------- metrics

def distinct_score_curve(scored: DataFrame, score: str = "score", y: str = config.TARGET,
                         group: list[str] | None = None, num_partitions: int | None = None) -> Ranked:
    """Per distinct score (descending): rows ``n_s``, positives ``pos_s`` and the running
    totals ``cum_n_s`` = rows with score ≥ s, ``cum_pos_s`` = positives with score ≥ s."""
    group = list(group or [])
    d = scored.groupBy(*group, score).agg(F.count(F.lit(1)).alias("n_s"),
                                          F.sum(F.col(y).cast("long")).alias("pos_s"))
    curve = running_totals(d, [F.col(score).desc()], group, sums=["n_s", "pos_s"], rank_col="k",
                           num_partitions=num_partitions)
    curve.score = score
    return curve


def _totals(curve: Ranked) -> DataFrame:
    return curve.frame.groupBy(*curve.group).agg(F.sum("n_s").alias("n"), F.sum("pos_s").alias("p"))


def average_precision(curve: Ranked) -> DataFrame:
    """Σ over distinct scores of ΔRecall × Precision (step-wise, no interpolation)."""
    f = _with_totals(curve)
    term = F.try_divide(F.col("pos_s"), F.col("p")) * F.try_divide(F.col("cum_pos_s"), F.col("cum_n_s"))
    return f.groupBy(*curve.group).agg(F.when(F.max("p") > 0, F.sum(term)).alias("average_precision"))


def _with_totals(curve: Ranked) -> DataFrame:
    """Attach per-group totals ``n``, ``p`` as literals (one value per group, bounded)."""
    tot = {g: r for g, r in _group_totals(curve).items()}
    return curve.frame.withColumns({
        "n": per_group({g: v[0] for g, v in tot.items()}, curve.group, "double"),
        "p": per_group({g: v[1] for g, v in tot.items()}, curve.group, "double"),
    })


def _group_totals(curve: Ranked) -> dict[tuple, tuple[float, float]]:
    rows = _totals(curve).collect()
    return {tuple(r[g] for g in curve.group): (float(r["n"]), float(r["p"] or 0)) for r in rows}


def roc_auc(curve: Ranked) -> DataFrame:
    """Tie-aware ROC AUC (trapezoid over distinct scores = Mann-Whitney with ½ for ties)."""
    f = _with_totals(curve)
    neg = F.col("n") - F.col("p")
    term = (F.col("n_s") - F.col("pos_s")) * (F.lit(2) * F.col("cum_pos_s") - F.col("pos_s"))
    auc = F.try_divide(F.sum(term), F.lit(2.0) * F.max("p") * F.max(neg))
    return f.groupBy(*curve.group).agg(F.when((F.max("p") > 0) & (F.max(neg) > 0), auc).alias("roc_auc"))


def roc_points(curve: Ranked, max_points: int = config.ROC_POINTS) -> DataFrame:
    """ROC curve: corner points only (collinear ones dropped), a (0, 0) start with threshold
    clamped to 1.0, then down-sampled to ``max_points`` by truncated linear indices."""
    spark = curve.frame.sparkSession
    g = curve.group
    f = _with_totals(curve).select(*g, "k", F.col(curve.score).alias("threshold"),
                                   (F.col("cum_n_s") - F.col("cum_pos_s")).alias("fps"),
                                   F.col("cum_pos_s").alias("tps"), "n", "p", "n_s", "pos_s")
    # a point's own step is its row's counts, so a corner shows by the counts of the next row alone
    nxt = f.select(*g, (F.col("k") - 1).alias("k"), F.col("n_s").alias("n_next"), F.col("pos_s").alias("pos_next"))
    kmax = per_group(dict(curve.counts), g, "long")
    j = f.join(nxt, g + ["k"], "left")
    corner = (F.col("pos_next") != F.col("pos_s")) | ((F.col("n_next") - F.col("pos_next")) != (F.col("n_s") - F.col("pos_s")))
    small = kmax <= 2
    kept = j.filter((F.col("k") == 1) | (F.col("k") == kmax) | small | corner)
    # rank kept points inside each group; index 0 is the (0, 0) start point
    rk = running_totals(kept.select(*g, "k", "threshold", "fps", "tps", "n", "p"), [F.col("k").asc()], g,
                        rank_col="j")
    neg = F.col("n") - F.col("p")
    pts = rk.frame.select(*g, "j", "threshold", F.try_divide(F.col("fps"), neg).alias("fpr"),
                          F.try_divide(F.col("tps"), F.col("p")).alias("tpr"))
    start_rows = [(*key, 0, 1.0, 0.0, 0.0) for key in rk.counts]
    schema = ", ".join([f"`{c}` {dict(curve.frame.dtypes)[c]}" for c in g] + ["j bigint", "threshold double", "fpr double", "tpr double"])
    allp = pts.unionByName(spark.createDataFrame(start_rows, schema))
    keep_idx = {}
    for key, m in rk.counts.items():
        L = m + 1
        keep_idx[key] = sorted(set(np.linspace(0, L - 1, max_points).astype(int).tolist())) if L > max_points else None
    cond = None
    for key, idx in keep_idx.items():
        c = F.lit(True) if idx is None else F.col("j").isin(idx)
        for i, gc in enumerate(g):
            c = c & F.col(gc).eqNullSafe(F.lit(key[i]))
        cond = c if cond is None else cond | c
    return allp.filter(cond if cond is not None else F.lit(False)).withColumnRenamed("j", "point")


def band_edges(n: int, uppers: list[int]) -> list[tuple[int, int, int, int]]:
    """(prev %, upper %, lo, hi) rank slices with Python (half-even) rounding."""
    out, prev = [], 0
    for up in uppers:
        out.append((prev, up, py_round(prev / 100 * n), py_round(up / 100 * n)))
        prev = up
    return out


def band_rates(rk: Ranked, y: str = config.TARGET, uppers: list[int] | None = None) -> DataFrame:
    """Per band (rank slice): rows, positives; one aggregate with per-group literal edges."""
    uppers = uppers or config.band_uppers()
    grades = config.canonical_grades()
    aggs = []
    for i, _ in enumerate(uppers):
        lo = per_group({g: band_edges(n, uppers)[i][2] for g, n in rk.counts.items()}, rk.group, "long")
        hi = per_group({g: band_edges(n, uppers)[i][3] for g, n in rk.counts.items()}, rk.group, "long")
        inb = (F.col("rank") > lo) & (F.col("rank") <= hi)
        aggs += [F.count_if(inb).alias(f"_n{i}"), F.sum(F.when(inb, F.col(y).cast("long")).otherwise(0)).alias(f"_p{i}")]
    agg = rk.frame.groupBy(*rk.group).agg(*aggs, F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("p"))
    stack = ", ".join(f"'{grades[i]}', {i}, {uppers[i - 1] if i else 0}, {up}, _n{i}, _p{i}" for i, up in enumerate(uppers))
    return agg.selectExpr(*[f"`{g}`" for g in rk.group], "n", "p",
                          f"stack({len(uppers)}, {stack}) as (grade, band_idx, lower_pct, upper_pct, n_band, pos_band)")


def band_lift(rk: Ranked, y: str = config.TARGET) -> DataFrame:
    """Lift of each grade band (top 0–25 %, 25–50 %, 50–100 % by rank): mean(y) / base;
    NULL when the band is empty or the base rate is 0."""
    b = band_rates(rk, y)
    base = F.try_divide(F.col("p"), F.col("n"))
    rate = F.try_divide(F.col("pos_band"), F.col("n_band"))
    lift = F.when((F.col("n_band") > 0) & (base > 0), F.try_divide(rate, base))
    return b.select(*rk.group, "grade", lift.alias("lift"))


def grade_table(rk: Ranked, y: str = config.TARGET, daily_volume: float | dict = config.DAILY_VOLUME,
                base: dict | None = None) -> DataFrame:
    """Per-grade legend: display letter, band text, leads/day, conversion rate, lift."""
    b = band_rates(rk, y)
    seg = F.col(rk.group[0]) if rk.group else F.lit(None).cast("string")
    letter = _display_letter(seg, F.col("grade"))
    vol = per_group(daily_volume if isinstance(daily_volume, dict) else {g: float(daily_volume) for g in rk.counts},
                    rk.group, "double")
    base_c = per_group(base, rk.group, "double") if base is not None else F.try_divide(F.col("p"), F.col("n"))
    rate = F.when(F.col("n_band") > 0, F.try_divide(F.col("pos_band"), F.col("n_band")))
    band_txt = F.concat(F.col("lower_pct").cast("string"), F.lit("–"), F.col("upper_pct").cast("string"), F.lit("%"))
    return b.select(*rk.group, letter.alias("grade"), band_txt.alias("banda"),
                    (F.col("n_band") / F.greatest(F.col("n"), F.lit(1)) * vol).alias("leads_dia"),
                    rate.alias("tasa_exito"),
                    F.when(base_c != 0, F.try_divide(rate, base_c)).alias("vs_azar"))


def _display_letter(segment: Column, canonical: Column) -> Column:
    """Per-segment display letter of a canonical grade; unknown segment → canonical."""
    canon = config.canonical_grades()
    expr = canonical
    for seg, letters in config.GRADE_LETTERS.items():
        m = F.create_map(*[x for c, l in zip(canon, letters) for x in (F.lit(c), F.lit(l))])
        expr = F.when(segment == F.lit(seg), F.coalesce(F.try_element_at(m, canonical), canonical)).otherwise(expr)
    return expr


def capacity_table(rk: Ranked, y: str = config.TARGET, daily_volume: float = config.DAILY_VOLUME,
                   cuts=config.CAPACITY_CUTS, base: dict | None = None) -> DataFrame:
    """Cumulative gains per top-P % cut: leads/day, conversions/day, rate, share captured, lift."""
    aggs = []
    for i, p in enumerate(cuts):
        k = per_group({g: max(py_round(p / 100 * n), 1) for g, n in rk.counts.items()}, rk.group, "long")
        top = F.col("rank") <= k
        aggs += [F.count_if(top).alias(f"_k{i}"), F.sum(F.when(top, F.col(y).cast("long")).otherwise(0)).alias(f"_t{i}")]
    agg = rk.frame.groupBy(*rk.group).agg(*aggs, F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("p"))
    stack = ", ".join(f"{p}, _k{i}, _t{i}" for i, p in enumerate(cuts))
    t = agg.selectExpr(*[f"`{g}`" for g in rk.group], "n", "p", f"stack({len(cuts)}, {stack}) as (top_pct, k, tp)")
    base_c = per_group(base, rk.group, "double") if base is not None else F.try_divide(F.col("p"), F.col("n"))
    tasa = F.try_divide(F.col("tp"), F.col("k"))
    leads = F.col("top_pct") / F.lit(100.0) * F.lit(float(daily_volume))
    return t.select(*rk.group, "top_pct", leads.alias("leads_dia"), (leads * tasa).alias("conv_dia"),
                    tasa.alias("tasa_exito"), (F.col("tp") / F.greatest(F.col("p"), F.lit(1))).alias("pct_capturadas"),
                    F.when(base_c != 0, F.try_divide(tasa, base_c)).otherwise(F.lit(float("nan"))).alias("vs_azar"))


def topk_fraction(rk: Ranked, pct: float) -> DataFrame:
    """First ``k = max(round(pct/100·n), 1)`` rows of each group by rank."""
    k = per_group({g: max(py_round(pct / 100 * n), 1) for g, n in rk.counts.items()}, rk.group, "long")
    return rk.frame.filter(F.col("rank") <= k)


def approx_quantiles(df: DataFrame, score: str, probs: list[float], group: list[str] | None = None,
                     accuracy: int = 10_000) -> dict[tuple, list[float]]:
    """Opt-in sketch quantiles per group (``percentile_approx``: one partial-aggregated pass,
    no global sort). Not interpolating: values are observed scores within ``1/accuracy``
    rank error, so results can differ from the exact default."""
    group = list(group or [])
    rows = df.groupBy(*group).agg(F.percentile_approx(F.col(score), probs, accuracy).alias("_q")).collect()
    return {tuple(r[g] for g in group): [float(v) for v in r["_q"]] for r in rows}


def qcut_probabilities(q: int = 10) -> list[float]:
    """Bin probabilities as a pandas decile cut computes them (linspace, via percent)."""
    return [float(x) for x in (np.linspace(0, 1, q + 1) * 100) / 100]


@dataclass
class Scored:
    """Scored rows without a rank, for what only needs quantiles: cutoffs, bins, confusion counts."""
    frame: DataFrame
    group: list[str]


def scored(df: DataFrame, group: list[str] | None = None) -> Scored:
    return Scored(df, list(group or []))


def _quantiles(rk: Ranked | Scored, score: str, probs: list[float], approx_accuracy: int | None) -> dict[tuple, list[float]]:
    """Exact quantiles by selection (default) or, opted in, sketch quantiles."""
    if approx_accuracy:
        return approx_quantiles(rk.frame, score, probs, rk.group, approx_accuracy)
    return select_quantiles(rk.frame, score, probs, rk.group)


def qcut_edges(rk: Ranked | Scored, score: str = "score", q: int = 10,
               approx_accuracy: int | None = None) -> dict[tuple, list[float]]:
    qs = _quantiles(rk, score, qcut_probabilities(q), approx_accuracy)
    return {g: sorted(set(v)) for g, v in qs.items()}


def qcut_bins(rk: Ranked | Scored, score: str = "score", q: int = 10, approx_accuracy: int | None = None) -> DataFrame:
    """Quantile bin per row: right-closed bins over distinct edges, lowest edge included,
    relabelled 0..k−1 (``bin = max(#edges < s, 1) − 1``)."""
    edges = qcut_edges(rk, score, q, approx_accuracy)
    if rk.group:
        m = F.create_map(*[x for g, e in edges.items() for x in (F.lit(g[0]), F.array(*[F.lit(v) for v in e]))])
        arr = F.try_element_at(m, F.col(rk.group[0]))
    else:
        arr = F.array(*[F.lit(v) for v in edges.get((), [])])
    # count of edges strictly below the score, lambda-free (≤ q + 1 edges; missing ones are NULL)
    below = sum((F.coalesce((F.try_element_at(arr, F.lit(i)) < F.col(score)).cast("int"), F.lit(0))
                 for i in range(1, q + 2)), F.lit(0))
    return rk.frame.withColumn("bin", (F.greatest(below, F.lit(1)) - 1).cast("int"))


def decile_lift(binned: DataFrame, y: str = config.TARGET, group: list[str] | None = None) -> DataFrame:
    """Per quantile bin: conversion, rows and lift vs the group's base; labelled 1.. best-high."""
    group = list(group or [])
    yy = F.col(y).cast("double")
    per = binned.groupBy(*group, "bin").agg(F.sum(yy).alias("_s"), F.count(yy).alias("_c"), F.count(F.lit(1)).alias("n"))
    bins = Window.partitionBy(*group)  # a few rows a group: its base rate follows from its bins
    base = F.try_divide(F.sum("_s").over(bins), F.sum("_c").over(bins).cast("double"))
    conv = F.try_divide(F.col("_s"), F.col("_c").cast("double"))
    return per.select(*group, (F.col("bin") + 1).alias("decile"), conv.alias("conv"), "n", F.try_divide(conv, base).alias("lift"))


def top_bin_lift(lifts: DataFrame, group: list[str] | None = None) -> DataFrame:
    group = list(group or [])
    top = lifts.groupBy(*group).agg(F.max_by("lift", "decile").alias("top_bin_lift"), F.max("decile").alias("top_decile"))
    return top


def confusion_at_top(rk: Ranked | Scored, score: str = "score", y: str = config.TARGET,
                     frac: float = config.TOP_FRACTION, approx_accuracy: int | None = None) -> DataFrame:
    """Threshold = quantile(1 − frac); positive iff score ≥ threshold; confusion counts and
    precision/recall (0 when undefined)."""
    thr = {g: v[0] for g, v in _quantiles(rk, score, [1 - frac], approx_accuracy).items()}
    t = per_group(thr, rk.group, "double")
    pred = F.col(score) >= t
    yy = F.col(y).cast("int") == 1
    agg = rk.frame.groupBy(*rk.group).agg(
        F.count_if(~pred & ~yy).alias("tn"), F.count_if(pred & ~yy).alias("fp"),
        F.count_if(~pred & yy).alias("fn"), F.count_if(pred & yy).alias("tp"),
        F.count(F.lit(1)).alias("n_test"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    return agg.select(*rk.group, F.lit(float(frac)).alias("frac"), t.alias("threshold"), "n_test",
                      "tn", "fp", "fn", "tp", prec.alias("precision"), rec.alias("recall"))


def grade_thresholds(rk: Ranked | Scored, score: str = "score",
                     approx_accuracy: int | None = None) -> dict[tuple, dict[str, float]]:
    """Score cutoffs at each band's lower percentile (A: q75, B: q50) per group."""
    probs = [q / 100 for _, q in config.GRADE_BANDS]
    qs = _quantiles(rk, score, probs, approx_accuracy)
    return {g: {grade: v for (grade, _), v in zip(config.GRADE_BANDS, vals)} for g, vals in qs.items()}


def grade_assign(score: Column, thresholds: dict[str, float] | Column | None, segment: Column | None = None) -> Column:
    """Display letter: first band whose cutoff the score reaches, else the fallback band.

    ``thresholds`` is a dict (one model) or a ``map<string,double>`` column (per row);
    no thresholds → NULL. Unknown segment → canonical letters.
    """
    seg = segment if segment is not None else F.lit(None).cast("string")
    if thresholds is None or (isinstance(thresholds, dict) and not thresholds):
        return F.lit(None).cast("string")
    get = (lambda g: F.lit(thresholds[g])) if isinstance(thresholds, dict) else \
          (lambda g: F.try_element_at(thresholds, F.lit(g)))
    canon = F.lit(config.GRADE_FALLBACK)
    for g, _ in reversed(config.GRADE_BANDS):
        canon = F.when(score >= get(g), F.lit(g)).otherwise(canon)
    letter = _display_letter(seg, canon)
    if isinstance(thresholds, dict):
        return letter
    return F.when(thresholds.isNotNull() & (F.size(F.map_keys(thresholds)) > 0), letter)
