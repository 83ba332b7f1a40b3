"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

Texts become sets of word shingles; equal sets are one node, so exact copies never meet again. Each
node gets a SuperMinHash signature: an element walks the slots in a random order of its own and offers
``j + u`` to the j-th slot it visits, so the slots of one element are anticorrelated, and the walk of
a text stops once no slot can improve. Signatures are cut into bands; nodes that share a band are
candidates and a pair is linked only if its full sets meet the threshold.

A band bucket is not expanded into all pairs. Rounds compare each member with the smallest member of its
bucket and merge what links. Buckets that still hold several components are left over; shingles that no
other left-over node has cannot be shared, so a node (or a pair) with too many of them cannot reach the
threshold and is out. The others are compared with the hub of their bucket, the member with the fewest such
shingles; what two members share in the hub and outside it bounds what they share at all, and at last all
pairs that the bounds allow, between different components of
a bucket, are verified. So no link between components is lost within the buckets; a pair at the
threshold shares no band with chance ``(1 - t ** rows) ** bands`` (6e-11 for 0.85, 32 bands of 4 rows).

Links, components and sets stay in DataFrames; what steps share is written to the shared folder.

Edge cases: a null, empty or blank text has no shingles, size 0, and is its own group; with fewer words
than a shingle the whole sequence is the one shingle; rows with equal texts are copies, also when their
ids are equal; a null id is never the smallest of a group (the group of null ids alone is null and
kept); an empty table gives an empty result; only id and text are read, other columns cannot clash.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, free_names, giving_back, small_batches, stored

by_value(__name__)

MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class NearDup:
    shingle: int = 5
    threshold: tuple = (80, 100)  # a share as two integers, so that the comparison is exact
    bands: int = 32
    rows: int = 4


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = (x + MIX[0]).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lowered; on bytes ``lower`` and ``split`` know ASCII only, as asked for."""
    return text.encode().lower().split() if text else []


def shingle_set(words: list[bytes], size: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    ids = np.fromiter((known[w] if w in known else known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words),
                      dtype=np.uint64, count=len(words))
    if len(known) > 100_000:
        known.clear()
    size = min(size, len(words))
    h = np.full(len(ids) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h = mix64(h ^ ids[k:len(ids) - size + 1 + k])
    return np.unique(h)


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures of non-empty sets, all sets advancing one step of their walks at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets)
    sig = np.full(len(sets) * slots, np.inf)
    order = np.tile(np.arange(slots, dtype=np.uint16), (len(items), 1))
    row = np.arange(len(items))
    for j in range(slots):
        draw = mix64(items + np.uint64((j + 1) * int(MIX[0]) % 2 ** 64))
        k = j + ((draw & np.uint64(0xFFFFF)) % np.uint64(slots - j)).astype(np.int64)
        u = (draw >> np.uint64(20)).astype(np.float64) * 2.0 ** -44
        place = order[row, k].astype(np.int64)
        order[row, k] = order[row, j]
        order[row, j] = place
        np.minimum.at(sig, owner * slots + place, j + np.minimum(u, 1 - 2.0 ** -44))
        if j + 1 < slots:
            done = sig.reshape(len(sets), slots).max(axis=1) < j + 1  # the next offers are j + 1 at least
            if done.any():
                left = ~done[owner]
                owner, items, row = owner[left], items[left], row[left]
                if not len(owner):
                    break
    return sig.reshape(len(sets), slots)


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bits = sig.view(np.uint64).reshape(len(sig), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for r in range(bits.shape[2]):
        key = mix64(key ^ bits[:, :, r])
    return key.view(np.int64)


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def in_pieces(sets: list, most: int):
    """Runs of sets of about ``most`` elements, so that the walk's state stays small."""
    run, n = [], 0
    for s in sets:
        run.append(s)
        n += len(s)
        if n >= most:
            yield run
            run, n = [], 0
    if run:
        yield run


def sketcher(spec: NearDup):
    def sketch(batches):
        known: dict = {}
        for pdf in batches:
            sets = [shingle_set(words_of(t), spec.shingle, known) for t in pdf["text"]]
            full = [s for s in sets if len(s)]
            keys = [k for part in in_pieces(full, 50_000)
                    for k in band_keys(signatures(part, spec.bands * spec.rows), spec.bands)]
            keys = iter(keys)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tkey": pdf["tkey"], "n": [len(s) for s in sets],
                                "node": [digest(s) if len(s) else None for s in sets],
                                "bands": [next(keys) if len(s) else None for s in sets]})
    return sketch


def set_builder(spec: NearDup):
    def build(batches):
        known: dict = {}
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "n": pdf["n"],
                                "items": [shingle_set(words_of(t), spec.shingle, known).tobytes() for t in pdf["text"]]})
    return build


def common_items(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b):
        x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        out.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()))
    return pd.Series(out, dtype="int64")


def reaches(common, a, b, threshold: tuple):
    """``common / (a + b - common) >= threshold`` in integers."""
    num, den = threshold
    return common * (num + den) >= (a + b) * num


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of their sets and how many items are in both."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("items").alias("ia"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("items").alias("ib"))
    common = F.pandas_udf(common_items, "long")(F.col("ia"), F.col("ib"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "na", "nb", common.alias("common"))


def linked(found: DataFrame, threshold: tuple) -> DataFrame:
    """Those of the compared pairs whose full sets are close enough."""
    return found.filter(reaches(F.col("common"), F.col("na"), F.col("nb"), threshold)).select("a", "b")


def merged(comps: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Components (node, comp) after the links (a, b): the union-find forest over component roots, whose trees
    are flattened by hooking every root to its smallest neighbour and halving paths until nothing moves."""
    a = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    edges = links.join(a, "a").join(b, "b").filter("ca != cb").select("ca", "cb")
    edges = stored(edges.union(edges.select("cb", "ca")).distinct(), f"{name}-edges")
    parent = None
    while True:
        if parent is None:
            step = edges.groupBy(F.col("ca").alias("root")).agg(F.min("cb").alias("m"))
            step = step.select("root", F.least("root", "m").alias("up"))
        else:
            up = parent.select(F.col("root").alias("cb"), F.col("up").alias("up_b"))
            best = edges.join(up, "cb").groupBy(F.col("ca").alias("root")).agg(F.min("up_b").alias("m"))
            hook = parent.join(best, "root").select("root", "up", F.least("up", "m").alias("to"))
            # the root that a node hung on hears of the smaller one, too
            told = (hook.groupBy(F.col("up").alias("root")).agg(F.min("to").alias("told")))
            hook = hook.join(told, "root", "left").select("root", F.least("to", F.coalesce("told", "to")).alias("to"))
            jump = hook.select(F.col("root").alias("to"), F.col("to").alias("two"))
            step = hook.join(jump, "to", "left").select("root", F.coalesce("two", "to").alias("up"))
        new = stored(step, f"{name}-forest")
        if parent is not None:
            old = parent.select("root", F.col("up").alias("was"))
            if new.join(old, "root").filter("up != was").limit(1).count() == 0:
                break
        elif new.limit(1).count() == 0:
            return comps
        parent = new
    out = comps.join(parent.select(F.col("root").alias("comp"), "up"), "comp", "left")
    return stored(out.select("node", F.coalesce("up", "comp").alias("comp")), f"{name}-comps")


def star_pairs(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Each member with the smallest member of the smallest component of its bucket."""
    m = members.join(comps, "node")
    centre = m.groupBy("key").agg(F.min(F.struct("comp", "node")).alias("c"), F.max("comp").alias("hi"))
    centre = centre.filter(F.col("c.comp") != F.col("hi")).select("key", "c")
    return (m.join(centre, "key").filter(F.col("comp") != F.col("c.comp"))
            .select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b"), "node"))


def no_pairs(comps: DataFrame) -> DataFrame:
    return comps.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)


def as_longs(items: pd.Series) -> pd.Series:
    return items.map(lambda x: np.frombuffer(x, dtype=np.int64))


def mixed_buckets(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The members, with their components, of the buckets that hold more than one component."""
    m = members.join(comps, "node")
    mixed = m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("key")
    return m.join(mixed, "key")


def left_over(members: DataFrame, comps: DataFrame, sets: DataFrame, spec: NearDup) -> DataFrame:
    """Members of mixed buckets that may still link (key, node, n, most): ``most`` is how many of a node's items any
    other left-over node holds, so no link of it shares more."""
    num, den = spec.threshold
    m = stored(mixed_buckets(members, comps).select("key", "node"), "near-left")
    own = m.select("node").distinct()
    blocks = sets.join(own, "node", "left_semi")
    items = blocks.select("node", "n", F.explode(F.pandas_udf(as_longs, "array<long>")("items")).alias("item"))
    shared = items.groupBy("item").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("item")
    most = items.join(shared, "item").groupBy("node").agg(F.count(F.lit(1)).alias("most"))
    m = m.join(stored(blocks.select("node", "n").join(most, "node"), "near-bound"), "node")
    least = m.groupBy("key").agg(F.min("n").alias("least"))
    # the best partner has all of the shared items and is no smaller than the smallest of the bucket
    m = m.join(least, "key").filter(F.col("most") * (num + den)
                                    >= (F.col("n") + F.greatest("least", F.col("most"))) * num)
    return stored(m.select("key", "node", "n", "most"), "near-bounded")


def with_hubs(bounded: DataFrame) -> DataFrame:
    """Each member with the most typical one of its bucket, the one with the fewest items of its own."""
    hub = bounded.groupBy("key").agg(F.min(F.struct((F.col("n") - F.col("most")).alias("rare"), "node")).alias("h"))
    return bounded.join(hub.select("key", F.col("h.node").alias("hub")), "key")


def last_pairs(hubbed: DataFrame, to_hub: DataFrame, comps: DataFrame, spec: NearDup) -> DataFrame:
    """Pairs of different components in one bucket that the bounds do not exclude. With ``o`` items in the hub and
    ``e`` shared items outside it, two members share at most the smaller ``o`` plus the smaller ``e``."""
    m = mixed_buckets(hubbed, comps)
    known = to_hub.select(F.col("a").alias("node"), F.col("b").alias("hub"), "common")
    m = m.join(known, ["node", "hub"], "left").withColumn("o", F.coalesce("common", "n"))  # the hub itself
    m = stored(m.withColumn("e", F.col("most") - F.col("o")), "near-mixed")
    m = m.join(m.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys")), "node")  # a key per band at most
    x = m.select("key", *[F.col(c).alias(f"x_{c}") for c in ("node", "comp", "n", "o", "e", "keys")])
    y = m.select("key", *[F.col(c).alias(f"y_{c}") for c in ("node", "comp", "n", "o", "e", "keys")])
    pairs = x.join(y, "key").filter((F.col("x_comp") < F.col("y_comp")) & reaches(
        F.least("x_o", "y_o") + F.least("x_e", "y_e"), F.col("x_n"), F.col("y_n"), spec.threshold)
        & (F.element_at(F.array_intersect("x_keys", "y_keys"), 1) == F.col("key")))  # in one of the buckets that they share
    return pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def groups(docs: DataFrame, spec: NearDup = NearDup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``tkey`` (hash of the text), n_shingles, component_id (smallest id of the group) and kept."""
    base = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("tkey"),
                       F.col(text_col).alias("text"))
    id_type = dict(base.dtypes)["doc_id"]
    # ids go through Python as strings: a batch with a null would make numbers of them that are not exact
    sketched = base.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        giving_back(sketcher(spec)), "doc_id string, tkey string, n long, node binary, bands array<long>")
    rows = stored(sketched.withColumn("doc_id", F.col("doc_id").cast(id_type)), "near-sketch")
    nodes = (rows.filter("node is not null").groupBy("node")
             .agg(F.min("doc_id").alias("least_id"), F.min(F.struct("tkey", "doc_id")).alias("one"), F.first("n").alias("n"),
                  F.first("bands").alias("bands")))
    nodes = stored(nodes, "near-nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    met = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    members = stored(banded.join(met, "key"), "near-members")
    chosen = (nodes.join(members.select("node").distinct(), "node", "left_semi")
              .select("node", "n", F.col("one.tkey").alias("k_tkey"), F.col("one.doc_id").alias("k_id")))
    texts = base.join(chosen, (F.col("tkey") == F.col("k_tkey")) & F.col("doc_id").eqNullSafe(F.col("k_id")))
    # a row that repeats id and text would give its set twice
    sets = stored(texts.select("node", "n", "text").mapInPandas(giving_back(set_builder(spec)), "node binary, n long, items binary")
                  .groupBy("node").agg(F.first("n").alias("n"), F.first("items").alias("items")), "near-sets")

    comps = stored(members.select("node").distinct().withColumn("comp", F.col("node")), "near-start")
    tested = stored(no_pairs(comps), "near-tested")

    def verified(pairs: DataFrame) -> bool:
        """Compare the new ones of the pairs and merge what links; whether there were new ones."""
        nonlocal comps, tested
        new = stored(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        if new.limit(1).count() == 0:
            return False
        comps = merged(comps, stored(linked(compared(new, sets), spec.threshold), "near-links"), "near")
        tested = tested.union(new)
        return True

    first = star_pairs(members, comps).groupBy("node").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
    if verified(first.distinct()):  # one partner for each node: most copies need no more
        while verified(star_pairs(members, comps).select("a", "b").distinct()):
            pass
        hubbed = stored(with_hubs(left_over(members, comps, sets, spec)), "near-hubs")
        spokes = hubbed.filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        to_hub = stored(compared(spokes, sets), "near-spokes")
        comps = merged(comps, stored(linked(to_hub, spec.threshold), "near-hub-links"), "near")
        verified(last_pairs(hubbed, to_hub, comps, spec))

    joined = nodes.select("node", "least_id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = joined.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = joined.join(least, "comp").select(F.col("node").alias("g_node"), "component_id")
    out = rows.join(named, F.col("node") == F.col("g_node"), "left")
    comp = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "tkey", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.col("doc_id").eqNullSafe(comp).alias("kept"))


def keep_one(docs: DataFrame, spec: NearDup = NearDup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of each group with its smallest id, with all columns; of rows that repeat id and text one stays."""
    id_, tkey = free_names(docs.columns, 2)
    found = groups(docs, spec, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias(id_), F.col("tkey").alias(tkey)).distinct()
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(id_))
                     & (F.md5(F.coalesce(F.col(text_col), F.lit(""))) == F.col(tkey))).select(*docs.columns)
