"""Exact removal of repeated byte strings with per-shard suffix arrays.

A byte goes when it lies in a string of ``length`` bytes that also starts at another place, in the same
text or another one. Strings never cross texts and are judged on the input.

1. Anchors. The start of each string is dealt to the smallest hash of the ``window``-byte strings inside
   it. Equal strings have equal anchors, and neighbouring starts mostly share theirs, so a text falls
   into contexts: runs of starts with one anchor, with the bytes that their strings span. Contexts whose
   anchor occurs nowhere else cannot hold a repeat; equal contexts are counted and go on once.
2. Shards. Contexts that share an anchor but differ go to one shard by the anchor's hash. A shard's bytes
   get a suffix array (Larsson-Sadakane) and common prefixes (Kasai): starts next to each other in the
   array that share ``length`` bytes repeat.
3. Merging. An anchor with more than ``shard_contexts`` different contexts is dealt over several shards.
   Each sends its starts that are unique there, as sorted runs of fingerprints cut into ranges; a range
   is merged by binary search of every run in the others.
4. The intervals of each distinct text are joined to its bytes, cut out and hashed.

Bloom filters of a fixed size (``bloom_bits``) keep rows that cannot match from being shuffled; when they
fill up at a larger size they only let more rows through. Texts are known by a 128-bit hash, so copies
are handled once. Bounds: a task holds one shard, range or batch of texts, never a group of copies.

Edge cases: null and empty texts have 0 bytes, nothing removed and the hash of the empty string; a text
shorter than ``length`` keeps all; rows that repeat an id or a text are documents of their own, so two
equal texts of ``length`` bytes or more lose all; overlapping repeats count as one run; an empty table
gives an empty result; only id and text are read, other columns cannot clash.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import suffix_array as sa_module
from .common import by_value, stored

by_value(__name__)

common_prefixes = sa_module.common_prefixes
PIECE = 1 << 20               # starts that are hashed at a time; 20 bits tell their places
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
       0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


@dataclass(frozen=True)
class Repeats:
    length: int = 400
    window: int = 192
    shard_bytes: int = 1 << 20
    shard_contexts: int = 2000
    range_starts: int = 200_000
    bloom_bits: int = 1 << 24


def span_hash(b: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position on, put together from spans of powers of two."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(ODD[0])
    h ^= h >> np.uint64(29)
    out, have, span, k = None, 0, 1, 1
    while True:
        if size & span:
            if out is None:
                out = h.copy()
            else:  # what there is, then this span
                m = min(len(out), len(h) - have)
                out = out[:m] * np.uint64(ODD[9]) + h[have:have + m]
            have += span
        if have == size:
            break
        h = h[:-span] * np.uint64(ODD[k % 9]) + h[span:] if len(h) > span else h[:0]
        h ^= h >> np.uint64(31)
        span, k = span * 2, k + 1
    out = out[:max(0, len(b) - size + 1)]
    out ^= out >> np.uint64(31)
    out *= np.uint64(ODD[5])
    return out ^ (out >> np.uint64(29))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m, span = h, 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:len(h) - width + 1], m[width - span:width - span + len(h) - width + 1])


def contexts_of(b: np.ndarray, spec: Repeats) -> tuple:
    """Contexts of the starts in ``b``: anchor key, first start, number of starts, whether the anchor occurs twice."""
    h = span_hash(b, spec.window)
    low = np.uint64(PIECE - 1)
    placed = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost is the smallest
    m = sliding_min(placed, spec.length - spec.window + 1)
    place = (m & low).astype(np.int64)
    key = h[place]
    new = np.append(True, key[1:] != key[:-1])
    first = np.flatnonzero(new)
    moved = np.append(False, place[1:] != place[:-1]) & ~new
    twice = np.add.reduceat(moved, first) > 0
    return key[first].view(np.int64), first, np.diff(np.append(first, len(m))), twice


def finder(spec: Repeats):
    """Texts to their contexts, one row per text that is long enough."""
    def one(raw: bytes) -> tuple:
        b = np.frombuffer(raw, dtype=np.uint8)
        parts = []
        step = PIECE - spec.length
        for at in range(0, len(b) - spec.length + 1, step):
            piece = b[at:at + step + spec.length - 1]
            key, first, n, twice = contexts_of(piece, spec)
            ends = first + n + spec.length - 1
            mem = memoryview(piece)
            own = np.fromiter((xxhash.xxh3_64_intdigest(mem[s:e]) for s, e in zip(first, ends)), dtype=np.uint64,
                              count=len(first)).view(np.int64)
            parts.append((key, own, first + at, n, twice))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def find(batches):
        for pdf in batches:
            rows = []
            for tkey, text in zip(pdf["tkey"], pdf["text"]):
                raw = text.encode()
                if len(raw) >= spec.length:
                    rows.append((tkey, *one(raw)))
            yield pd.DataFrame(rows, columns=["tkey", "akeys", "chashes", "firsts", "ns", "twices"])
    return find


def bloom(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """One-hash Bloom filter of a fixed size, built in slices, so that what is shuffled and sent back is bounded."""
    size = min(bits, 1 << 18)

    def slices(batches):
        held: dict = {}
        for pdf in batches:
            at = pdf["at"].to_numpy()
            for s in np.unique(at // size):
                b = held.setdefault(int(s), np.zeros(size, dtype=bool))
                b[at[at // size == s] % size] = True
        yield pd.DataFrame({"slice": list(held), "b": [np.packbits(b).tobytes() for b in held.values()]})

    def union(pdf):
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1],
                             "b": [np.bitwise_or.reduce([np.frombuffer(x, dtype=np.uint8) for x in pdf["b"]]).tobytes()]})

    found = (keys.select(F.pmod(key, F.lit(bits)).alias("at")).mapInPandas(slices, "slice long, b binary")
             .groupBy("slice").applyInPandas(union, "slice long, b binary").collect())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in found:
        out[r["slice"] * size // 8:(r["slice"] + 1) * size // 8] = np.frombuffer(r["b"], dtype=np.uint8)
    return out


def in_bloom(at: np.ndarray, filled: np.ndarray) -> np.ndarray:
    at = at % np.int64(len(filled) * 8)
    return (filled[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of True."""
    d = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1) - 1


def shard_judge(spec: Repeats):
    """One shard's contexts to the starts that repeat in it (kind 0: runs of starts) and, for anchors that lie in
    several shards, the starts that are unique here (kind 1: sorted fingerprints of one range)."""
    def judge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        size = pdf["body"].str.len().to_numpy()
        at = np.concatenate([[0], np.cumsum(size)])
        buf = np.frombuffer(b"".join(pdf["body"]), dtype=np.uint8)
        order, shared = common_prefixes(buf, spec.length)
        starts = np.zeros(len(buf), dtype=bool)
        for a, n in zip(at, pdf["n"]):
            starts[a:a + n] = True
        # classes of equal strings are runs of the array; only starts count
        cls = np.cumsum(shared < spec.length) - 1
        own = starts[order]
        many = np.bincount(cls[own], minlength=cls[-1] + 1)[cls] > 1
        repeated = np.zeros(len(buf), dtype=bool)
        repeated[order[many & own]] = True
        first = np.zeros(len(buf), dtype=bool)  # one start of each class speaks for it
        speaks = order[own][np.unique(cls[own], return_index=True)[1]]
        first[speaks] = True
        fp = span_hash(buf, spec.length) if pdf["parts"].max() > 1 else None
        for i, r in enumerate(pdf.itertuples()):
            lo, hi = runs_of(repeated[at[i]:at[i] + r.n])
            out += [(0, r.akey, r.chash, int(a), int(b), 0, None, None) for a, b in zip(lo, hi)]
        if fp is not None:
            n_ranges = pdf["ranges"].to_numpy()
            hot = np.flatnonzero(pdf["parts"].to_numpy() > 1)
            for akey, members in pd.Series(hot).groupby(pdf["akey"].to_numpy()[hot]):
                where = np.concatenate([at[i] + np.flatnonzero(first[at[i]:at[i] + pdf["n"].iloc[i]]) for i in members])
                ctx = np.concatenate([np.full(int(first[at[i]:at[i] + pdf["n"].iloc[i]].sum()), i) for i in members])
                f = fp[where]
                sort = np.argsort(f, kind="stable")
                f, where, ctx = f[sort], where[sort], ctx[sort]
                part = (f >> np.uint64(40)) % np.uint64(n_ranges[members.iloc[0]])
                for p in np.unique(part):
                    sel = part == p
                    place = np.stack([pdf["chash"].to_numpy()[ctx[sel]], where[sel] - at[ctx[sel]]])
                    out.append((1, akey, 0, 0, 0, int(p), f[sel].tobytes(), place.astype(np.int64).tobytes()))
        return pd.DataFrame(out, columns=["kind", "akey", "chash", "a", "b", "part", "fps", "places"])
    return judge


JUDGED = "kind int, akey long, chash long, a long, b long, part long, fps binary, places binary"


def merge_runs(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """One range of one anchor: each shard's sorted run is looked up in the others by binary search."""
    runs = [np.frombuffer(x, dtype=np.uint64) for x in pdf["fps"]]
    union = np.sort(np.concatenate(runs))
    out = []
    for run, places in zip(runs, pdf["places"]):
        place = np.frombuffer(places, dtype=np.int64).reshape(2, len(run))
        # a run holds a fingerprint once, so a second one is another shard's
        again = np.searchsorted(union, run, "right") - np.searchsorted(union, run, "left") > 1
        out.append(pd.DataFrame({"chash": place[0, again], "a": place[1, again]}))
    got = pd.concat(out)
    got["akey"] = int(pdf["akey"].iloc[0])
    got["b"] = got["a"]
    return got[["akey", "chash", "a", "b"]]


def cutter(length: int):
    """Distinct texts and their intervals of repeated starts to what is left."""
    def cut(batches):
        for pdf in batches:
            rows = []
            for tkey, text, spans in zip(pdf["tkey"], pdf["text"], pdf["spans"]):
                raw = text.encode()
                left, at, removed, runs, end = [], 0, 0, 0, -1
                for a, b in sorted((s["a"], s["b"] + length) for s in spans):
                    if a > end:
                        runs += 1
                        left.append(raw[at:a])
                        at = a
                    if b > at:
                        removed += b - at
                        at = b
                    end = max(end, b)
                left.append(raw[at:])
                rest = b"".join(left)
                rows.append((tkey, removed, runs, hashlib.sha256(rest).hexdigest(), rest))
            yield pd.DataFrame(rows, columns=["tkey", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])
    return cut


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def needed_texts(base: DataFrame, keys: DataFrame, spec: Repeats) -> DataFrame:
    """The rows of ``keys`` with the text of each key: a Bloom filter spares the other texts the shuffle, and copies
    of a text are reduced to one before it."""
    filled = bloom(keys, F.xxhash64("tkey"), spec.bloom_bits)
    maybe = F.pandas_udf(lambda h: pd.Series(in_bloom(h.to_numpy(), filled)), "boolean")
    near = base.filter(maybe(F.pmod(F.xxhash64("tkey"), F.lit(spec.bloom_bits))))
    return near.dropDuplicates(["tkey"]).join(keys, "tkey")


def repeats(docs: DataFrame, spec: Repeats, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(distinct texts keyed by ``tkey``, rows of (tkey, a, b): the strings from a to b repeat)."""
    base = docs.select(F.col(text_col).alias("text")).filter(F.octet_length("text") >= spec.length)
    base = base.withColumn("tkey", text_key(F.col("text"))).select("tkey", "text")
    # copies of one text are counted, and the first stands for them
    found = stored(base.mapInPandas(finder(spec), "tkey binary, akeys array<long>, chashes array<long>, firsts array<long>, "
                                                  "ns array<long>, twices array<boolean>"), "repeat-contexts")
    again = (found.select(F.explode(F.arrays_zip("akeys", "twices")).alias("c")).groupBy(F.col("c.akeys").alias("akey"))
             .agg(F.count(F.lit(1)).alias("m"), F.max("c.twices").alias("twice")).filter("m > 1 OR twice")
             .select("akey", "twice"))
    again = stored(again, "repeat-anchors")
    filled = bloom(again, F.col("akey"), spec.bloom_bits)
    bits = np.int64(spec.bloom_bits)
    maybe = F.pandas_udf(lambda s: pd.Series([in_bloom(np.asarray(x) % bits, filled) for x in s]), "array<boolean>")
    zipped = found.withColumn("maybe", maybe("akeys")).select("tkey", F.explode(F.filter(
        F.arrays_zip("akeys", "chashes", "firsts", "ns", "maybe"), lambda c: c["maybe"])).alias("c"))
    ctx = zipped.select("tkey", F.col("c.akeys").alias("akey"), F.col("c.chashes").alias("chash"),
                        F.col("c.firsts").alias("first"), F.col("c.ns").alias("n")).join(again, "akey")
    # rows that are equal stand for copies of one text
    ctx = stored(ctx.groupBy("tkey", "akey", "chash", "first", "n", "twice").agg(F.count(F.lit(1)).alias("copies")),
                 "repeat-rows")
    classes = ctx.groupBy("akey", "chash").agg(F.sum("copies").alias("m"), F.max("n").alias("n"), F.max("twice").alias("twice"),
                                               F.min(F.struct("tkey", "first")).alias("one"))
    classes = stored(classes, "repeat-classes")
    whole = classes.filter("m > 1").select("akey", "chash", F.lit(0).cast("long").alias("a"), (F.col("n") - 1).alias("b"))

    variants = classes.groupBy("akey").agg(F.count(F.lit(1)).alias("variants"), F.sum("n").alias("starts"),
                                           F.sum(F.col("n") + spec.length).alias("bytes"))
    open_ = classes.join(variants, "akey").filter("variants > 1 OR (twice AND m = 1)")
    # an anchor is dealt over shards by its contexts and by their bytes: a run of equal bytes is one long context
    heavy = F.when(F.col("bytes") > 2 * spec.shard_bytes, F.ceil(F.col("bytes") / spec.shard_bytes)).otherwise(F.lit(1))
    open_ = open_.withColumns({
        "parts": F.greatest(F.ceil(F.col("variants") / spec.shard_contexts), heavy),
        "ranges": F.ceil(F.greatest(F.col("variants") * F.lit(spec.window), F.col("starts")) / spec.range_starts)})
    open_ = stored(open_.select("akey", "chash", "n", "parts", "ranges", F.col("one.tkey").alias("tkey"),
                                F.col("one.first").alias("first")), "repeat-open")
    total = open_.agg(F.sum(F.col("n") + spec.length)).first()[0] or 0
    shards = max(1, -(-total // spec.shard_bytes))
    shard = F.when(F.col("parts") > 1, F.xxhash64("akey", F.pmod("chash", F.col("parts")))).otherwise(
        F.pmod(F.xxhash64("akey"), F.lit(shards)))
    wanted = open_.groupBy("tkey").agg(F.collect_list(F.struct("akey", "chash", "n", "parts", "ranges", "first",
                                                               shard.alias("shard"))).alias("cs"))
    length = spec.length

    def bodies(batches):
        for pdf in batches:
            rows = []
            for text, cs in zip(pdf["text"], pdf["cs"]):
                raw = text.encode()
                rows += [(c["shard"], c["akey"], c["chash"], c["n"], c["parts"], c["ranges"],
                          raw[c["first"]:c["first"] + c["n"] + length - 1]) for c in cs]
            yield pd.DataFrame(rows, columns=["shard", "akey", "chash", "n", "parts", "ranges", "body"])

    texts = needed_texts(base, wanted, spec)
    texts = texts.mapInPandas(bodies, "shard long, akey long, chash long, n long, parts long, ranges long, body binary")
    judged = stored(texts.groupBy("shard").applyInPandas(shard_judge(spec), JUDGED), "repeat-judged")
    inner = judged.filter("kind = 0").select("akey", "chash", "a", "b")
    across = judged.filter("kind = 1").groupBy("akey", "part").applyInPandas(merge_runs, "akey long, chash long, a long, b long")
    spans = whole.unionByName(inner).unionByName(across.select("akey", "chash", "a", "b"))
    at = ctx.select("tkey", "akey", "chash", "first").join(spans, ["akey", "chash"])
    return base, at.select("tkey", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))


def remove_repeats(docs: DataFrame, spec: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text",
                   with_bytes: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, and on demand the bytes that are left."""
    base, spans = repeats(docs, spec, text_col)
    spans = stored(spans.groupBy("tkey").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "repeat-spans")
    texts = needed_texts(base, spans, spec)
    cut = texts.mapInPandas(cutter(spec.length), "tkey binary, n_removed long, n_spans long, kept_sha256 string, "
                                                 "kept_bytes binary")
    more = ["kept_bytes"] if with_bytes else []
    cut = cut.select("tkey", "n_removed", "n_spans", "kept_sha256", *more)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("tkey"), F.octet_length(text).cast("long")
                       .alias("n_bytes"), F.sha2(text, 256).alias("whole"), *([text.alias("text")] if with_bytes else []))
    out = rows.join(cut, "tkey", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                      F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
                      *([F.coalesce("kept_bytes", F.col("text").cast("binary")).alias("kept_bytes")] if with_bytes else []))
