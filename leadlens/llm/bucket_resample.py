"""Importance resampling towards a target distribution, over hashed runs of words.

Texts are lower-cased (A-Z only) and cut into words; every run of 1 to ``ngram`` neighbouring words, joined by one
space, is a feature, and its bucket is the CRC-32 of its bytes modulo ``buckets``. A text is worth the mean of
``ln(target share / corpus share)`` over its features' buckets; adding Gumbel noise, seeded by the row's id, and taking
the highest sums draws rows without replacement with chances in proportion to their worth.

Features are found by an Aho-Corasick automaton. Texts are taken in blocks of about ``block_bytes`` bytes; the distinct
words of a block, each with a delimiter on both sides, are the dictionary, and each carries the CRC of the word, the CRC
of the word with its leading space and the length of the latter. One scan of the block emits these payloads in order,
and the CRC of a run follows from the payloads of its neighbours alone: appending ``n`` bytes to a text acts on its CRC
as a linear map over GF(2), which is looked up in a table by length. So no run is ever built as a string, memory is
bounded by a block (or by one text, where it is longer), and no dictionary of the corpus is gathered anywhere.

The buckets of each text are written once (two bytes a feature) and read by the counting and the scoring job; counts are
added up inside the tasks, so that at most ``buckets`` rows a task are shuffled and frequent words do no harm. The driver
sees the ``buckets`` counts of both sides. Ranks come from a distributed sort of (id, score).

Edge cases: a null or empty text has no words, weight 0 and no rank; a null id is the empty id for the noise and goes
last among ties; equal scores rank by the smaller id; repeated rows are rows of their own; empty tables give an empty
result, and an empty target makes every bucket's target share equal; only id and text are read, other columns cannot clash.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rank as R
from .common import by_value, stored

by_value(__name__)


@dataclass(frozen=True)
class Resample:
    buckets: int = 10_000
    ngram: int = 2
    seed: int = 7
    min_words: int = 20
    share: tuple[int, int] = (25, 100)
    block_bytes: int = 1 << 20


#: Bytes of words, lower-cased: 0-9, a-z and everything beyond ASCII; all others part words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@lru_cache(maxsize=1)
def zero_byte() -> np.ndarray:
    """What one zero byte does to each of the 32 bits of a CRC register."""
    def step(x: int) -> int:
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        return x
    return np.array([step(1 << b) for b in range(32)], dtype=np.uint32)


def apply(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The linear map given by the images of single bits, on each of ``x``."""
    out = np.zeros_like(x)
    for b in range(32):
        out ^= np.where(x >> np.uint32(b) & np.uint32(1), columns[b], np.uint32(0))
    return out


@lru_cache(maxsize=512)
def shift_table(length: int) -> np.ndarray:
    """The map of ``length`` zero bytes as four tables of 256 entries, one for each byte of the register."""
    columns, power, n = np.uint32(1) << np.arange(32, dtype=np.uint32), zero_byte(), length
    while n:
        if n & 1:
            columns = apply(power, columns)
        power, n = apply(power, power), n >> 1
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([apply(columns, byte << np.uint32(8 * k)) for k in range(4)])


def appended(crc: np.ndarray, tail_crc: np.ndarray, tail_length: np.ndarray) -> np.ndarray:
    """CRCs of texts that are followed by tails, from the CRCs of both and the tails' lengths."""
    lengths, which = np.unique(tail_length, return_inverse=True)
    tables = np.stack([shift_table(int(n)) for n in lengths])
    parts = [tables[which, k, crc >> np.uint32(8 * k) & np.uint32(255)] for k in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3] ^ tail_crc


def payloads(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One scan of ``text`` (bytes as characters, words parted by spaces): per word its end, its CRC, and the CRC and
    length of the word with its leading space."""
    words = list(set(text.split(" ")) - {""})  # at spaces only: other bytes may look like white space
    if not words:
        none = np.zeros(0, dtype=np.uint32)
        return np.zeros(0, dtype=np.int64), none, none, np.zeros(0, dtype=np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, w in enumerate(words):
        automaton.add_word(f" {w} ", i)
    automaton.make_automaton()
    raw = [w.encode("latin-1") for w in words]
    alone = np.array([zlib.crc32(w) for w in raw], dtype=np.uint32)
    space = zlib.crc32(b" ")
    spaced = np.array([zlib.crc32(w, space) for w in raw], dtype=np.uint32)
    length = np.array([len(w) + 1 for w in raw], dtype=np.int64)
    hits = np.fromiter(chain.from_iterable(automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
    return hits[:, 0], alone[hits[:, 1]], spaced[hits[:, 1]], length[hits[:, 1]]


def block_buckets(texts: list[bytes], spec: Resample) -> list[tuple[int, bytes]]:
    """Number of words and buckets of all features, per text of one block."""
    texts = [t.translate(WORD_BYTES) for t in texts]
    ends, alone, spaced, length = payloads((b" " + b" ".join(texts) + b" ").decode("latin-1"))
    edges = np.cumsum([1, *(len(t) + 1 for t in texts)])
    # a word of a text ends before the delimiter that follows the text
    at = np.searchsorted(ends, edges, side="left")
    at[1:] = np.searchsorted(ends, edges[1:] - 1, side="right")
    small = np.uint16 if spec.buckets <= 1 << 16 else np.uint32
    runs, crc = [], alone
    for k in range(spec.ngram):
        if k:
            crc = appended(crc[:-1], spaced[k:], length[k:]) if len(crc) > 1 else crc[:0]
        runs.append((crc % np.uint32(spec.buckets)).astype(small))
    out = []
    for i in range(len(texts)):
        a, b = int(at[i]), int(at[i + 1])
        out.append((b - a, b"".join(r[a:b - k].tobytes() for k, r in enumerate(runs) if b - k > a)))
    return out


def in_blocks(batches: Iterator[pd.DataFrame], spec: Resample) -> Iterator[tuple[list, list[tuple[int, bytes]]]]:
    """Ids and features of the texts, block by block."""
    ids: list = []
    held: list[bytes] = []
    size = 0
    for pdf in batches:
        for i, t in zip(pdf["id"], pdf["text"]):
            ids.append(i)
            held.append((t or "").encode())
            size += len(held[-1])
            if size >= spec.block_bytes:
                yield ids, block_buckets(held, spec)
                ids, held, size = [], [], 0
    if ids:
        yield ids, block_buckets(held, spec)


def featuriser(spec: Resample):
    def run(batches):
        for ids, found in in_blocks(batches, spec):
            yield pd.DataFrame({"id": ids, "n_words": [n for n, _ in found], "features": [f for _, f in found]})
    return run


def counter(spec: Resample):
    """Counts of one task's buckets, as at most ``buckets`` rows."""
    def run(batches):
        total = np.zeros(spec.buckets, dtype=np.int64)
        for pdf in batches:
            for f in pdf["features"]:
                total += np.bincount(unpack(f, spec), minlength=spec.buckets)
        yield pd.DataFrame({"bucket": np.flatnonzero(total), "n": total[total > 0]})
    return run


def unpack(features: bytes, spec: Resample) -> np.ndarray:
    return np.frombuffer(features, dtype=np.uint16 if spec.buckets <= 1 << 16 else np.uint32)


def featurised(rows: DataFrame, spec: Resample, id_col: str, text_col: str) -> DataFrame:
    """id, n_words and packed buckets of each row, as a stored table."""
    picked = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return stored(picked.mapInPandas(featuriser(spec), "id string, n_words long, features binary"), "resample")


def bucket_counts(features: DataFrame, spec: Resample) -> np.ndarray:
    part = features.select("features").mapInPandas(counter(spec), "bucket long, n long")
    out = np.zeros(spec.buckets, dtype=np.int64)
    for r in part.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down, per bucket."""
    s_all, t_all, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(float((int(t) + 1) * (s_all + n)) / float((int(s) + 1) * (t_all + n))))
                     for s, t in zip(corpus, target)], dtype=np.int64)


def weigher(gain: np.ndarray, spec: Resample):
    size = 2 if spec.buckets <= 1 << 16 else 4

    def weigh(features: pd.Series) -> pd.DataFrame:
        n = [len(f) // size for f in features]
        w = [int(gain[unpack(f, spec)].sum()) // k if k else 0 for f, k in zip(features, n)]
        return pd.DataFrame({"n_features": n, "weight": w})
    return F.pandas_udf(weigh, "n_features long, weight long")


def resample(corpus: DataFrame, target: DataFrame, spec: Resample = Resample(), id_col: str = "doc_id",
             text_col: str = "text", target_id: str = "item_id", target_text: str = "text") -> DataFrame:
    """Per row of ``corpus``: doc_id, n_features, weight, score and, if drawn, rank; n_words follows."""
    own = featurised(corpus, spec, id_col, text_col)
    gain = gains(bucket_counts(own, spec), bucket_counts(featurised(target, spec, target_id, target_text), spec))
    kind = dict(corpus.dtypes)[id_col]
    rows = own.select("id", "n_words", weigher(gain, spec)(F.col("features")).alias("w"))
    key = F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("id"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = rows.select(F.col("id").cast(kind).alias("doc_id"), F.col("w")["n_features"].alias("n_features"),
                       F.col("w")["weight"].alias("weight"), (F.col("w")["weight"] + noise).alias("score"), "n_words")
    able = F.col("n_words") >= spec.min_words
    ranked = R.running_totals(rows.filter(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                                                  F.col("weight"), F.col("n_features")])
    drawn = spec.share[0] * ranked.n() // spec.share[1]
    out = ranked.frame.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long")))
    rest = rows.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    return out.select(*names).unionByName(rest.select(*names))
