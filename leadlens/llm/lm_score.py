"""Language-model scores with a sharded Elias-Fano n-gram trie.

An n-gram model of the training texts with Dirichlet smoothing of each order towards the one below:
``P(w | u v) = (c(u, v, w) + mu * P(w | v)) / (c(u, v) + mu)``, down to the base distribution
``B(w) = (c(w) + 1/2) / (N + (V + 1) / 2)``. The part of the n-gram, ``c(u, v, w) / (c(u, v) + mu)``, is what
a trie holds, quantised to a byte; the rest follows from the counts of contexts. A text is its words (A-Z
lowered), then one end; before its first word stand as many beginnings as the order needs.

1. Texts are packed into blocks of about ``block_tokens`` tokens: the sorted hashes of the distinct words
   and the tokens as places in them. The blocks are written once, and every later step reads them.
2. Word counts: each block sends its words with their training counts to shards by hash range and gets
   the total counts back, in the same order.
3. For each order from 2 to ``order``: each block sends its distinct n-grams (sorted, with training counts)
   to shards by the context's hash. A shard adds them up, builds its trie, one level a word, and answers what
   the blocks asked: one byte an n-gram, and its count where a higher order needs it as a context's. A context
   that makes up more than a quarter of a shard's share of tokens is dealt over all shards by the next word,
   so no word or run of words makes one task large.
4. Blocks and answers meet again by block and give the scores of their texts. All joins with the blocks are in
   one plan, so that the blocks are shuffled once, whatever the order.

What is shuffled is packed, pre-aggregated arrays, never a row a token; no task holds more than a block
or a shard, whose number grows with the corpus; nothing but the totals N and V reaches the driver.

Edge cases: a null, empty or blank text is one end token; a null id counts as the empty string and is
trained on; rows that repeat an id or a text count each time; without training rows N = V = 0 and every
token has the base probability 1; an empty table gives an empty result; only id and text are read; with
``order`` 1 the score is the base score.
"""
from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ngram_trie
from .common import by_value, stored

by_value(__name__)

Trie, Quantiser, ID_MASK = ngram_trie.Trie, ngram_trie.Quantiser, ngram_trie.ID_MASK
KEY_BYTES = 7                 # a word is known by 56 bits of its hash
ID_BYTES = ngram_trie.ID_BITS // 8  # a word after its context by fewer
END, BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(x) >> 8) for x in (b" end", b" begin"))  # no word holds a space
SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Lm:
    order: int = 2
    mu: float = 12.0
    block_tokens: int = 1_000_000
    shard_tokens: int = 1_000_000
    folds: int = 5
    held: int = 1


def squeeze(a: np.ndarray) -> bytes:
    """Integers by byte planes, compressed."""
    return zlib.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 1)


def unsqueeze(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zlib.decompress(b), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def shard_of(h: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Shard by range of a hash of so many bits, so that sorted hashes fall into runs."""
    return ((h >> np.uint64(bits - 32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def cut(a: np.ndarray, size: int) -> bytes:
    """The ``size`` low bytes of each integer."""
    return a.view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def uncut(b: bytes, size: int) -> np.ndarray:
    low = np.frombuffer(b, dtype=np.uint8).reshape(-1, size)
    return np.concatenate([low, np.zeros((len(low), 8 - size), dtype=np.uint8)], axis=1).view(np.uint64).ravel()


def blocker(spec: Lm):
    """Texts to blocks: one row with the distinct words' hashes and all tokens as places among them."""
    def block(number: int, ids: list, held: list, lens: list, tokens: list) -> pd.DataFrame:
        words, places, n = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        order = np.lexsort((words, -n))  # frequent words first: their places are small numbers, which compress well
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order))
        return pd.DataFrame({"block": [number], "ids": [ids], "held": [held], "lens": [lens],
                             "words": [cut(words[order], KEY_BYTES)], "tokens": [squeeze(rank[places])]})

    def pack(batches):
        number, known = TaskContext.get().partitionId() << 32, {}
        ids, held, lens, tokens, n = [], [], [], [], 0
        for pdf in batches:
            for i, h, text in zip(pdf["doc_id"], pdf["held_out"], pdf["text"]):
                words = text.encode().lower().split() if text else []
                t = np.fromiter((known[w] if w in known else known.setdefault(w, xxhash.xxh3_64_intdigest(w) >> 8)
                                 for w in words), dtype=np.uint64, count=len(words))
                if len(known) > 200_000:
                    known.clear()
                ids.append(i)
                held.append(bool(h))
                lens.append(len(t) + 1)
                tokens.append(np.append(t, END))
                n += len(t) + 1
                if n >= spec.block_tokens:
                    yield block(number, ids, held, lens, tokens)
                    ids, held, lens, tokens, n = [], [], [], [], 0
                    number += 1
        if ids:
            yield block(number, ids, held, lens, tokens)
    return pack


def opened(r) -> tuple:
    """A block's words, tokens (as places) and which of them are trained on."""
    words = uncut(r.words, KEY_BYTES)
    tokens = unsqueeze(r.tokens, np.uint32).astype(np.int64)
    lens = np.asarray(r.lens)
    return words, tokens, lens, np.repeat(~np.asarray(r.held, dtype=bool), lens)


def word_asker(shards: int):
    def ask(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                words, tokens, _, trained = opened(r)
                counts = np.bincount(tokens[trained], minlength=len(words))
                order = np.argsort(words)
                words, counts = words[order], counts[order]
                cuts = np.searchsorted(shard_of(words, 8 * KEY_BYTES, shards), np.arange(shards + 1))
                rows += [(s, r.block, cut(words[a:b], KEY_BYTES), squeeze(counts[a:b].astype(np.uint32)))
                         for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
            yield pd.DataFrame(rows, columns=["shard", "block", "keys", "counts"])
    return ask


def count_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard's total counts, for each block in its order; ``distinct`` counts the known words once."""
    keys = [uncut(k, KEY_BYTES) for k in pdf["keys"]]
    counts = np.concatenate([unsqueeze(c, np.uint32) for c in pdf["counts"]])
    words, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(words)).astype(np.int64)
    cuts = np.cumsum([0] + [len(k) for k in keys])
    answers = [squeeze(total[place[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "answer": answers,
                         "distinct": [int((total > 0).sum())] + [0] * (len(pdf) - 1)})


def joined_answers(answers, dtype, field: str = "answer") -> np.ndarray:
    """A block's answers of all shards, put together in the order of the shards."""
    parts = [unsqueeze(a[field], dtype) for a in sorted(answers, key=lambda a: a["shard"])]
    return np.concatenate(parts) if parts else np.empty(0, dtype=dtype)


def word_counts(r, words: np.ndarray) -> np.ndarray:
    """Total counts of a block's words; the answers are in the order of the hashes."""
    counts = np.empty(len(words), dtype=np.int64)
    counts[np.argsort(words)] = joined_answers(r.word_answers, np.int64)
    return counts


@dataclass
class Grams:
    """A block's distinct n-grams of one order, sorted by shard and hashes."""
    shard: np.ndarray
    keys: list            # one array of hashes a word
    totals: np.ndarray    # the context's total count
    place: np.ndarray     # of each token's n-gram


def width(level: int) -> int:
    return ID_BYTES if level else KEY_BYTES


def grams(r, opened_block: tuple, begins: int, shards: int, total: int, upto: int):
    """Orders 2 to ``upto`` of a block; each order but the last takes the counts of its n-grams from the answers."""
    words, tokens, lens, _ = opened_block
    heads = np.concatenate([[0], np.cumsum(lens)[:-1]])
    place, counts, path = tokens, word_counts(r, words), [words]
    for order in range(2, upto + 1):
        context = np.concatenate([[-1], place[:-1]])
        context[heads] = -1  # nothing but beginnings
        pair, which = np.unique((context + 1) * (len(words) + 1) + tokens, return_inverse=True)
        ctx, nxt = pair // (len(words) + 1) - 1, pair % (len(words) + 1)
        c = np.where(ctx < 0, begins, counts[ctx])
        path = [np.where(ctx < 0, BEGIN, p[ctx]) for p in path]
        mixed = path[0]
        for p in path[1:]:
            mixed = (mixed * SCRAMBLE) ^ p
        spread = np.where(c * 4 * shards > total, words[nxt], np.uint64(0))  # the same for every block: c is the total count
        shard = shard_of((mixed ^ spread) * SCRAMBLE, 64, shards)
        path.append(words[nxt])
        keys = [p & ID_MASK if level else p for level, p in enumerate(path)]
        by = np.lexsort((*keys[::-1], shard))
        back = np.empty(len(by), dtype=np.int64)
        back[by] = np.arange(len(by))
        path, place = [p[by] for p in path], back[which]
        yield Grams(shard[by], [k[by] for k in keys], c[by], place)
        if order < upto:
            counts = joined_answers(getattr(r, f"answers_{order}"), np.int64, "counts")


def gram_asker(order: int, begins: int, shards: int, total: int):
    def ask(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                block = opened(r)
                *_, own = grams(r, block, begins, shards, total, order)
                seen = np.bincount(own.place[block[3]], minlength=len(own.shard)).astype(np.uint32)
                cuts = np.searchsorted(own.shard, np.arange(shards + 1))
                for s in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[s], cuts[s + 1]
                    change = np.any([k[a + 1:b] != k[a:b - 1] for k in own.keys[:-1]], axis=0)
                    first = np.flatnonzero(np.append(True, change))
                    rows.append((int(s), r.block, [cut(k[a:b][first], width(i)) for i, k in enumerate(own.keys[:-1])],
                                 squeeze(own.totals[a:b][first]),
                                 squeeze(np.diff(np.append(first, b - a)).astype(np.uint32)),
                                 cut(own.keys[-1][a:b], ID_BYTES), squeeze(seen[a:b])))
            yield pd.DataFrame(rows, columns=["shard", "block", "contexts", "totals", "sizes", "ids", "counts"])
    return ask


def trie_builder(order: int, mu: float, quantiser: Quantiser, counted: bool):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        """One shard: all blocks' n-grams added up, the trie built, and what each block asked looked up in it."""
        keys, c, seen, cuts = [[] for _ in range(order)], [], [], [0]
        for r in pdf.itertuples():
            sizes = unsqueeze(r.sizes, np.uint32)
            for level, packed in enumerate(r.contexts):
                keys[level].append(np.repeat(uncut(packed, width(level)), sizes))
            keys[-1].append(uncut(r.ids, ID_BYTES))
            c.append(np.repeat(unsqueeze(r.totals, np.int64), sizes))
            seen.append(unsqueeze(r.counts, np.uint32))
            cuts.append(cuts[-1] + len(seen[-1]))
        keys, c, seen = [np.concatenate(k) for k in keys], np.concatenate(c), np.concatenate(seen)
        by = np.lexsort(keys[::-1])
        new = np.append(True, np.any([k[by[1:]] != k[by[:-1]] for k in keys], axis=0))
        place = np.empty(len(by), dtype=np.int64)
        place[by] = np.cumsum(new) - 1
        first = by[new]
        keys, c = [k[first] for k in keys], c[first]
        count = np.bincount(place, weights=seen, minlength=len(first)).astype(np.int64)
        known = count > 0
        trie = Trie([k[known] for k in keys], quantiser.encode(np.log10(count[known] / (c[known] + mu))))
        found = trie.lookup(keys)[place]
        spans = list(zip(cuts[:-1], cuts[1:]))
        return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "answer": [squeeze(found[a:b]) for a, b in spans],
                             "counts": [squeeze(count[place[a:b]]) if counted else None for a, b in spans]})
    return build


def scorer(spec: Lm, quantiser: Quantiser, begins: int, shards: int, total: int, distinct: int):
    def score(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                block = opened(r)
                words, tokens, lens, _ = block
                c = word_counts(r, words)[tokens]
                heads = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
                base = (c + 0.5) / (total + 0.5 * (distinct + 1))
                p = base
                for order, own in enumerate(grams(r, block, begins, shards, total, spec.order), 2):
                    codes = joined_answers(getattr(r, f"answers_{order}"), np.uint8)
                    p = 10.0 ** quantiser.decode(codes[own.place]) + spec.mu / (own.totals[own.place] + spec.mu) * p
                yield pd.DataFrame({
                    "doc_id": pd.Series(list(r.ids), dtype=object), "held_out": r.held, "n_tokens": lens,
                    "n_known": np.add.reduceat(c > 0, heads, dtype=np.int64), "train_tokens": total,
                    "base_score": np.add.reduceat(np.log10(base), heads),
                    "score": np.add.reduceat(np.minimum(np.log10(p), 0.0), heads)})
    return score


def with_answers(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Each block with the answers of all shards as one array (one small entry a shard)."""
    own = answers.groupBy("block").agg(F.collect_list(F.struct(*(c for c in answers.columns if c != "block"))).alias(name))
    return blocks.join(own, "block")


def score(docs: DataFrame, spec: Lm = Lm(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    id_type = dict(docs.dtypes)[id_col]
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % spec.folds
    # ids go through Python as strings: a batch with a null would make numbers of them that are not exact
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), (fold == spec.held).alias("held_out"), F.col(text_col).alias("text"))
    blocks = stored(rows.mapInPandas(blocker(spec), "block long, ids array<string>, held array<boolean>, lens array<long>, "
                                                    "words binary, tokens binary"), "lm-blocks")
    zipped = F.arrays_zip("held", "lens")
    trained = F.aggregate(zipped, F.lit(0).cast("long"), lambda s, x: s + F.when(x["held"], 0).otherwise(x["lens"]))
    texts = F.aggregate("held", F.lit(0).cast("long"), lambda s, x: s + F.when(x, 0).otherwise(1))
    size = F.aggregate("lens", F.lit(0).cast("long"), lambda s, x: s + x)
    n = blocks.agg(F.sum(trained), F.sum(texts), F.sum(size)).first()
    total, begins, shards = n[0] or 0, n[1] or 0, max(1, -(-(n[2] or 0) // spec.shard_tokens))
    asked = blocks.mapInPandas(word_asker(shards), "shard long, block long, keys binary, counts binary")
    words = stored(asked.groupBy("shard").applyInPandas(count_words, "block long, shard long, answer binary, distinct long"),
                   "lm-words")
    distinct = words.agg(F.sum("distinct")).first()[0] or 0
    quantiser = Quantiser(-math.log10(total + spec.mu + 1) - 0.5)
    known = with_answers(blocks, words.select("block", "shard", "answer"), "word_answers")
    for order in range(2, spec.order + 1):
        asked = known.mapInPandas(gram_asker(order, begins, shards, total), "shard long, block long, contexts array<binary>, "
                                  "totals binary, sizes binary, ids binary, counts binary")
        codes = asked.groupBy("shard").applyInPandas(trie_builder(order, spec.mu, quantiser, order < spec.order),
                                                     "block long, shard long, answer binary, counts binary")
        known = with_answers(known, codes, f"answers_{order}")
    out = known.mapInPandas(scorer(spec, quantiser, begins, shards, total, distinct),
                            "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                            "base_score double, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))
