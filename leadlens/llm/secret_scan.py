"""Secret scan: base patterns plus a log-likelihood ratio of two character Markov models.

The labelled samples are taken from the whole table: the values that the base patterns find are random, the other
runs of identifier characters are ordinary. Random values are of two kinds with a model each, hexadecimal ones and all
others, as the one would rule a common model by its number; a value counts once a text, however many patterns find it.
The classes are reduced to counts of character pairs (at most ``3 * 69 * 69`` rows), from which three smoothed first-order
models follow. A run of ``min_run`` characters or more outside the base spans is a secret when the ratio of its likelihoods
under the better random model and the ordinary one is at least ``threshold`` nats and ``per_char`` nats a character. A run that base spans touch is
cut at them, as it is for the samples, and each part outside is judged by itself, without the signs that
join it to the span (a "/" at the edge would speak against a key that it only sets off).

Only pair counts are shuffled; each text is judged on its own row, so size and skew do not matter.

Edge cases: a null or empty text has no spans; without a labelled sample of a class its model is
uniform; repeated rows are judged alike and each counts as a sample; an empty table gives an empty
result; offsets are code points, ends exclusive; no input column is replaced but ``text`` in ``redact``.
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, giving_back, small_batches

by_value(__name__)

# The base patterns as stated, in the order of their kinds, with the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
HEX_ONLY = re.compile(r"[0-9a-f]+")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "markov")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
JOINERS = "+/_=-"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
EDGE = len(ALPHABET)          # before the first and after the last character
SIZE = EDGE + 1
SMOOTH = 200.0                # how many pairs the smoothing of a row counts as; one sample must not outweigh it
CODE = np.full(256, EDGE, dtype=np.int64)
CODE[list(ALPHABET.encode())] = np.arange(EDGE)
# The same character classes on UTF-8 bytes: "x" for a member, a space for any other byte.
HEX_MAP = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
RUN_MAP = bytes(120 if re.match(rb"[A-Za-z0-9+/_=-]", bytes([c])) else 32 for c in range(256))
RUN_ONLY = bytes(c if RUN_MAP[c] == 120 else 32 for c in range(256))
SPANS = "n_assign long, n_access long, n_hex long, base string, spans string"


@dataclass(frozen=True)
class SecretScan:
    min_run: int = 16
    threshold: float = 8.0
    per_char: float = 0.35
    mark: str = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches. A match that is too short is dropped, with what it took."""
    out = []
    raw = text.encode()
    low = raw.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"x" * 24 in raw.translate(HEX_MAP):  # maximal runs: the same as all runs, short ones dropped
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def secret_value(text: str, span: tuple[int, int, int]) -> str:
    start, kind, end = span
    return ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end]


def gaps(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the stretches that no span covers; the spans are in order."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out.append((at, start))
        at = max(at, end)
    return [*out, (at, len(text))]


def outside(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with a space for each base span."""
    return " ".join(text[a:b] for a, b in gaps(text, spans))


def pair_counts(samples: Counter) -> np.ndarray:
    """Counts of character pairs, edges included, over weighted samples."""
    total = np.zeros(SIZE * SIZE)
    if samples:
        codes = CODE[np.frombuffer(b"\n" + b"\n".join(samples) + b"\n", dtype=np.uint8)]
        weights = np.fromiter(samples.values(), dtype=float)
        pairs = codes[:-1] * SIZE + codes[1:]
        # a pair belongs to the sample of its second character; the closing edge to the one that it closes
        starts = np.cumsum(codes[:-1] == EDGE) - 1
        total = np.bincount(pairs, weights=weights[starts], minlength=SIZE * SIZE)
    return total


def sample_counts(batches):
    """Pair counts of one partition's labelled samples, one row per class (hexadecimal, other random, ordinary) and pair."""
    total = np.zeros((3, SIZE * SIZE))
    for pdf in batches:
        hexes, random, ordinary = Counter(), Counter(), Counter()
        for text in pdf["text"]:
            if text:
                spans = base_spans(text)
                for v in {secret_value(text, s) for s in spans}:
                    (hexes if HEX_ONLY.fullmatch(v) else random)[v.encode()] += 1
                words = (outside(text, spans) if spans else text).encode().translate(RUN_ONLY).split()
                ordinary.update(w for w in words if len(w) >= 8)
        total += [pair_counts(hexes), pair_counts(random), pair_counts(ordinary)]
    cls, pair = np.nonzero(total)
    yield pd.DataFrame({"cls": cls, "pair": pair, "n": total[cls, pair].astype(np.int64)})


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-likelihood ratio of every character pair, hexadecimal and other random values over ordinary runs."""
    texts = small_batches(docs).select(F.col(text_col).alias("text"))
    counted = texts.mapInPandas(giving_back(sample_counts), "cls long, pair long, n long")
    counts = np.zeros((3, SIZE, SIZE))
    for r in counted.groupBy("cls", "pair").agg(F.sum("n").alias("n")).collect():
        counts[r["cls"], r["pair"] // SIZE, r["pair"] % SIZE] += r["n"]
    # pairs are smoothed by single characters, and these by one of each, so that no pair is impossible
    single = counts.sum(axis=1, keepdims=True) + 1
    single /= single.sum(axis=2, keepdims=True)
    logp = np.log((counts + SMOOTH * single) / (counts.sum(axis=2, keepdims=True) + SMOOTH))
    return logp[:2] - logp[2]


def ratio(run: str, llr: np.ndarray) -> float:
    c = np.concatenate([[EDGE], CODE[np.frombuffer(run.encode(), dtype=np.uint8)], [EDGE]])
    return float(llr[:, c[:-1], c[1:]].sum(axis=1).max())


def all_spans(text: str, llr: np.ndarray, spec: SecretScan) -> tuple[list, list]:
    base = base_spans(text)
    more = []
    for begin, close in gaps(text, base) if b"x" * spec.min_run in text.encode().translate(RUN_MAP) else ():
        for m in RUN.finditer(text, begin, close):
            run, end = m.group(), m.end()
            if end == close < len(text):
                run = run.rstrip(JOINERS)
                end = m.start() + len(run)
            if m.start() == begin > 0:
                run = run.lstrip(JOINERS)
            n = len(run)
            if n >= spec.min_run:
                score = ratio(run, llr)
                if score >= spec.threshold and score >= spec.per_char * n:
                    more.append((end - n, 3, end))
    return base, sorted(base + more)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, spec: SecretScan = SecretScan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256 and all spans."""
    llr = train(docs, text_col)

    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, spans = all_spans(text or "", llr, spec)
            kinds = [k for _, k, _ in base]
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), joined(base), joined(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    out = docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(judge, SPANS)(F.col(text_col)).alias("s"))
    return out.select("doc_id", "s.n_assign", "s.n_access", "s.n_hex", F.sha2(F.col("s.base"), 256).alias("base_sha256"),
                      "s.spans")


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, spec: SecretScan = SecretScan(), text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``spec.mark``; null texts and clean texts stay as they are."""
    llr = train(docs, text_col)

    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([t if not t else redact_text(t, all_spans(t, llr, spec)[1], spec.mark) for t in texts],
                         dtype=object)

    return docs.withColumn(text_col, F.pandas_udf(clean, "string")(F.col(text_col)))


def sha256_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
