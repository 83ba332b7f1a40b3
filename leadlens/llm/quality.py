"""Quality rules under weak supervision.

Each rule votes good, bad or abstains on a text. How often each rule votes so on good and on bad texts
(its accuracy in either class) is estimated by expectation-maximisation over the vote patterns of the
whole table, starting from "bad where any rule says bad", and a text is kept when its posterior
probability of being good reaches ``keep_at`` (and the base rule, fewer than 50 words or more than half
of them in repeated windows, has not failed it).

Votes depend on one text each. The table is reduced to counts of vote patterns (at most
``3 ** len(RULES)`` rows, whatever its size) before anything reaches the driver; the posterior of each
pattern goes back by a broadcast join with as many rows, so no text is shuffled.

Edge cases: a null or empty text has no words, counts 0 and fails the base rule; repeated rows are
judged alike and each counts in the estimate; an empty table gives an empty result; columns that are
added on the way have names that the input does not use.
"""
from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, free_names, small_batches, stored

by_value(__name__)

SPACES, SYMBOLS, UPPER_CHARS, DIGITS = b" \t\n\v\f\r", b"#*$%&|<>", bytes(range(65, 91)), b"0123456789"
ENDS = (b".", b"!", b"?", b'"', b":", b";")
# Very frequent words of the four languages of the corpus.
STOP_WORDS = frozenset("the of and to in a is that for it as was with be by on not he his but at are this have from "
                       "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
                       "de la le et les des en un du une que est pour qui dans par plus pas au sur "
                       "el y los del las se por con no para su al lo como más".encode().split())
TEMP = "measures"
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ", ".join(f"{m} long" for m in METRICS) + ", votes string"


@dataclass(frozen=True)
class Model:
    """Share of good texts; per class (bad, good) and rule the chances of the votes; posterior by vote pattern."""
    good: float
    votes: np.ndarray
    posterior: dict


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    n = Counter(windows)
    hit = np.zeros(len(words) + 3, dtype=bool)
    at = np.flatnonzero([n[w] > 1 for w in windows])
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def dup_lines(lines: list[bytes]) -> int:
    """Lines with a word that equal an earlier line."""
    if len(set(lines)) == len(lines):
        return 0
    return sum(n - 1 for x, n in Counter(lines).items() if n > 1 and x.split())


def vote(bad: bool, good: bool) -> str:
    return "-" if bad else "+" if good else "0"


def among(raw: bytes, chars: bytes) -> int:
    """Bytes of ``raw`` that are among the ASCII characters ``chars``."""
    return len(raw) - len(raw.translate(None, chars))


def measure(text: str | None) -> tuple:
    """The base counts of a text and one vote per rule. Words are cut on UTF-8 bytes, where the white space of
    ``bytes.split`` is just the six characters that part words."""
    text = text or ""
    raw = text.encode()
    words, lines = raw.split(), raw.split(b"\n")
    n, chars = len(words), len(text) - among(raw, SPACES)
    symbols, dups, repeats = among(raw, SYMBOLS), dup_lines(lines), repeat_words(words)
    upper = among(raw, UPPER_CHARS)
    stops = sum(map(STOP_WORDS.__contains__, words))
    ended = sum(x.rstrip().endswith(ENDS) for x in lines)
    digits = sum(map(bool, (among(w, DIGITS) for w in set(words)))) if among(raw, DIGITS) else 0
    m = max(n, 1)
    votes = "".join((
        vote(n < 50, n >= 80),                                         # length
        vote(repeats > 0.3 * m, repeats <= 0.1 * m),                   # repeated windows
        vote(dups > max(2, 0.3 * len(lines)), dups <= 0.1 * len(lines)),  # repeated lines
        vote(symbols > 0.1 * m, symbols <= 0.03 * m),                  # symbols
        vote(not 3 <= chars / m <= 12, 4 <= chars / m <= 9),           # word length
        vote(upper > 0.3 * max(chars, 1), upper <= 0.1 * max(chars, 1)),  # capitals
        vote(stops < 0.02 * m, stops >= 0.06 * m),                     # function words
        vote(ended < 0.3 * len(lines), ended >= 0.7 * len(lines)),     # lines that end as sentences do
        vote(digits > 0.2 * m, digits <= 0.05 * m),                    # numbers
    ))
    return n, chars, symbols, dups, repeats, votes


def metrics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=[*METRICS, "votes"])


def measured(docs: DataFrame, text_col: str = "text", name: str = TEMP) -> DataFrame:
    udf = F.pandas_udf(metrics, SCHEMA)
    return small_batches(docs).withColumn(name, udf(F.col(text_col)))


def estimate(patterns: dict[str, int], n_rules: int, rounds: int = 500, tol: float = 1e-8) -> Model:
    """Expectation-maximisation over counted vote patterns. In either class a rule votes by chances of its own; a
    vote for bad is held to be at least as likely on bad texts, which also keeps the classes from changing places."""
    keys = sorted(patterns)
    one = np.array([[[c == k for k in "-0+"] for c in key] for key in keys], dtype=float).reshape(len(keys), n_rules, 3)
    w = np.array([patterns[k] for k in keys], dtype=float)
    p = np.where(one[:, :, 0].any(axis=1), 0.1, 0.95)  # of being good
    good, chances = 0.75, np.full((2, n_rules, 3), 1 / 3)
    for _ in range(rounds if len(keys) else 0):
        share = [np.einsum("k,kjv->jv", w * q, one) + 0.5 for q in (1 - p, p)]
        chances = np.stack([x / x.sum(axis=1, keepdims=True) for x in share])
        wrong = chances[0, :, 0] < chances[1, :, 0]
        chances[:, wrong] = chances[:, wrong].mean(axis=0)
        good = float((w @ p + 1) / (w.sum() + 2))
        odds = math.log(good / (1 - good)) + np.einsum("kjv,jv->k", one, np.log(chances[1] / chances[0]))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        moved, p = np.abs(new - p).max(), new
        if moved < tol:
            break
    return Model(good, chances, dict(zip(keys, p.tolist())))


def fit(rows: DataFrame) -> Model:
    """``rows`` hold the measured struct; what comes back is one count per vote pattern."""
    counts = rows.groupBy(f"{TEMP}.votes").agg(F.count(F.lit(1)).alias("n")).collect()
    return estimate({r["votes"]: r["n"] for r in counts}, len(measure("")[-1]))


def base_failed(name: str = TEMP):
    q = F.col(name)
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def verdict(rows: DataFrame, model: Model, keep_at: float, name: str = TEMP) -> tuple[DataFrame, str, Column]:
    """The rows with their posterior, the name of its column, and whether a row is kept."""
    votes, post = free_names(rows.columns, 2)
    table = rows.sparkSession.createDataFrame(sorted(model.posterior.items()), f"{votes} string, {post} double")
    out = rows.join(F.broadcast(table), F.col(name)["votes"] == F.col(votes), "left").drop(votes)
    return out, post, ~base_failed(name) & (F.col(post) >= keep_at)


def rate(docs: DataFrame, keep_at: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the base counts, base_failed, kept and the posterior."""
    rows = stored(measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
                  .select("doc_id", TEMP), "quality")
    rows, post, kept = verdict(rows, fit(rows), keep_at)
    return rows.select("doc_id", *[F.col(TEMP)[m].alias(m) for m in METRICS], base_failed().alias("base_failed"),
                       kept.alias("kept"), F.col(post).alias("posterior"))


def keep_good(docs: DataFrame, keep_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns. The texts are measured twice, once for the
    estimate and once for the verdict, instead of being shuffled or stored."""
    columns = docs.columns
    model = fit(measured(docs.select(F.col(text_col).alias("text"))))
    name = free_names(columns, 1)[0]
    rows, _, kept = verdict(measured(docs, text_col, name), model, keep_at, name)
    return rows.filter(kept).select(*columns)
