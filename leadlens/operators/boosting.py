"""Gradient-boosted trees over a binned matrix, many models in one pass.

Rows are packed once into blocks of integer codes: a numeric feature has one code per quantile bin and code 0 for
missing, a categorical one has one code per vocabulary slot. A tree level needs, for each node, the sums of gradients and
hessians by (feature, code) — the histogram — from which every split is judged: numeric cuts with the missing rows on
either side (the better side is learned), and one-slot-against-the-rest for categories. Splits maximise the regularised
gain with L1 (``reg_alpha``) and L2 (``reg_lambda``) terms, ``min_child_weight`` and bottom-up pruning by ``gamma``.

* **Many models at a time.** Models differ in parameters, seed, class weight, held-out fold and data group (an encoded
  data set, such as one seeded split). A pass over the blocks fills the histograms of all of them, keyed by model.
* **Exact sums.** Gradients and hessians are rounded to 2**-20 and added as integers, so a model does not depend on how
  rows are dealt, on retries or on the number of executors. Row sampling hashes the row and the round, column sampling
  the seed and the round.
* **Growing by level.** Per level one job: tasks add up their blocks' histograms, one shuffle adds these by (model, node,
  cell), and one group a model (cells of its open nodes; bounded by depth and codes, not by rows) picks the splits. What
  reaches the driver is one row an open node. Rows' margins are stored every ``refresh`` rounds, newer trees are applied
  on the fly. A group of up to 2**22 rows and 2**25 codes is one block and has its whole histogram there, so its models
  grow without exchange, dealt over the tasks; both ways have the same sums and give the same trees. Rows of a block with
  equal codes end in the same leaves, so they are one row there, with the number of its drawn rows by label; the models of a
  task grow round by round together and share the hash that samples rows.
* **Early stopping that stops.** After each round the model's evaluation rows are counted by margin (rounded to 2**-12)
  and the step-wise average precision follows; a model that has not improved for ``patience`` rounds is not grown further.

Margins start at 0. Rows without a label do not take part. Slots of a categorical feature should stay below some 100,000, as
a histogram has a cell for each.
"""
from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, scratch_path
from .rank import running_totals

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

UNIT = float(1 << 20)      # gradients are counted in units of 1 / UNIT
GRID = float(1 << 12)      # margins of evaluation rows are counted in steps of 1 / GRID
LEAST_GAIN = 1e-6
MAX_BINS = 256
WHOLE_ROWS, WHOLE_CODES = 1 << 22, 1 << 25  # a group up to this size is one block
BLOCK_ROWS = 1 << 16                        # rows a block of a larger group
MOST_JOINED = 1 << 12                       # combinations of the codes of features that are added up together
TRAIN, EVAL, TEST = 0, 1, 2
BLOCK = "group int, n int, size int, codes binary, y binary, part binary, fold binary, uid binary, margins binary"


@dataclass(frozen=True)
class Task:
    """One model to grow: on part ``TRAIN`` of its group, watched on ``EVAL``; with a ``fold``, on the other folds of
    ``TRAIN`` and watched on that one; with ``everything``, on all rows."""
    model: int
    group: int
    params: dict
    rounds: int
    pos_weight: float = 1.0
    seed: int = 0
    fold: int | None = None
    patience: int | None = None
    everything: bool = False
    watch: bool = True  # evaluate after every round (else only after the last)
    keep: bool = True   # the trees are wanted (else only the evaluations)

    @property
    def depth(self) -> int:
        return int(self.params.get("max_depth", 6))

    def param(self, name: str, default: float) -> float:
        return float(self.params.get(name, default))


@dataclass
class Layout:
    """Histogram cells of a data group: features one after the other, each with its codes."""
    num: list[str]
    cat: list[str]
    cuts: dict[str, np.ndarray]   # numeric: upper bounds of bins, code k is (cuts[k-2], cuts[k-1]]
    sizes: dict[str, int]         # categorical: slots; the code after them is a level never seen

    def __post_init__(self):
        width = [len(self.cuts[c]) + 1 for c in self.num] + [self.sizes[c] + 1 for c in self.cat]
        self.offset = np.concatenate([[0], np.cumsum(width)]).astype(np.int64)
        self.width = int(self.offset[-1])
        feature, code, column = [], [], []
        n_columns = 0
        for f, w in enumerate(width):
            numeric = f < len(self.num)
            codes = np.arange(1, w) if numeric else np.arange(0, w - 1)
            feature.append(np.full(len(codes), f))
            code.append(codes)
            column.append(np.full(len(codes), n_columns) if numeric else n_columns + codes)
            n_columns += 1 if numeric else len(codes)
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        self.split_feature, self.split_code, self.split_column = join(feature), join(code), join(column)
        self.n_columns = n_columns
        self.split_cell = self.offset[self.split_feature] + self.split_code
        self.split_start = self.offset[self.split_feature]
        self.split_numeric = self.split_feature < len(self.num)

    @property
    def n_features(self) -> int:
        return len(self.num) + len(self.cat)

    def codes(self, pdf: pd.DataFrame) -> np.ndarray:
        """Codes of rows with numerics under their names (missing: NaN) and slots under ``<name>__idx``."""
        out = np.empty((len(pdf), self.n_features), dtype=np.int32)
        for f, c in enumerate(self.num):
            x = pdf[c].to_numpy(dtype=float, na_value=np.nan)
            k = np.minimum(np.searchsorted(self.cuts[c], x, side="left") + 1, len(self.cuts[c]))
            out[:, f] = np.where(np.isnan(x), 0, k)
        for f, c in enumerate(self.cat, len(self.num)):
            x = pdf[f"{c}__idx"].to_numpy(dtype=float, na_value=np.nan)
            out[:, f] = np.where(np.isnan(x), self.sizes[c], x).astype(np.int32)
        return out


# ----------------------------------------------------------------------------- one tree

@dataclass
class Tree:
    """Nodes in heap order (root 1, children 2i and 2i + 1); ``feature`` -1 marks a leaf."""
    feature: np.ndarray
    code: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 1 << (depth + 1)
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def descend(self, node: np.ndarray, codes: np.ndarray, n_num: int) -> np.ndarray:
        """One step down for the rows whose node is split."""
        f = self.feature[node]
        c = codes[np.arange(len(node)), np.maximum(f, 0)]
        numeric = np.where(c == 0, self.missing_left[node], c <= self.code[node])
        left = np.where(f >= n_num, c == self.code[node], numeric)
        return np.where(f >= 0, 2 * node + 1 - left, node)

    def leaves(self, codes: np.ndarray, n_num: int) -> np.ndarray:
        """Node in which each row ends; of a tree that is still growing, the open node."""
        node = np.ones(len(codes), dtype=np.int64)
        for _ in range(self.depth if codes.shape[1] else 0):
            node = self.descend(node, codes, n_num)
        return node

    def ends(self, flat: np.ndarray, start: np.ndarray, n_num: int) -> np.ndarray:
        """``leaves`` of rows whose codes start at ``start`` in ``flat``: a row goes left where its code is in the node's
        range, one code of a category or those up to a numeric cut, and a leaf leads to itself."""
        node = np.arange(len(self.feature))
        inner = self.feature >= 0
        f = np.where(inner, self.feature, 0).astype(np.int64)
        least = np.where(f >= n_num, self.code, np.where(self.missing_left, 0, 1))
        kids = np.stack([np.where(inner, 2 * node, node), np.where(inner, 2 * node + 1, node)], axis=1).ravel()
        at = np.ones(len(start), np.int64)
        for _ in range(self.depth):
            code = flat.take(start + f.take(at))
            right = (code < least.take(at)) | (code > self.code.take(at))
            at = kids.take(2 * at + right)
        return at

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 2

    def pruned(self, gamma: float) -> "Tree":
        """Without splits of less gain than ``gamma``, from the bottom up."""
        for i in range(len(self.feature) // 2 - 1, 0, -1):
            if self.feature[i] >= 0 and self.feature[2 * i] < 0 and self.feature[2 * i + 1] < 0 and self.gain[i] < gamma:
                self.feature[i] = -1
        return self


def shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def leaf_value(g, h, task: Task):
    return (0 - shrunk(g, task.param("reg_alpha", 0))) / (h + task.param("reg_lambda", 1)) * task.param("learning_rate", 0.3)


def allowed_splits(layout: Layout, task: Task, rnd: int) -> np.ndarray:
    """Splits on the columns drawn for this tree."""
    share = task.param("colsample_bytree", 1)
    if share >= 1 or not layout.n_columns:
        return np.ones(len(layout.split_cell), dtype=bool)
    drawn = np.zeros(layout.n_columns, dtype=bool)
    rng = np.random.default_rng([task.seed, rnd])
    drawn[rng.permutation(layout.n_columns)[:max(1, int(share * layout.n_columns))]] = True
    return drawn[layout.split_column]


def best_splits(g: np.ndarray, h: np.ndarray, layout: Layout, task: Task, allowed: np.ndarray) -> dict[str, np.ndarray]:
    """The best split of each node from its histogram (nodes x cells, in units); feature -1 where none gains."""
    n = len(g)
    first = slice(0, int(layout.offset[1])) if layout.n_features else slice(0, 0)
    gt, ht = g[:, first].sum(axis=1), h[:, first].sum(axis=1)
    if not len(layout.split_cell):
        none = np.zeros(n, np.int64)
        return {"g": gt, "h": ht, "feature": none - 1, "code": none, "missing_left": none > 0, "gain": none * 0.0, "gl": none, "hl": none}
    alpha, lam, least = task.param("reg_alpha", 0), task.param("reg_lambda", 1), task.param("min_child_weight", 1)
    score = lambda a, b: shrunk(a / UNIT, alpha) ** 2 / (b / UNIT + lam)
    sides = []
    for x in (g, h):
        total = np.cumsum(x, axis=1)
        left = np.where(layout.split_numeric, total[:, layout.split_cell] - total[:, layout.split_start], x[:, layout.split_cell])
        missing = np.where(layout.split_numeric, x[:, layout.split_start], 0)
        sides.append(np.stack([left, left + missing], axis=2).reshape(n, -1))  # missing to the right, to the left
    gl, hl = sides
    gr, hr = gt[:, None] - gl, ht[:, None] - hl
    fits = (hl >= least * UNIT) & (hr >= least * UNIT) & (hl > 0) & (hr > 0) & np.repeat(allowed, 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, score(gl, hl) + score(gr, hr) - score(gt, ht)[:, None], -np.inf)
    best = gain.argmax(axis=1)
    rows = np.arange(n)
    good = gain[rows, best] > LEAST_GAIN
    at = best // 2
    return {"g": gt, "h": ht, "feature": np.where(good, layout.split_feature[at], -1), "code": layout.split_code[at],
            "missing_left": (best % 2 == 1) & layout.split_numeric[at], "gain": np.where(good, gain[rows, best], 0),
            "gl": gl[rows, best], "hl": hl[rows, best]}


def place(tree: Tree, nodes: np.ndarray, found: dict[str, np.ndarray], task: Task, last: bool) -> np.ndarray:
    """Write the splits of ``nodes`` and the values of their children into the tree; the children that are open."""
    g, h = found["g"], found["h"]
    tree.cover[nodes], tree.value[nodes] = h / UNIT, leaf_value(g / UNIT, h / UNIT, task)
    split = found["feature"] >= 0
    at = nodes[split]
    for name in ("feature", "code", "missing_left", "gain"):
        getattr(tree, name)[at] = found[name][split]
    gl, hl = found["gl"][split], found["hl"][split]
    for child, a, b in ((2 * at, gl, hl), (2 * at + 1, g[split] - gl, h[split] - hl)):
        tree.cover[child], tree.value[child] = b / UNIT, leaf_value(a / UNIT, b / UNIT, task)
    return np.zeros(0, np.int64) if last else np.sort(np.concatenate([2 * at, 2 * at + 1]))


# ----------------------------------------------------------------------------- rows of a block

@dataclass
class Rows:
    codes: np.ndarray
    y: np.ndarray
    part: np.ndarray
    fold: np.ndarray
    uid: np.ndarray

    @classmethod
    def of(cls, r) -> "Rows":
        return cls(np.frombuffer(r.codes, f"u{r.size}").reshape(r.n, -1).astype(np.int32), np.frombuffer(r.y, np.int8), np.frombuffer(r.part, np.int8),
                   np.frombuffer(r.fold, np.int16), np.frombuffer(r.uid, np.int64))

    def trains(self, task: Task) -> np.ndarray:
        if task.everything:
            return np.ones(len(self.y), dtype=bool)
        return (self.part == TRAIN) & (task.fold is None or self.fold != task.fold)

    def watched(self, task: Task) -> np.ndarray:
        if task.everything:
            return np.zeros(len(self.y), dtype=bool)
        return self.part == EVAL if task.fold is None else (self.part == TRAIN) & (self.fold == task.fold)


def mixed(uid: np.ndarray, seed: int, rnd: int) -> np.ndarray:
    """A hash of row, seed and round."""
    mix = (seed * 0x9E3779B97F4A7C15 + (rnd + 1) * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1)
    with np.errstate(over="ignore"):
        x = uid.view(np.uint64) ^ np.uint64(mix)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
    return x


def drawn_below(share: float) -> np.uint64:
    return np.uint64(min(int(share * 2 ** 64), 2 ** 64 - 1))


def drawn(uid: np.ndarray, task: Task, rnd: int) -> np.ndarray:
    """Rows sampled for a round: a hash of row, seed and round below the share."""
    share = task.param("subsample", 1)
    return np.ones(len(uid), dtype=bool) if share >= 1 else mixed(uid, task.seed, rnd) < drawn_below(share)


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


def units_of(y, p: np.ndarray, task: Task) -> tuple[np.ndarray, np.ndarray]:
    w = np.where(y == 1, task.pos_weight, 1.0)
    return np.rint((p - y) * w * UNIT), np.rint(np.maximum(p * (1 - p), 1e-16) * w * UNIT)


def gradient_units(y: np.ndarray, margin: np.ndarray, task: Task) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians in units."""
    return units_of(y, probability(margin), task)


def gradients(rows: Rows, margin: np.ndarray, task: Task, rnd: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the rows that a round trains on, and their gradients and hessians in units."""
    at = np.flatnonzero(rows.trains(task) & drawn(rows.uid, task, rnd))
    return at, *gradient_units(rows.y[at], margin[at], task)


def histogram(codes: np.ndarray, node: np.ndarray, nodes: np.ndarray, g: np.ndarray, h: np.ndarray,
              layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Sums by (open node, cell)."""
    slot = np.searchsorted(nodes, node)
    slot[slot == len(nodes)] = 0
    here = nodes[slot] == node
    cell = (slot[here, None] * layout.width + layout.offset[:-1][None, :] + codes[here]).ravel()
    size, k = len(nodes) * layout.width, layout.n_features
    sums = [np.bincount(cell, weights=np.repeat(x[here], k), minlength=size) for x in (g, h)]
    return tuple(s.astype(np.int64).reshape(len(nodes), layout.width) for s in sums)


def counts_of(y: np.ndarray, margin: np.ndarray) -> pd.DataFrame:
    """Positives and negatives by rounded margin."""
    y = y == 1
    return counted(margin, y.astype(np.int64), (~y).astype(np.int64))


def counted(margin: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> pd.DataFrame:
    step = np.rint(margin * GRID).astype(np.int64)
    return pd.DataFrame({"idx": step, "g": pos, "h": neg}).groupby("idx", as_index=False).sum()


def watched_counts(rows: Rows, margin: np.ndarray, task: Task) -> pd.DataFrame:
    """Positives and negatives of the evaluation rows by rounded margin."""
    at = rows.watched(task)
    return counts_of(rows.y[at], margin[at])


def average_precision(counts: pd.DataFrame) -> float:
    """Step-wise average precision of (idx, positives g, negatives h); NaN without positives."""
    c = counts.sort_values("idx", ascending=False)
    pos, all_ = np.cumsum(c["g"].to_numpy()), np.cumsum((c["g"] + c["h"]).to_numpy())
    if not len(pos) or pos[-1] == 0:
        return float("nan")
    return float((c["g"].to_numpy() / pos[-1] * (pos / all_)).sum())


def finished(history: list[float], patience: int | None) -> bool:
    """Whether the last ``patience`` rounds brought nothing better than before."""
    if not patience or not history:
        return False
    return len(history) - 1 - best_round(history) >= patience


def best_round(history: list[float]) -> int:
    """The first round with the highest value; an undefined value is never best."""
    known = [v if v == v else -math.inf for v in history]
    return max(range(len(known)), key=lambda i: (known[i], -i)) if known else 0


# ----------------------------------------------------------------------------- models

@dataclass
class Booster:
    """Trees of one model with what is needed to apply them, and its evaluations (by round or after the last one)."""
    layout: Layout
    trees: list[Tree] = field(default_factory=list)
    history: list[float] = field(default_factory=list)
    early: bool = False  # stopped early: the trees up to the best round score

    @property
    def best(self) -> int:
        """0-based round of the best evaluation."""
        return best_round(self.history)

    def used(self) -> list[Tree]:
        return self.trees[:self.best + 1] if self.early else self.trees

    def margins(self, codes: np.ndarray) -> np.ndarray:
        """Rows of equal codes are taken down the trees once."""
        first, at = alike(codes, self.layout)
        codes, n_num = codes[first], len(self.layout.num)
        flat, start = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
        out = np.zeros(len(codes))
        for t in self.used():
            out += t.value.take(t.ends(flat, start, n_num) if codes.shape[1] else np.ones(len(codes), np.int64))
        return out.take(at)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(codes)))

    def table(self) -> list[tuple]:
        """One row a node that rows can reach: tree, node, feature (null: leaf), cut (a numeric split's upper bound), slot (a
        categorical one's), missing_left, gain, cover, value (of a leaf)."""
        rows = []
        for i, t in enumerate(self.used()):
            todo = [1]
            while todo:
                n = todo.pop()
                f = int(t.feature[n])
                numeric = 0 <= f < len(self.layout.num)
                names = self.layout.num + self.layout.cat
                rows.append((i, n, names[f] if f >= 0 else None, float(self.layout.cuts[names[f]][t.code[n] - 1]) if numeric else None,
                             int(t.code[n]) if f >= 0 and not numeric else None, bool(t.missing_left[n]) if numeric else None,
                             float(t.gain[n]) if f >= 0 else None, float(t.cover[n]),
                             None if f >= 0 else float(t.value[n])))
                todo += [2 * n, 2 * n + 1] if f >= 0 else []
        return rows

    def packed(self) -> list[tuple[bytes, ...]]:
        return [tuple(getattr(t, name).tobytes() for name in TREE_FIELDS) for t in self.trees]


def scorer(models: dict[str, Booster]):
    """Probability of each row by the model named in its field ``model_segment``; features as ``Layout.codes`` reads them."""
    def run(rows: pd.DataFrame) -> pd.Series:
        out = np.zeros(len(rows))
        for name, at in rows.groupby("model_segment").indices.items():
            b = models[name]
            out[at] = b.probabilities(b.layout.codes(rows.iloc[at]))
        return pd.Series(out)
    return F.pandas_udf(run, "double")


NODES = ("tree int, node int, feature string, cut double, slot int, missing_left boolean, gain double, cover double, "
         "value double")
TREE_FIELDS = ("feature", "code", "missing_left", "gain", "cover", "value")
TREE_TYPES = dict(feature=np.int32, code=np.int32, missing_left=bool, gain=float, cover=float, value=float)
TREES = "model int, tree int, watched double, " + ", ".join(f"{n} binary" for n in TREE_FIELDS)


def tree_of(r) -> Tree:
    return Tree(*(np.frombuffer(getattr(r, n), TREE_TYPES[n]).copy() for n in TREE_FIELDS))


@dataclass
class Joint:
    """Features read as one, with a code for each combination of theirs: rows are added up once for all of them."""
    size: int
    codes: np.ndarray         # of each row
    cells: np.ndarray         # the features' cells in the layout
    share: np.ndarray | None  # combinations x cells: 1 where a combination has the cell's code (None: a single feature)


def joints(codes: np.ndarray, layout: Layout, most: int) -> list[Joint]:
    """All features, the widest first, joined as long as the combinations are at most ``most``."""
    width = np.diff(layout.offset)
    sets: list[list[int]] = []
    for f in np.argsort(-width, kind="stable").tolist():
        into = next((s for s in sets if math.prod(width[s].tolist()) * width[f] <= most), None)
        sets.append([f]) if into is None else into.append(f)
    out = []
    for s in sets:
        size = stride = math.prod(width[s].tolist())
        code, all_, place = np.zeros(len(codes), np.int32), np.arange(size), 0
        share = None if len(s) == 1 else np.zeros((size, int(width[s].sum())))
        for f in s:
            stride //= int(width[f])
            code += codes[:, f] * np.int32(stride)
            if share is not None:
                share[all_, place + all_ // stride % width[f]] = 1
            place += int(width[f])
        out.append(Joint(size, code.astype(np.min_scalar_type(size)), np.concatenate([np.arange(layout.offset[f], layout.offset[f + 1]) for f in s]), share))
    return out


@dataclass
class Histograms:
    """Histograms of rows that are all here. How far features are joined depends on the rows that a node has, so that the
    combinations are fewer than the rows. All sums are of integers, hence exact in doubles."""
    codes: np.ndarray
    layout: Layout
    held: dict[int, list[Joint]] = field(default_factory=dict)

    def joined(self, a_node: int) -> list[Joint]:
        bits = (min(int(a_node), MOST_JOINED).bit_length() - 1) // 3
        most = 8 ** bits if bits > 1 else 1
        if most not in self.held:
            self.held[most] = joints(self.codes, self.layout, most)
        return self.held[most]

    def sums(self, at: np.ndarray, slot: np.ndarray, n: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """(2, n, cells): gradients and hessians of the rows ``at`` by their slots of ``n``."""
        out = np.zeros((2, n, self.layout.width), np.int64)
        for j in self.joined(len(at) // (2 * n)):
            cell = slot * j.size + j.codes.take(at)
            x = np.concatenate([np.bincount(cell, weights=w, minlength=n * j.size) for w in (g, h)]).reshape(2 * n, j.size)
            out[:, :, j.cells] = (x if j.share is None else x @ j.share).reshape(2, n, -1)
        return out


@dataclass
class Own:
    """The rows of a model: those that it trains on, and all rows of equal codes as one."""
    codes: np.ndarray
    labels: np.ndarray
    train: np.ndarray     # places of rows in the block
    key: np.ndarray       # of each of these its place in ``codes`` and its label, as one number
    watched: np.ndarray   # evaluation rows: their places in ``codes``,
    pos: np.ndarray       # and how many there are of each label
    neg: np.ndarray
    hists: Histograms


class Shared:
    """What the models of a block have in common."""

    def __init__(self, rows: Rows, layout: Layout):
        self.rows, self.layout = rows, layout
        self.first, self.alike = alike(rows.codes, layout)
        self.labels = np.unique(rows.y)
        self.own: dict = {}
        self.hash: tuple = (None, None)

    def of(self, task: Task) -> Own:
        name = (task.fold, task.everything)
        if name not in self.own:
            train, watch = np.flatnonzero(self.rows.trains(task)), np.flatnonzero(self.rows.watched(task))
            used = np.zeros(len(self.first), bool)
            used[self.alike[train]] = used[self.alike[watch]] = True
            place = np.cumsum(used) - 1
            at, n = place[self.alike[watch]], int(used.sum())
            pos = np.bincount(at, weights=self.rows.y[watch] == 1, minlength=n).astype(np.int64)
            all_ = np.bincount(at, minlength=n)
            seen = np.flatnonzero(all_)
            codes = self.rows.codes[self.first[used]]
            key = place[self.alike[train]] * len(self.labels) + np.searchsorted(self.labels, self.rows.y[train])
            self.own[name] = Own(codes, self.labels, train, key, seen, pos[seen], (all_ - pos)[seen], Histograms(codes, self.layout))
        return self.own[name]

    def drawn(self, own: Own, task: Task, rnd: int) -> np.ndarray:
        """Keys of the rows sampled for a round."""
        share = task.param("subsample", 1)
        if share >= 1:
            return own.key
        if self.hash[0] != (task.seed, rnd):
            self.hash = ((task.seed, rnd), mixed(self.rows.uid, task.seed, rnd))
        return own.key[self.hash[1].take(own.train) < drawn_below(share)]


def alike(codes: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows of all the codes there are, and for each row the number of the one whose codes it has."""
    key, size = np.zeros(len(codes), np.int64), 1
    for f, w in enumerate(np.diff(layout.offset).tolist()):
        if size * w >= 1 << 62:
            values, key = np.unique(key, return_inverse=True)
            size = len(values)
        key, size = key * w + codes[:, f], size * w
    _, first, at = np.unique(key, return_index=True, return_inverse=True)
    return first, at


def grow_in_block(rows: Rows, layout: Layout, task: Task) -> Booster:
    """All rounds of one model whose rows are all here."""
    out = Booster(layout, early=task.patience is not None)
    for out in rounds_in_block(Shared(rows, layout), task):
        pass
    return out


def rounds_in_block(shared: Shared, task: Task) -> Iterator[Booster]:
    """The model after each round. Rows of equal codes keep their node from level to level; of two children only the lighter
    one is added up, the other one is what is left of their parent."""
    layout, own = shared.layout, shared.of(task)
    out = Booster(layout, early=task.patience is not None)
    n_num, widest = len(layout.num), int(np.diff(layout.offset).max(initial=1))
    codes, hists, labels = own.codes, own.hists, own.labels
    flat = codes.astype(np.min_scalar_type(widest)).ravel()
    first = np.arange(len(codes)) * layout.n_features
    any_code = np.arange(widest)
    margin = np.zeros(len(codes))
    for rnd in range(task.rounds):
        n = np.bincount(shared.drawn(own, task, rnd), minlength=len(codes) * len(labels)).reshape(len(codes), -1)
        at = np.flatnonzero(n.any(axis=1))
        n, p = n.take(at, axis=0), probability(margin.take(at))
        g, h = np.zeros(len(at)), np.zeros(len(at))
        for i, y in enumerate(labels):  # whole numbers, so sums by rows come to the same
            a, b = units_of(y, p, task)
            g += n[:, i] * a
            h += n[:, i] * b
        allowed = allowed_splits(layout, task, rnd)
        tree, open_ = Tree.empty(task.depth), np.array([1], dtype=np.int64)
        size = len(tree.feature)
        node, here = np.ones(len(codes), np.int64), np.ones(len(at), np.int64)
        for depth in range(task.depth):
            if not len(open_):
                break
            if depth == 0:
                hist = hists.sums(at, here - 1, 1, g, h)
            else:
                light = open_[0::2] + (tree.cover[open_[0::2]] > tree.cover[open_[1::2]])
                slot_of = np.full(size, -1, np.int64)
                slot_of[light] = np.arange(len(light))
                slot = slot_of.take(here)
                mine = np.flatnonzero(slot >= 0)
                some = hists.sums(at.take(mine), slot.take(mine), len(light), g.take(mine), h.take(mine))
                above = hist[:, np.searchsorted(nodes, light // 2)]
                hist = np.empty((2, len(open_), layout.width), np.int64)
                hist[:, np.searchsorted(open_, light)], hist[:, np.searchsorted(open_, light ^ 1)] = some, above - some
            nodes = open_
            open_ = place(tree, open_, best_splits(*hist, layout, task, allowed), task, depth + 1 == task.depth)
            if layout.n_features:
                # where each code of a node's feature leads; a leaf leads to itself
                upto = np.arange(2 << depth)
                f, cut = tree.feature[upto, None], tree.code[upto, None]
                left = np.where(f >= n_num, any_code == cut, np.where(any_code == 0, tree.missing_left[upto, None], any_code <= cut))
                after = np.where(f >= 0, 2 * upto[:, None] + 1 - left, upto[:, None]).ravel()
                code = flat.take(np.maximum(tree.feature[upto], 0).astype(np.int64).take(node) + first)
                node = after.take(node * widest + code)
                here = node.take(at)
        tree.pruned(task.param("gamma", 0))
        end = np.arange(size)
        for i in range(2, size):  # nodes below a leaf count as that leaf
            if tree.feature[i // 2] < 0 or end[i // 2] != i // 2:
                end[i] = end[i // 2]
        margin += tree.value[end].take(node)
        out.trees.append(tree)
        if not task.everything and (task.watch or rnd + 1 == task.rounds):
            out.history.append(average_precision(counted(margin.take(own.watched), own.pos, own.neg)))
        yield out
        if finished(out.history, task.patience):
            return


def block_grower(layouts: dict[int, Layout], tasks: list[Task]):
    """Models whose group is one block: each block comes once per share of tasks, named by its column ``share``."""
    by_model = {t.model: t for t in tasks}

    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for r in pdf.itertuples():
                shared = Shared(Rows.of(r), layouts[r.group])
                out = {m: Booster(shared.layout, early=by_model[m].patience is not None) for m in r.share}
                alive = {m: rounds_in_block(shared, by_model[m]) for m in r.share}
                while alive:  # round by round, so that the hash of a round is taken once
                    for m, more in list(alive.items()):
                        out[m] = next(more, None) or out[m]
                        if more.gi_frame is None:
                            del alive[m]
                for m, b in out.items():
                    watched = b.history if len(b.history) == len(b.trees) else [math.nan] * (len(b.trees) - 1) + (b.history or [math.nan])
                    all_ = [(m, i, w, *t) for i, (t, w) in enumerate(zip(b.packed(), watched))]
                    yield pd.DataFrame(all_ if by_model[m].keep else [(*all_[-1][:3], *[b""] * len(TREE_FIELDS))],
                                       columns=["model", "tree", "watched", *TREE_FIELDS])
    return run


# ----------------------------------------------------------------------------- growing by level

@dataclass
class Growing:
    """What a job needs of a model: its round, the trees that are not in the stored margins and the tree that grows."""
    task: Task
    layout: Layout
    rnd: int = 0
    recent: list[Tree] = field(default_factory=list)
    tree: Tree | None = None
    open_: np.ndarray = field(default_factory=lambda: np.array([1], dtype=np.int64))
    depth: int = 0
    over: bool = False


def margins_of(r, rows: Rows, models: list[Growing], place_of: dict[int, int]) -> dict[int, np.ndarray]:
    """Margins of this block's models: those stored and the newer trees."""
    held = np.frombuffer(r.margins).reshape(-1, r.n)
    out = {}
    for m in models:
        if m.task.group == r.group:
            x = held[place_of[m.task.model]].copy() if len(held) else np.zeros(r.n)
            for t in m.recent:
                x += t.value[t.leaves(rows.codes, len(m.layout.num))]
            out[m.task.model] = x
    return out


def level_filler(models: list[Growing], place_of: dict[int, int], watch: bool):
    """Sums of one task's blocks as rows (model, node, idx, g, h); node -1 holds the counts of evaluation rows."""
    def run(batches: Iterator[pd.DataFrame]):
        held: dict[tuple[int, int], list] = {}
        counts: dict[int, pd.DataFrame] = {}
        for pdf in batches:
            for r in pdf.itertuples():
                rows = Rows.of(r)
                margins = margins_of(r, rows, models, place_of)
                for m in models:
                    margin = margins.get(m.task.model)
                    if margin is None:
                        continue
                    if watch and m.rnd:
                        c = watched_counts(rows, margin, m.task)
                        old = counts.get(m.task.model)
                        counts[m.task.model] = c if old is None else pd.concat([old, c]).groupby("idx", as_index=False).sum()
                    if m.rnd == m.task.rounds or not len(m.open_):
                        continue
                    at, g, h = gradients(rows, margin, m.task, m.rnd)
                    codes = rows.codes[at]
                    node = m.tree.leaves(codes, len(m.layout.num))
                    for n, *x in zip(m.open_.tolist(), *histogram(codes, node, m.open_, g, h, m.layout)):
                        old = held.get((m.task.model, n))
                        held[m.task.model, n] = x if old is None else [a + b for a, b in zip(old, x)]
        for (model, n), (g, h) in held.items():
            at = np.flatnonzero((g != 0) | (h != 0))
            yield pd.DataFrame({"model": model, "node": n, "idx": at, "g": g[at], "h": h[at]})
        for model, c in counts.items():
            yield pd.DataFrame({"model": model, "node": -1, "idx": c["idx"], "g": c["g"], "h": c["h"]})
    return run


CHOSEN = ("model int, node long, g long, h long, feature int, code int, missing_left boolean, gain double, gl long, hl long, "
          "watched double")


def chooser(models: list[Growing]):
    by_model = {m.task.model: m for m in models}

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        m = by_model[int(key[0])]
        out = []
        curve, cells = pdf[pdf["node"] < 0], pdf[pdf["node"] >= 0]
        if len(curve):
            out.append(pd.DataFrame({"node": [-1], "watched": [average_precision(curve)]}))
        if len(cells):
            nodes = np.unique(cells["node"].to_numpy())
            g, h = (np.zeros((len(nodes), m.layout.width), np.int64) for _ in range(2))
            at = np.searchsorted(nodes, cells["node"]), cells["idx"].to_numpy()
            g[at], h[at] = cells["g"], cells["h"]
            found = best_splits(g, h, m.layout, m.task, allowed_splits(m.layout, m.task, m.rnd))
            out.append(pd.DataFrame({"node": nodes, **found}))
        names = [f.split()[0] for f in CHOSEN.split(", ")]
        df = pd.concat(out).assign(model=int(key[0])).reindex(columns=names)
        ints = ["node", "g", "h", "feature", "code", "gl", "hl"]
        df[ints] = df[ints].fillna(0).astype("int64")
        df["missing_left"] = df["missing_left"].fillna(False).astype(bool)
        return df
    return run


def refresher(models: list[Growing], place_of: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                fresh = margins_of(r, Rows.of(r), models, place_of)
                x = np.zeros((len(place_of), r.n))
                for model, margin in fresh.items():
                    x[place_of[model]] = margin
                out.append({**r._asdict(), "margins": x.tobytes()})
            yield pd.DataFrame(out)
    return run


def grow_by_level(blocks: DataFrame, layouts: dict[int, Layout], tasks: list[Task], refresh: int) -> dict[int, Booster]:
    """All rounds of all models, level by level over all blocks."""
    spark = blocks.sparkSession
    out = {t.model: Booster(layouts[t.group], early=t.patience is not None) for t in tasks}
    models = [Growing(t, layouts[t.group]) for t in tasks]
    place_of = {t.model: i for i, t in enumerate(tasks)}
    since = 0
    while True:
        alive = [m for m in models if not m.over]
        if not alive:
            return out
        for m in alive:
            m.tree, m.open_, m.depth = Tree.empty(m.task.depth), np.array([1], dtype=np.int64), 0
        level, ask = 0, alive
        while ask:
            # the counts of a round's evaluation rows come with the first level of the next one
            filled = blocks.mapInPandas(level_filler(ask, place_of, level == 0), "model int, node long, idx long, g long, h long")
            added = filled.repartition("model").groupBy("model", "node", "idx").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            rows = added.groupBy("model").applyInPandas(chooser(ask), CHOSEN).toPandas()  # a row an open node
            by_model = dict(iter(rows.groupby("model")))
            for m in ask:
                mine, done = by_model.get(m.task.model, rows[:0]), out[m.task.model]
                if level == 0 and m.rnd:
                    if not m.task.everything and (m.task.watch or m.rnd == m.task.rounds):
                        seen = mine.loc[mine["node"] < 0, "watched"]
                        done.history.append(float(seen.iloc[0]) if len(seen) else math.nan)
                    m.over = m.rnd == m.task.rounds or finished(done.history, m.task.patience)
                found = mine[mine["node"] >= 0].sort_values("node")
                if m.over or not len(found):
                    m.open_ = np.zeros(0, np.int64)
                    continue
                m.depth += 1
                picked = {c: found[c].to_numpy() for c in ("g", "h", "feature", "code", "missing_left", "gain", "gl", "hl")}
                m.open_ = place(m.tree, found["node"].to_numpy(), picked, m.task, m.depth == m.task.depth)
            level += 1
            ask = [m for m in ask if not m.over and len(m.open_)]
        for m in alive:
            if not m.over:
                m.recent.append(m.tree.pruned(m.task.param("gamma", 0)))
                m.rnd += 1
                if m.task.keep:
                    out[m.task.model].trees.append(m.tree)
        since += 1
        if since == refresh:
            path = scratch_path(spark, "margins")
            blocks.mapInPandas(refresher(models, place_of), BLOCK).write.parquet(path)
            blocks = spark.read.schema(BLOCK).parquet(path)
            for m in models:
                m.recent = []
            since = 0


# ----------------------------------------------------------------------------- data

def numeric_cuts(df: DataFrame, num: list[str], by: str, max_bins: int = MAX_BINS) -> dict[int, dict[str, np.ndarray]]:
    """Upper bounds of the bins of each numeric feature, per value of column ``by``: every distinct value where there are
    at most ``max_bins``, else the values at which the count of rows passes a multiple of a ``max_bins``-th."""
    if not num:
        return {}
    long = df.select(by, *num).unpivot([by], num, "feature", "value").filter(F.col("value").isNotNull())
    counts = durable(long.groupBy(by, "feature", "value").agg(F.count(F.lit(1)).alias("n")))
    all_ = counts.groupBy(by, "feature").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"))
    ranked = running_totals(counts, [F.col("value").asc()], [by, "feature"], ["n"]).frame
    j = ranked.join(F.broadcast(all_), [by, "feature"])  # one row a group and feature
    step = lambda c: F.floor(c * F.lit(max_bins) / F.col("rows"))
    cut = (F.col("values") <= max_bins) | (step(F.col("cum_n")) > step(F.col("cum_n") - F.col("n")))
    out: dict = {}
    for r in j.filter(cut).select(by, "feature", "value").collect():  # at most max_bins a group and feature
        out.setdefault(r[by], {}).setdefault(r["feature"], []).append(r["value"])
    return {g: {f: np.array(sorted(v)) for f, v in fs.items()} for g, fs in out.items()}


def packer(layouts: dict[int, Layout], block_rows: dict[int, int]):
    """Rows of one partition to blocks."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        layout, most = layouts[int(key[0])], block_rows[int(key[0])]
        out = []
        for a in range(0, len(pdf), most):
            p = pdf.iloc[a:a + most]
            small = lambda c, t: p[c].to_numpy().astype(t).tobytes()
            kind = np.min_scalar_type(int(np.diff(layout.offset).max(initial=1)))
            out.append({"group": int(key[0]), "n": len(p), "size": kind.itemsize, "codes": layout.codes(p).astype(kind).tobytes(), "y": small("y", np.int8),
                        "part": small("part", np.int8), "fold": small("fold", np.int16), "uid": small("uid", np.int64), "margins": b""})
        return pd.DataFrame(out)
    return run


@dataclass
class Matrix:
    """Blocks of one or more encoded data groups."""
    blocks: DataFrame
    layouts: dict[int, Layout]
    n_blocks: dict[int, int]


def rows_a_block(n: int, layout: Layout) -> int:
    """All ``n`` rows of a group in one block while these and their codes fit a task, else blocks for many tasks."""
    return n if n <= min(WHOLE_ROWS, WHOLE_CODES // max(layout.n_features, 1)) else BLOCK_ROWS


def pack(rows: DataFrame, layouts: dict[int, Layout], block_rows: int | None = None) -> Matrix:
    """``rows``: group, part, fold, y, uid, the numerics and ``<cat>__idx``; rows without a label go. A block holds at most
    ``block_rows`` rows of one group (default: ``rows_a_block``); which row goes where has no bearing on any result."""
    known = durable(rows.filter(F.col("y").isNotNull()))
    size = {r["group"]: r["n"] for r in known.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = {g: block_rows or rows_a_block(n, layouts[g]) for g, n in size.items()}
    n_blocks = {g: -(-n // most[g]) for g, n in size.items()}
    if not n_blocks:
        return Matrix(known.sparkSession.createDataFrame([], BLOCK), layouts, {})
    dealt = F.pmod(F.monotonically_increasing_id(), F.element_at(F.create_map(*[F.lit(x) for p in n_blocks.items() for x in p]), F.col("group")))
    packed = known.withColumn("_at", dealt).groupBy("group", "_at").applyInPandas(packer(layouts, most), BLOCK)
    path = scratch_path(known.sparkSession, "blocks")
    packed.write.parquet(path)
    blocks = known.sparkSession.read.schema(BLOCK).parquet(path)
    found = {r["group"]: r["n"] for r in blocks.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Matrix(blocks, layouts, found)


def fit(matrix: Matrix, tasks: list[Task], refresh: int = 25) -> dict[int, Booster]:
    """Grow all models. Those of one-block groups are dealt over tasks, the others grow level by level together."""
    spark: SparkSession = matrix.blocks.sparkSession
    whole = [t for t in tasks if matrix.n_blocks.get(t.group) == 1]
    spread = [t for t in tasks if matrix.n_blocks.get(t.group, 0) > 1]
    out = {t.model: Booster(matrix.layouts[t.group], early=t.patience is not None) for t in tasks}
    if whole:
        # long models first, dealt in turn, so that shares take about as long
        whole.sort(key=lambda t: (-t.rounds * t.depth, t.model))
        n = max(1, min(len(whole), 4 * spark.sparkContext.defaultParallelism))
        shares = [(s, g, [t.model for t in whole[s::n] if t.group == g]) for s in range(n) for g in {t.group for t in whole[s::n]}]
        asked = spark.createDataFrame(shares, "at int, group int, share array<int>")
        dealt = matrix.blocks.join(F.broadcast(asked), "group").repartitionByRange(len(shares), "at", "group")  # one row a share
        grown = dealt.mapInPandas(block_grower(matrix.layouts, whole), TREES)
        path = scratch_path(spark, "trees")
        grown.write.parquet(path)
        by_model = {t.model: t for t in whole}
        trees = spark.read.schema(TREES).parquet(path).toPandas().sort_values(["model", "tree"])  # trees, not rows
        for model, mine in trees.groupby("model"):
            b = out[model]
            task = by_model[model]
            seen = mine["watched"].tolist()
            b.trees = [tree_of(r) for r in mine.itertuples()] if task.keep else []
            b.history = [] if task.everything else seen if task.watch else seen[-1:]
    if spread:
        groups = sorted({t.group for t in spread})
        out.update(grow_by_level(matrix.blocks.filter(F.col("group").isin(groups)), matrix.layouts, spread, refresh))
    return out
