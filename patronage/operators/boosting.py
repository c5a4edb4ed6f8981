"""Leaf-wise boosted trees on histograms (MOD7, MOD8, MOD9).

Features are binned once: at most ``BINS`` value bins from mergeable quantiles,
a bin for missing values; a category has a bin for each level and one for what is
missing or unknown. The binned rows are written in blocks and stay where they
are, in at most one partition for each core. A pass sums first and second
derivatives and counts for each (leaf, feature, bin) in every task. The sums are
dealt out by groups of features, added up and searched there; the driver gets only
each group's best split of a leaf and picks among them.

A tree grows best-first: the leaf with most gain is split next, up to ``leaves``
leaves. A pass brings the sums of the smaller child of every leaf that may still
be split (its sibling is the parent less it; the parent's sums stay with the group
until the tree is done), so a tree takes about as many passes as it is deep. Several models (Tweedie and squared loss) share every pass, and the
pass for the next root measures the validation rows.

Which rows a round uses follows from a hash of their key, which features from a
seeded draw: neither depends on how rows are spread. Scores are kept with the
blocks, which take in a round's trees in the pass for the next root, and are written
every ``KEEP`` rounds. Where one partition holds all training rows, scores newer than
the written ones are what a worker remembers, or works out again from the trees.
"""

from __future__ import annotations

import heapq
import math
import pickle
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.config import (EARLY_STOPPING, LEARNING_RATE, LEAF_L2, MAX_LEAVES, MAX_ROUNDS, MIN_LEAF, SAMPLED_SHARE,
                              TWEEDIE_POWER)
from patronage.session import checkpoint_dir, materialize, ship_package

#: Value bins of a number; levels of a category that have a bin of their own (the most frequent).
BINS, LEVELS = 254, 4096
#: Rows in a block, rounds between writes of the scores, blocks whose scores a worker remembers.
BLOCK, KEEP, REMEMBERED = 1 << 16, 32, 96
#: Groups of features, each searched by one task.
DIRECT = 8
#: Rows of a leaf in a block that are summed for all features in one step.
FEW = 4096


@dataclass(frozen=True)
class Settings:
    """``smooth`` and ``level_l2`` are added to the curvature where categories
    are ordered and where their splits are weighed."""
    loss: str = "tweedie"
    power: float = TWEEDIE_POWER
    rate: float = LEARNING_RATE
    max_rounds: int = MAX_ROUNDS
    patience: int = EARLY_STOPPING
    leaves: int = MAX_LEAVES
    min_leaf: int = MIN_LEAF
    min_curvature: float = 1e-3
    l2: float = LEAF_L2
    smooth: float = 10.0
    level_l2: float = 10.0
    row_share: float = SAMPLED_SHARE
    feature_share: float = SAMPLED_SHARE
    seed: int = 42

    def slopes(self, y: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second derivative of the loss by the score."""
        if self.loss != "tweedie":
            return f - y, np.ones_like(f)
        p = self.power
        a, b = np.exp((1 - p) * f), np.exp((2 - p) * f)
        return b - y * a, (2 - p) * b - (1 - p) * y * a

    def deviance(self, y: np.ndarray, f: np.ndarray) -> float:
        """The sum of the loss; for Tweedie its part that depends on the score."""
        if self.loss != "tweedie":
            return float(((y - f) ** 2).sum())
        p = self.power
        return float((2 * (np.exp((2 - p) * f) / (2 - p) - y * np.exp((1 - p) * f) / (1 - p))).sum())

    def start(self, mean: float) -> float:
        return math.log(max(mean, 1e-9)) if self.loss == "tweedie" else mean


# ---------------------------------------------------------------------------
# Bins
# ---------------------------------------------------------------------------


@dataclass
class Binning:
    """Bounds of each number's bins and the levels of each category. The last
    bin of a feature holds what is missing (for a category: or unknown)."""
    numbers: list[str]
    categories: list[str]
    bounds: list[np.ndarray]
    levels: list[list[str]]

    @staticmethod
    def fit(train: DataFrame, numbers: list[str], categories: list[str], bins: int = BINS) -> Binning:
        named = train.select(*[_number(c).alias(f"x{i}") for i, c in enumerate(numbers)])
        probs = ", ".join(f"{k / bins!r}D" for k in range(1, bins))
        row = named.agg(*[F.expr(f"percentile_approx(x{i}, array({probs}), 10000)").alias(f"q{i}") for i in range(len(numbers))],
                        *[F.max(f"x{i}").alias(f"m{i}") for i in range(len(numbers))]).first() if numbers else None
        bounds = []
        for i in range(len(numbers)):
            values = np.unique(np.array(row[f"q{i}"] or [], np.float64))
            bounds.append(values[values < row[f"m{i}"]] if len(values) else values)  # the largest value's bin has no bound
        levels = [[r[0] for r in train.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("level")).count()
                   .orderBy(F.desc("count"), "level").limit(LEVELS).collect()] for c in categories]  # bounded
        return Binning(list(numbers), list(categories), bounds, levels)

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *self.categories]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(b) + 2 for b in self.bounds] + [len(v) + 1 for v in self.levels], np.int64)

    def columns(self) -> list[Column]:
        return [*[_number(c).alias(f"x{i}") for i, c in enumerate(self.numbers)],
                *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(self.categories)]]

    def bin(self, cols: list) -> np.ndarray:
        """A row of bins for each row of the columns (pandas series in the order of ``names``)."""
        sizes = self.sizes
        out = np.empty((len(cols[0]) if cols else 0, len(cols)), np.uint8 if sizes.max() <= 256 else np.uint16)
        for i, b in enumerate(self.bounds):
            x = cols[i].to_numpy(np.float64, na_value=np.nan)
            out[:, i] = np.where(np.isnan(x), len(b) + 1, np.searchsorted(b, x, side="left"))
        for i, v in enumerate(self.levels, len(self.bounds)):
            codes = {level: k for k, level in enumerate(v)}
            out[:, i] = [codes.get(x, len(v)) for x in cols[i]]
        return out


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


# ---------------------------------------------------------------------------
# Trees
# ---------------------------------------------------------------------------


@dataclass
class Split:
    node: int
    feature: int
    gain: float
    left_bins: np.ndarray  # a truth value for each bin of the feature
    left: int
    right: int
    sums: np.ndarray  # (2, 3): slope, curvature and rows of the two children


@dataclass
class Tree:
    """Splits in the order they were made, and the value of each leaf."""
    splits: list[Split]
    values: dict[int, float]

    def score(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for node, rows in leaves_of(self.splits, bins, np.arange(len(bins))).items():
            out[rows] = self.values[node]
        return out


def leaves_of(splits: list[Split], bins: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """The rows of each leaf; ``splits`` has parents before children."""
    at = {0: rows}
    for s in splits:
        own = at.pop(s.node)
        left = s.left_bins[bins[own, s.feature]]
        at[s.left], at[s.right] = own[left], own[~left]
    return at


def rows_of(splits: list[Split], wanted: list[int], bins: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """The rows of each leaf wanted, without dealing out others; ``splits`` has parents before children."""
    above, needed = {c: s.node for s in splits for c in (s.left, s.right)}, set(wanted)
    for node in wanted:
        while node in above and above[node] not in needed:
            node = above[node]
            needed.add(node)
    at = {0: rows}
    for s in splits:
        ways = [c for c in (s.left, s.right) if c in needed]
        if ways:
            own = at[s.node] if s.node in wanted else at.pop(s.node)
            left = s.left_bins[bins[own, s.feature]]
            at.update((c, own[left if c == s.left else ~left]) for c in ways)
    return at


def best_splits(sums: np.ndarray, binning: Binning, s: Settings, allowed: np.ndarray,
                total: np.ndarray | None = None) -> list[tuple | None]:
    """(gain, feature, left bins, sums of the children) of the best split of each
    leaf, None if there is none. ``sums`` is (leaves, bins of all features, 3),
    ``total`` (leaves, 3) that of all rows, by default the sum of the first feature's bins.

    Numbers are cut between bins, with what is missing on either side;
    categories are ordered by slope over curvature and cut like numbers. A bin
    without rows in the leaf goes to the larger side. Ties go to the first
    feature and bin.
    """
    sizes, numbers = binning.sizes, len(binning.numbers)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    of = np.repeat(np.arange(len(sizes)), sizes)
    total = sums[:, :ends[0]].sum(axis=1) if total is None else total
    put, orders = sums, {}
    for f in range(numbers, len(sizes)):
        own = sums[:, starts[f]:ends[f]]
        ratio = np.where(own[..., 2] > 0, own[..., 0] / (own[..., 1] + s.smooth), np.inf)
        orders[f] = order = np.argsort(ratio, axis=1, kind="stable")
        put = put.copy() if put is sums else put
        put[:, starts[f]:ends[f]] = np.take_along_axis(own, order[..., None], axis=1)
    put = np.ascontiguousarray(np.moveaxis(put, 2, 0))  # slopes, curvatures, rows: (leaves, bins) each
    run = np.zeros((3, len(sums), len(of) + 1))
    np.cumsum(put, axis=2, out=run[:, :, 1:])
    below = run[:, :, 1:] - run[:, :, starts][:, :, of]
    number = of < numbers
    inner = np.ones(len(of), bool)
    inner[ends - 1] = False  # what is missing, or all levels
    l2 = np.where(number, s.l2, s.l2 + s.level_l2)
    tg, th, tn = (total[:, j:j + 1] for j in range(3))

    def weigh(left: np.ndarray, can: np.ndarray) -> np.ndarray:
        g, h, n = left
        fine = can & (n >= max(1, s.min_leaf)) & (tn - n >= max(1, s.min_leaf)) & (h >= s.min_curvature) & (th - h >= s.min_curvature)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = g * g / (h + l2) + (tg - g) ** 2 / (th - h + l2) - tg * tg / (th + l2)
        return np.where(fine & (gain > 0), gain, -np.inf)
    can = inner & allowed[of]
    gains = [weigh(below, can)]
    missing = put[:, :, ends - 1]
    if missing[2, :, :numbers].any():
        gains.append(weigh(below + missing[:, :, of], can & number & (missing[2] > 0)[:, of]))
    gains = np.concatenate(gains, axis=1)
    at, out = gains.argmax(axis=1), []
    for k, a in enumerate(at.tolist()):
        if not np.isfinite(gains[k, a]):
            out.append(None)
            continue
        side, a = divmod(a, len(of))
        f = int(of[a])
        own, left = sums[k, starts[f]:ends[f]], np.zeros(sizes[f], bool)
        if f < numbers:
            left[:a - starts[f] + 1] = True
            left[-1] = bool(side)
        else:
            left[orders[f][k, :a - starts[f] + 1]] = True
        children = np.array([own[left].sum(axis=0), own[~left].sum(axis=0)])
        none = own[:, 2] == 0
        none[:-1] &= f >= numbers
        left[none] = children[0, 2] >= children[1, 2]
        out.append((float(gains[k, side * len(of) + a]), f, left, children))
    return out


@dataclass
class Growing:
    """A tree while it grows. ``splits`` runs ahead of what is chosen: the sums
    of their children are known, or wanted from the next pass."""
    settings: Settings
    binning: Binning
    allowed: np.ndarray
    splits: list[Split] = field(default_factory=list)
    sums: dict[int, np.ndarray] = field(default_factory=dict)
    found: dict[int, tuple | None] = field(default_factory=dict)
    wanted: list[int] = field(default_factory=lambda: [0])
    size: int = 1

    def lean(self) -> Growing:
        """What tasks need of it: no sums."""
        return replace(self, sums={}, found={})

    def take(self, got: np.ndarray) -> None:
        """The sums of the wanted leaves; a sibling is its parent less the other."""
        new = dict(zip(self.wanted, got, strict=True))
        for s in self.splits:
            if s.left in new or s.right in new:
                small, large = (s.left, s.right) if s.left in new else (s.right, s.left)
                new[large] = self.sums.pop(s.node) - new[small]
        new = {n: x for n, x in new.items() if n not in self.found}
        self.sums.update(new)
        self.found.update(zip(new, best_splits(np.array(list(new.values())), self.binning, self.settings, self.allowed),
                              strict=True))
        self.wanted = []

    def families(self) -> list[tuple[int, int | None, int | None]]:
        """(leaf, sibling, parent) of each leaf wanted; the root has neither."""
        of = {c: (s.right if c == s.left else s.left, s.node) for s in self.splits for c in (s.left, s.right)}
        return [(n, *of.get(n, (None, None))) for n in self.wanted]

    def learn(self, best: dict[int, tuple | None]) -> None:
        """The best splits of the leaves wanted and of their siblings."""
        self.found.update((n, x) for n, x in best.items() if n not in self.found)
        self.wanted = []

    def choose(self) -> Tree | None:
        """The tree, if what is known tells it; otherwise the leaves that it may
        still split become splits whose smaller child is wanted."""
        known, s = {x.node: x for x in self.splits}, self.settings
        while True:
            heap = [(-self.found[0][0], 0)] if self.found[0] else []
            taken: list[int] = []
            while heap and len(taken) < s.leaves - 1:
                node = heapq.heappop(heap)[1]
                taken.append(node)
                if node in known:
                    for child in (known[node].left, known[node].right):
                        if self.found[child]:
                            heapq.heappush(heap, (-self.found[child][0], child))
            asked = [n for n in taken if n not in known]
            if not asked:
                break
            # Nothing comes after the last split, so its children need no sums.
            last = asked == taken[-1:] and len(taken) == s.leaves - 1
            for node in asked:
                gain, f, left, children = self.found[node]
                known[node] = x = Split(node, f, gain, left, self.size, self.size + 1, children)
                self.splits.append(x)
                self.size += 2
                # A leaf of fewer rows than two children need is not split.
                self.found.update((c, None) for c, n in zip((x.left, x.right), children[:, 2], strict=True)
                                  if last or n < 2 * max(1, s.min_leaf))
                if not (x.left in self.found and x.right in self.found):
                    self.wanted.append(x.left if children[0, 2] <= children[1, 2] else x.right)
            if self.wanted:
                return None
        values = {0: 0.0}
        for node in taken:
            values.pop(node)
            for child, (g, h, _) in zip((known[node].left, known[node].right), known[node].sums, strict=True):
                values[child] = float(-s.rate * g / (h + s.l2))
        return Tree([known[n] for n in taken], values)


# ---------------------------------------------------------------------------
# Passes over the blocks
# ---------------------------------------------------------------------------


@dataclass
class Block:
    number: int
    valid: bool
    bins: np.ndarray
    y: np.ndarray
    mark: np.ndarray  # a hash of each row's key
    scores: list[np.ndarray]  # one for each model


#: In a Python worker: scores beyond what a block has, by (fit, block, model).
_REMEMBERED: OrderedDict = OrderedDict()


def score_of(fit: str, block: Block, model: int, trees: list[bytes]) -> np.ndarray:
    """The block's score under a model after the trees (pickled) made since it was written."""
    if not trees:
        return block.scores[model]
    key = (fit, block.number, model)
    done, score = _REMEMBERED.pop(key, (0, block.scores[model]))
    if done > len(trees):
        done, score = 0, block.scores[model]
    for t in trees[done:]:
        score = score + pickle.loads(t).score(block.bins)
    _REMEMBERED[key] = (len(trees), score)
    while len(_REMEMBERED) > REMEMBERED:
        _REMEMBERED.popitem(last=False)
    return score


def sampled(mark: np.ndarray, turn: int, s: Settings) -> np.ndarray:
    """Rows that a round uses, by a hash of key, round and seed."""
    if s.row_share >= 1:
        return np.arange(len(mark))
    with np.errstate(over="ignore"):
        x = mark ^ (np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s.seed))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return np.nonzero(x < np.uint64(int(s.row_share * 2.0 ** 64)))[0]


@dataclass
class Ask:
    """What a pass is to do for one model: sums for the tree that grows, or (``whole``)
    the tree itself, where one partition has all training rows."""
    model: int
    turn: int
    trees: list[bytes]
    growing: Growing
    measure: bool
    whole: bool


def sums_of(block: Block, ask: Ask, score: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """(leaves wanted, bins, 3) of one block, for the features that the tree may use and the first, which gives totals."""
    settings, wanted = ask.growing.settings, ask.growing.wanted
    rows = sampled(block.mark, ask.turn, settings)
    at = rows_of(ask.growing.splits, wanted, block.bins, rows)
    out = np.zeros((len(wanted), width, 3))
    used = np.flatnonzero(ask.growing.allowed | (np.arange(len(offsets)) == 0))
    ends = [*offsets[1:], width]
    for k, node in enumerate(wanted):
        own = at[node]
        g, h = settings.slopes(block.y[own], score[own])
        if len(own) > FEW:  # a feature at a time: the same sums without a copy of each weight for every feature
            bins = np.ascontiguousarray(block.bins[own].T)
            for f in used:
                of, a, b = bins[f].astype(np.intp), offsets[f], ends[f]
                for j, weight in enumerate((g, h)):
                    out[k, a:b, j] = np.bincount(of, weight, b - a)
                out[k, a:b, 2] = np.bincount(of, minlength=b - a)
        elif len(own):
            flat = (block.bins[own][:, used] + offsets[used]).ravel()
            for j, weight in enumerate((g, h)):
                out[k, :, j] = np.bincount(flat, np.repeat(weight, len(used)), width)
            out[k, :, 2] = np.bincount(flat, minlength=width)
    return out


def grown(blocks, fit: str, asks: list[Ask], sizes: np.ndarray) -> list[tuple]:
    """One job where one partition has all training rows: for each ask deviance and
    number of the validation rows, and the whole tree."""
    offsets, width = np.cumsum(sizes) - sizes, int(sizes.sum())
    lean = [replace(a, growing=a.growing.lean()) for a in asks]

    def run(part: Iterator[Block]) -> Iterator[list]:
        out = [[0.0, 0, None] for _ in lean]
        kept = []
        for b in part:
            if not b.valid:
                kept.append(b)
                continue
            for k, a in enumerate(lean):
                if a.measure:
                    score = score_of(fit, b, a.model, a.trees)
                    out[k][0] += a.growing.settings.deviance(b.y, score)
                    out[k][1] += len(b.y)
        for k, a in enumerate(lean if kept else []):
            scores, tree = [score_of(fit, b, a.model, a.trees) for b in kept], None
            while tree is None:
                a.growing.take(sum(sums_of(b, a, f, offsets, width) for b, f in zip(kept, scores, strict=True)))
                tree = a.growing.choose()
            out[k][2] = tree
        yield out
    parts = blocks.mapPartitions(run).collect()
    return [(sum(p[k][0] for p in parts), sum(p[k][1] for p in parts), next((p[k][2] for p in parts if p[k][2]), None))
            for k in range(len(asks))]


def group_of(key: tuple[int, int]) -> int:
    """Partition of a (model, group of features)."""
    return key[1]


@dataclass
class Dealt:
    """The sums of the leaves that the trees of a round may still split, where their
    groups of features are searched: an RDD of ((model, group), ({leaf: (sums, total)},
    answers)). It lasts until the next pass, and its lineage no longer than the round."""
    groups: dict[int, list[np.ndarray]]
    held: object = None

    @staticmethod
    def of(growing: dict[int, Growing]) -> Dealt:
        """Features that a tree may use, in groups of about equally many bins."""
        def dealt(g: Growing) -> list[np.ndarray]:
            mine = np.flatnonzero(g.allowed)
            ends = np.cumsum(g.binning.sizes[mine])
            return [mine[(ends - 1) * DIRECT // ends[-1] == i] for i in range(DIRECT)]
        return Dealt({k: dealt(g) for k, g in growing.items()})

    def hold(self, new=None) -> None:
        if self.held is not None:
            self.held.unpersist()
        self.held = new


def part_of(binning: Binning, features: np.ndarray) -> Binning:
    n = len(binning.numbers)
    return Binning([binning.numbers[f] for f in features if f < n], [binning.categories[f - n] for f in features if f >= n],
                   [binning.bounds[f] for f in features if f < n], [binning.levels[f - n] for f in features if f >= n])


def passed(blocks, fit: str, asks: list[Ask], binning: Binning, dealt: Dealt) -> list[tuple]:
    """One job: for each ask deviance and number of the validation rows, and the best
    splits of the leaves that its tree wants and of their siblings. What comes to the
    driver is a split for each leaf and group of features."""
    sizes = binning.sizes
    offsets, width = np.cumsum(sizes) - sizes, int(sizes.sum())
    places = np.split(np.arange(width), offsets[1:])
    lean = [replace(a, growing=replace(a.growing.lean(), found={})) for a in asks]
    groups = [dealt.groups[a.model] for a in asks]

    def run(index: int, part: Iterator[Block]) -> Iterator[tuple]:
        sums = [np.zeros((len(a.growing.wanted), width, 3)) for a in lean]
        loss, seen = [0.0] * len(lean), [0] * len(lean)
        for b in part:
            for k, a in enumerate(lean):
                if b.valid and not a.measure:
                    continue
                score = score_of(fit, b, a.model, a.trees)
                if b.valid:
                    loss[k] += a.growing.settings.deviance(b.y, score)
                    seen[k] += len(b.y)
                else:
                    sums[k] += sums_of(b, a, score, offsets, width)
        for k, a in enumerate(lean):
            total = sums[k][:, places[0]].sum(axis=1)
            for g, features in enumerate(groups[k]):
                own = sums[k][:, np.concatenate([places[f] for f in features])] if len(features) else None
                yield (a.model, g), (index, own, total, loss[k], seen[k])
    new = blocks.mapPartitionsWithIndex(run).partitionBy(DIRECT, group_of)
    merge = _merged({a.model: (a, a.growing.families(), set(b.growing.found), gs, [part_of(binning, f) for f in gs])
                     for a, b, gs in zip(lean, asks, groups, strict=True)})
    made = (new if dealt.held is None else dealt.held.union(new)).mapPartitions(merge, True).persist(StorageLevel.MEMORY_AND_DISK)
    got = made.map(lambda r: (r[0], r[1][1])).collect()
    dealt.hold(made)
    out = []
    for a in asks:
        mine = sorted((key[1], x) for key, x in got if key[0] == a.model)
        best: dict[int, tuple | None] = {}
        for _, (_, _, found) in mine:  # by rising feature: ties go to the first
            for node, x in found:
                if best.get(node) is None or x is not None and x[0] > best[node][0]:
                    best[node] = x
        for node, x in best.items():
            if x is not None:
                gain, f, left, children = x
                left = np.unpackbits(np.frombuffer(left, np.uint8), count=int(sizes[f])).astype(bool)
                best[node] = (gain, f, left, np.frombuffer(children).reshape(2, 3))
        out.append((mine[0][1][0], mine[0][1][1], best))
    return out


def _merged(asked: dict[int, tuple]):
    """What adds the tasks' sums of a group to those held, always in the tasks' order,
    and searches the new leaves."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        new, held = {}, {}
        for key, value in rows:
            if key[0] not in asked:
                continue  # its tree is done
            if len(value) == 2:
                held[key] = value[0]
            else:
                new.setdefault(key, []).append(value)
        for (model, g), got in new.items():
            ask, families, known, groups, parts = asked[model]
            got.sort(key=lambda x: x[0])
            loss, seen, now, found = sum(x[3] for x in got), sum(x[4] for x in got), dict(held.get((model, g), {})), []
            fresh = {}
            if len(groups[g]):
                sums, total = sum(x[1] for x in got), sum(x[2] for x in got)
                for k, (node, sibling, parent) in enumerate(families):
                    fresh[node] = (sums[k], total[k])
                    if parent is not None:
                        whole = now.pop(parent)
                        fresh[sibling] = (whole[0] - sums[k], whole[1] - total[k])
                fresh = {n: x for n, x in fresh.items() if n not in known}
                now.update(fresh)
            best = best_splits(np.array([x[0] for x in fresh.values()]), parts[g], ask.growing.settings,
                               ask.growing.allowed[groups[g]], np.array([x[1] for x in fresh.values()])) if fresh else []
            for node, x in zip(fresh, best, strict=True):
                found.append((node, x and (x[0], int(groups[g][x[1]]), np.packbits(x[2]).tobytes(), x[3].tobytes())))
            yield (model, g), (now, (loss, seen, found))
    return run


# ---------------------------------------------------------------------------
# Models
# ---------------------------------------------------------------------------


@dataclass
class BoostedModel:
    """The binning, and the trees up to the best round."""
    settings: Settings
    binning: Binning
    start: float
    trees: list[Tree]

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """The rows with their prediction."""
        ship_package(df.sparkSession)
        held = df.sparkSession.sparkContext.broadcast(self)  # at most max_rounds trees of ``leaves`` leaves

        @F.pandas_udf("double")
        def predict(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            m = held.value
            for cols in parts:
                bins = m.binning.bin(list(cols))
                score = np.full(len(bins), m.start)
                for t in m.trees:
                    score += t.score(bins)
                yield pd.Series(np.exp(score) if m.settings.loss == "tweedie" else score)
        return df.withColumn(out, predict(*self.binning.columns()))

    def importances(self) -> list[tuple[str, float, int]]:
        """(feature, gain, splits) of every feature, from the trees' own nodes."""
        gain, splits = np.zeros(len(self.binning.names)), np.zeros(len(self.binning.names), np.int64)
        for t in self.trees:
            for s in t.splits:
                gain[s.feature] += s.gain
                splits[s.feature] += 1
        return [(n, float(gain[i]), int(splits[i])) for i, n in enumerate(self.binning.names)]

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The model as tables: settings, features (bounds or levels) and nodes."""
        b = self.binning
        features = [(i, c, v.tolist(), None) for i, (c, v) in enumerate(zip(b.numbers, b.bounds, strict=True))]
        features += [(i, c, None, v) for i, (c, v) in enumerate(zip(b.categories, b.levels, strict=True), len(b.numbers))]
        nodes = [(i, k, s.node, s.feature, s.gain, np.nonzero(s.left_bins)[0].tolist(), s.left, s.right,
                  t.values.get(s.left), t.values.get(s.right), s.sums.ravel().tolist())
                 for i, t in enumerate(self.trees) for k, s in enumerate(t.splits)]
        known = self.settings
        return {
            "model": spark.createDataFrame([(known.loss, known.power, known.rate, known.l2, self.start, self.rounds)],
                                           "loss string, power double, rate double, l2 double, start double, rounds int"),
            "features": spark.createDataFrame(features, "place int, feature string, bounds array<double>, levels array<string>"),
            "nodes": spark.createDataFrame(
                nodes, "tree int, step int, node int, feature int, gain double, left_bins array<int>, left int, right int, "
                       "left_value double, right_value double, sums array<double>")}

    @staticmethod
    def read(tables: dict[str, DataFrame]) -> BoostedModel:
        """The model back from its tables (bounded by rounds and leaves)."""
        head = tables["model"].first()
        rows = sorted(tables["features"].collect(), key=lambda r: r["place"])
        numbers, cats = [r for r in rows if r["levels"] is None], [r for r in rows if r["levels"] is not None]
        binning = Binning([r["feature"] for r in numbers], [r["feature"] for r in cats],
                          [np.array(r["bounds"], np.float64) for r in numbers], [list(r["levels"]) for r in cats])
        trees = [Tree([], {0: 0.0}) for _ in range(head["rounds"])]
        for r in sorted(tables["nodes"].collect(), key=lambda r: (r["tree"], r["step"])):
            t, left = trees[r["tree"]], np.zeros(binning.sizes[r["feature"]], bool)
            left[r["left_bins"]] = True
            t.splits.append(Split(r["node"], r["feature"], r["gain"], left, r["left"], r["right"], np.array(r["sums"]).reshape(2, 3)))
            t.values.pop(0, None)
            t.values |= {n: v for n, v in ((r["left"], r["left_value"]), (r["right"], r["right_value"])) if v is not None}
        s = Settings(loss=head["loss"], power=head["power"], rate=head["rate"], l2=head["l2"])
        return BoostedModel(s, binning, head["start"], trees)


def blocks_of(df: DataFrame, valid: bool, binning: Binning, key: list[str], target: str, starts: list[float]):
    """The binned rows, written in blocks, as an RDD of Block; at least BLOCK rows a
    partition, and no more partitions than cores: what a pass moves grows with them."""
    spark, first = df.sparkSession, (1 << 40 if valid else 0)
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            bins, y, mark = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (bins.tobytes(), y.tobytes(), mark.tobytes())],
                                              names=["bins", "y", "mark"])
        for b in batches:
            t = b.to_pandas()
            if len(t):
                held.append((binning.bin([t[c] for c in t.columns[2:]]), t["y"].to_numpy(np.float64),
                             t["mark"].to_numpy(np.int64).view(np.uint64)))
            if sum(len(h[1]) for h in held) >= BLOCK:
                yield block()
        if held:
            yield block()
    rows = df.select(F.col(target).cast("double").alias("y"), F.xxhash64(*key).alias("mark"), *binning.columns())
    rows = rows.where("y is not null")
    parts = max(1, rows.count() // BLOCK)
    made = materialize(rows.coalesce(parts).mapInArrow(run, "bins binary, y binary, mark binary")
                       .withColumn("number", F.monotonically_increasing_id() + first))
    wide = len(binning.names)
    kind = np.uint8 if binning.sizes.max() <= 256 else np.uint16

    def block_of(r) -> Block:
        y = np.frombuffer(r["y"], np.float64)
        return Block(r["number"], valid, np.frombuffer(r["bins"], kind).reshape(-1, wide), y,
                     np.frombuffer(r["mark"], np.uint64), [np.full(len(y), s) for s in starts])
    return made.coalesce(min(parts, max(2, spark.sparkContext.defaultParallelism))).rdd.map(block_of)


def boost(train: DataFrame, valid: DataFrame | None, settings: list[Settings], numbers: list[str], categories: list[str],
          key: list[str], target: str = "target") -> list[BoostedModel]:
    """One boosted model for each of the settings, grown side by side.

    With f the score so far (its exponential predicts under the Tweedie loss), a
    round adds one tree to f whose leaves are -rate * G / (H + l2), G and H being
    the sums of first and second derivatives. The loss of the validation rows
    picks the rounds; after ``patience`` rounds without a better one a model
    ends. ``key`` names rows: it decides which of them a round uses. Rows without
    target take no part; no rows give a model without trees.
    """
    spark = train.sparkSession
    checkpoint_dir(spark)
    binning = Binning.fit(train, numbers, categories)
    mean = train.agg(F.avg(F.col(target).cast("double"))).first()[0]
    starts = [s.start(mean or 0.0) for s in settings]
    if mean is None:
        return [BoostedModel(s, binning, f, []) for s, f in zip(settings, starts, strict=True)]
    blocks = blocks_of(train, False, binning, key, target, starts)
    whole = blocks.getNumPartitions() == 1
    if valid is not None:
        blocks = blocks.union(blocks_of(valid, True, binning, key, target, starts))
    if not whole:
        blocks = blocks.coalesce(max(2, spark.sparkContext.defaultParallelism))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    n = len(settings)
    fit, written = uuid.uuid4().hex, 0
    trees: list[list[Tree]] = [[] for _ in settings]
    sent: list[list[bytes]] = [[] for _ in settings]
    best, least = [0] * n, [math.inf] * n
    active, growing = set(range(n)), {}

    def features(k: int, turn: int) -> np.ndarray:
        s, wide = settings[k], len(binning.names)
        some = np.random.default_rng((s.seed, turn)).permutation(wide)[:max(1, round(s.feature_share * wide))]
        return np.isin(np.arange(wide), some)
    for k in active:
        growing[k] = Growing(settings[k], binning, features(k, 0))
    dealt, waiting = Dealt.of(growing), set()  # models whose tree of the round is done
    old = None  # blocks that are needed until the next pass has made the newer ones
    while active:
        asks = [Ask(k, len(trees[k]), sent[k][written:], growing[k], valid is not None and growing[k].wanted == [0], whole)
                for k in sorted(active - waiting)]
        got = grown(blocks, fit, asks, binning.sizes) if whole else passed(blocks, fit, asks, binning, dealt)
        if old is not None:
            old.unpersist()
            old = None
        for a, (loss, seen, found) in zip(asks, got, strict=True):
            k, g = a.model, growing[a.model]
            if a.measure and seen:  # of the rounds so far
                if loss / seen < least[k] - 1e-12 * abs(least[k] if math.isfinite(least[k]) else 0.0):
                    best[k], least[k] = len(trees[k]), loss / seen
                elif len(trees[k]) - best[k] >= settings[k].patience:
                    active.discard(k)
                    continue
            if whole:
                tree = found
            else:
                g.learn(found)
                tree = g.choose()
            if tree is None:
                continue
            if not tree.splits or len(trees[k]) == settings[k].max_rounds:
                active.discard(k)
                continue
            trees[k].append(tree)
            sent[k].append(pickle.dumps(tree))
            if len(trees[k]) == settings[k].max_rounds and valid is None:
                active.discard(k)
            growing[k] = Growing(settings[k], binning, features(k, len(trees[k])))
            waiting.add(k)
        if active <= waiting:
            dealt.hold()
            dealt, waiting = Dealt.of(growing), set()
        low = min((len(trees[k]) for k in active), default=0)
        new = [t[written:low] for t in trees]
        if low // KEEP > written // KEEP:
            blocks, fit, written = _written(blocks, new), uuid.uuid4().hex, low
        elif low > written and not whole:
            old, blocks, written = blocks, _advanced(blocks, new), low
    blocks.unpersist()
    if old is not None:
        old.unpersist()
    dealt.hold()
    return [BoostedModel(s, binning, starts[k], trees[k][:best[k]] if valid is not None else trees[k])
            for k, s in enumerate(settings)]


def _advanced(blocks, new: list[list[Tree]]):
    """The blocks with newer scores, made in the next job."""
    def advance(b: Block) -> Block:
        return replace(b, scores=[s + sum(t.score(b.bins) for t in ts) for s, ts in zip(b.scores, new, strict=True)])
    return blocks.map(advance).persist(StorageLevel.MEMORY_AND_DISK)


def _written(blocks, new: list[list[Tree]]):
    """The blocks with newer scores, written to the shared folder."""
    made = _advanced(blocks, new)
    made.checkpoint()
    made.count()
    blocks.unpersist()
    return made
