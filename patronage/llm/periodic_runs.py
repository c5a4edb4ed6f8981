"""Periodic runs of words, and texts with each run collapsed to one period.

A run is a stretch of consecutive words whose smallest period is q, at least
twice q long, which no neighbouring word extends. The finder builds the suffix
automaton of a word sequence and keeps, on its tree of suffix links, path
segments of states that were last seen at the same place: a link-cut tree whose
only operation is access. Appending word i accesses the state of the prefix that
ends there. Each segment on the way to the root holds the suffixes of i that last
ended at one place p; with d = i - p and n the longest of them, d <= n means a
square of period d that ends at i, and the stretch of period d reaches back to
i - n - d + 1. d is the smallest period there, since p is the last place. The
same stretch is met again at each of its further words, which extends it to a
run. Segments met are in the order of n log n in all.

The automaton is built only where runs can be: ``windows`` finds, from repeated
groups of words, stretches that hold every run with its neighbours, and leaves
out what cannot lie in one. Texts without such a stretch have no runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of

#: Words of the shortest run.
LEAST = 12
#: An odd multiplier for the hash of a word group.
MIX = np.uint64(0x9E3779B97F4A7C15)


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, longest lengths and the state of each prefix."""
    step: list[dict[int, int]] = [{}]
    link, size, ends, last = [-1], [0], [], 0
    for w in words:
        new, p = len(size), last
        size.append(size[last] + 1)
        step.append({})
        link.append(0)
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            if size[q] != size[p] + 1:
                twin = len(size)
                size.append(size[p] + 1)
                step.append(step[q].copy())
                link.append(link[q])
                while p >= 0 and step[p].get(w) == q:
                    step[p][w] = twin
                    p = link[p]
                link[q] = twin
                q = twin
            link[new] = q
        last = new
        ends.append(new)
    return link, size, ends


class Segments:
    """Paths of a rooted tree, each coloured by the last access that ran along
    it, as splay trees in the order of depth. The colour stands at a splay
    tree's root; ``up`` of that root is the tree node above the path."""

    def __init__(self, parents: list[int]):
        n = len(parents)
        self.up, self.left, self.right, self.colour = list(parents), [-1] * n, [-1] * n, [-1] * n

    def splay(self, x: int) -> None:
        """Bring x to the root of its splay tree; the colour follows."""
        up, left, right = self.up, self.left, self.right
        top = x
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                break
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            top = g if inner else p
            if inner:
                self._turn(p if (left[p] == x) == (left[g] == p) else x)
            self._turn(x)
        if top != x:
            self.colour[x] = self.colour[top]

    def _turn(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            c = left[p] = right[x]
            right[x] = p
        else:
            c = right[p] = left[x]
            left[x] = p
        if c >= 0:
            up[c] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Give the path from x to the root one colour; (deepest node, colour
        before) of each segment on it, from x upward."""
        met, below = [], -1
        while x >= 0:
            self.splay(x)
            was, r = self.colour[x], self.right[x]
            met.append((x, was))
            if r >= 0:
                self.colour[r] = was
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return met


def squares_to_runs(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence, by start and period."""
    link, size, ends = automaton(words)
    tree, reach = Segments(link), {}
    for i, state in enumerate(ends):
        for node, p in tree.access(state, i):
            d = i - p
            if p >= 0 and d <= size[node]:
                reach[i - size[node] - d + 1, d] = i
    return sorted((s, e - s + 1, d) for (s, d), e in reach.items() if e - s + 1 >= least)


def windows(hashes: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches [a, b) of words that hold every run of ``least`` words or more
    together with the word before and after it.

    In a run of period q all groups of k = least / 2 words from its word q on are
    equal to the group q words before. A stretch of m such repeated groups can so
    only serve periods up to m + k - 1, and at least one of them must have its
    equal that near. Equal hashes of different words only add windows.
    """
    k, n = (least + 1) // 2, len(hashes)
    if n <= k:
        return []
    group = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        group = group * MIX + hashes[j:n - k + 1 + j]
    ordered = np.sort(group)
    if not (ordered[1:] == ordered[:-1]).any():
        return []
    order = np.argsort(group, kind="stable")
    again = np.nonzero(group[order[1:]] == group[order[:-1]])[0]
    back = np.zeros(len(group), np.int64)
    back[order[again + 1]] = order[again + 1] - order[again]
    at = np.nonzero(back)[0]
    first = np.nonzero(np.diff(at, prepend=-2) > 1)[0]
    m = np.diff(first, append=len(at))
    fits = np.minimum.reduceat(back[at], first) <= m + k - 1
    out: list[tuple[int, int]] = []
    for x, c in zip(at[first[fits]].tolist(), m[fits].tolist(), strict=True):
        a, b = max(0, x - c - k), min(n, x + c + k)
        while out and a <= out[-1][1]:
            a = min(a, out.pop()[0])
        out.append((a, b))
    return out


def word_runs(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text's words, by start and period."""
    n, out = len(words), []
    if n < least:
        return out
    for a, b in windows(np.fromiter(map(hash, words), np.int64, n).view(np.uint64), least):
        number: dict[bytes, int] = {}
        part = [number.setdefault(w, len(number)) for w in words[a:b]]
        # What touches an inner border is a part of a run, or none: a run's own window has its neighbours too.
        out += [(a + s, c, q) for s, c, q in squares_to_runs(part, least)
                if (s > 0 or a == 0) and (a + s + c < b or b == n)]
    return sorted(out)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces; of each run its first period only."""
    if runs:
        keep = np.ones(len(words), bool)
        for s, c, q in runs:
            keep[s + q:s + c] = False
        words = [words[i] for i in np.nonzero(keep)[0].tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start and
    period), collapsed (the text with each run cut to its first period, words
    joined by one space) for each row.

    Null and empty texts have no words, no runs and an empty collapsed text; rows
    that repeat are repeated; a null doc_id stays null; an empty table gives no
    rows; other columns are not read. One text is one value, however long.
    """
    batches_of(docs.sparkSession)
    kind = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, found, rest = [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                runs = word_runs(words, least)
                count.append(len(words))
                found.append([{"start": s, "length": c, "period": q} for s, c, q in runs])
                rest.append(collapsed(words, runs))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(count, pa.int64()), pa.array(found, pa.list_(span)),
                 pa.array(rest, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(col).cast("string").alias("text")) \
        .mapInArrow(run, kind)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one text of ten, by the checksum of its id, the words
    from some place on repeat with some period; the others are as they are. A
    null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumns({"g": F.floor(h / 10), "words": F.when(h % 10 == 0, words)}) \
        .withColumn("n", F.size("words")) \
        .withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int"))) \
        .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    said = F.expr("array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), "
                  "cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')")
    return one.select("doc_id", F.when(F.col("a").isNotNull(), said).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_runs, start, length, period, exponent_milli of the
    longest run (ties: smallest start, then period; none: nulls), runs_sha256
    and collapsed_sha256."""
    found = periodic_runs(docs, least)
    # Sorted by (-length, start, period), the first is the longest.
    best = F.expr("array_min(transform(runs, r -> named_struct('less', -r.length, 'start', r.start, 'period', r.period)))")
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * -best.less div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
