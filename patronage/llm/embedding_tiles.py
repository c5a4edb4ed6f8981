"""Near-duplicate vectors by tiles in the order of principal axes.

Unit vectors are turned onto the eigenvectors of their second moments (summed
over all rows, axes of most weight first), so that the leading dimensions carry
as much of every product as can be. Two tiles of vectors are compared with
numpy: products are accumulated over the leading dimensions first; what the rest
can still add is at most the product of the two suffix norms. Rows and columns
of which no pair can reach the threshold go, and the comparison stops when none
is left. Pairs that get to the last dimension have their cosine.

A tile holds vectors of one label whose leading coordinates lie in one cell of a
grid. A cosine of t or more means a distance of sqrt(2 - 2t) at most, which is
the grid's width: only neighbouring cells can hold links, and no other tiles
meet. More axes make the grid as the corpus grows; a larger cell is dealt over
several tiles. Equal vectors are one before anything is compared, and a pair of
tiles gives counts and a forest of links, never its pairs.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of, rows_at_once
from patronage.llm.components import components
from patronage.session import materialize

#: Vectors in a tile, about; dimensions before the first look at the bound (then twice as many each time).
TILE, LEAD = 4096, 8
#: Rows of a tile compared at once; most axes of the grid.
STRIP, AXES = 512, 4
#: Cosines this near to the threshold are taken again from the vectors as given.
NEAR = 1e-9


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _usable(col: pa.Array) -> Iterator[np.ndarray | None]:
    """Each list as doubles, or None if it is null, zero or holds what is null or not finite."""
    flat = col.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # null: not a number
    offsets, valid = col.offsets.to_numpy(), col.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(col)):
        x = flat[offsets[k]:offsets[k + 1]]
        yield x + 0.0 if valid[k] and np.isfinite(x).all() and x.any() else None


def axes(vectors: DataFrame, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, axes as columns), most weight first: the eigenvectors of the
    mean outer product of all usable vectors (vec) of length d. Tasks send d rows
    of d sums, which are added up in two steps; d * d numbers come to the driver."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d, d)), 0
        for b in batches:
            x = [v for v in _usable(b.column(0)) if v is not None and len(v) == d]
            if x:
                u = units(np.array(x))
                total += u.T @ u
                seen += len(x)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "sums": [np.sum(np.stack(part["sums"].to_list()), axis=0)]})
    kind = "i int, sums array<double>"
    parts = vectors.select("vec").mapInArrow(sums, kind).withColumn("part", F.spark_partition_id() % 64)
    rows = parts.groupBy("i", "part").applyInPandas(add, kind).groupBy("i").applyInPandas(add, kind).collect()
    if not rows:
        return np.ones(d), np.eye(d)
    m = np.array([r["sums"] for r in sorted(rows, key=lambda r: r["i"])])
    weight, turn = np.linalg.eigh(m / np.trace(m))
    return weight[::-1].clip(0), np.ascontiguousarray(turn[:, ::-1])


def axes_for(n: int, weights: np.ndarray, width: float, tile: int) -> int:
    """Leading axes whose grid brings n vectors to about one tile a cell."""
    cells, k = 1.0, 0
    while k < min(AXES, len(weights)) and (k == 0 or n / cells > tile):
        cells *= max(1.0, math.sqrt(12 * weights[k]) / width)
        k += 1
    return k


class Tile:
    """Vectors as given, as units, turned, and the norms of what follows each cut."""

    def __init__(self, vecs: np.ndarray, turn: np.ndarray | None):
        self.given = vecs
        self.unit = units(vecs)
        self.turned = self.unit if turn is None else self.unit @ turn
        d = vecs.shape[1]
        cuts = [min(d, LEAD)]
        while cuts[-1] < d:
            cuts.append(min(d, 2 * cuts[-1]))
        self.cuts = cuts
        squares = np.cumsum((self.turned ** 2)[:, ::-1], axis=1)[:, ::-1]
        self.rest = [np.sqrt(squares[:, c]) if c < d else np.zeros(len(vecs)) for c in cuts]


def alike(a: Tile, b: Tile, rows: slice, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, mask over them): pairs of a's rows and b whose cosine is
    ``least`` or more; outside the rows and columns given there is none."""
    i, j, before = np.arange(len(a.unit))[rows], np.arange(len(b.unit)), 0
    dots = np.zeros((len(i), len(j)))
    for cut, ra, rb in zip(a.cuts, a.rest, b.rest, strict=True):
        dots += a.turned[i, before:cut] @ b.turned[j, before:cut].T
        can = dots + ra[i, None] * rb[None, j] >= least - NEAR
        up, across = can.any(axis=1), can.any(axis=0)
        if not up.any():
            return i[:0], j[:0], np.zeros((0, 0), bool)
        if not (up.all() and across.all()):
            i, j, dots = i[up], j[across], dots[np.ix_(up, across)]
        before = cut
    close = dots >= least
    for r, c in np.argwhere(np.abs(dots - least) < NEAR):
        x, y = a.given[i[r]], b.given[j[c]]
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        close[r, c] = np.dot(x, y) / math.sqrt(np.dot(x, x) * np.dot(y, y)) >= least
    return i, j, close


def meet(a: Tile, b: Tile, na: np.ndarray, nb: np.ndarray, least: float, same: bool):
    """(links of a's rows, links of b's rows, forest): how many vectors each row
    is linked to, and index pairs that connect just what the links connect."""
    la, lb = np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64)
    label = np.arange(len(na) if same else len(na) + len(nb))
    right, forest = label if same else label[len(na):], []
    for at in range(0, len(na), STRIP):
        i, j, close = alike(a, b, slice(at, at + STRIP), least)
        if not len(i):
            continue
        if same:
            close &= i[:, None] != j[None, :]
        la[i] += close @ nb[j]
        if not same:
            lb[j] += na[i] @ close
        for r, row in zip(i.tolist(), close, strict=True):
            hits = j[row]
            if not len(hits):
                continue
            labels, first = np.unique(right[hits], return_index=True)
            own = label[r]
            for x, f in zip(labels.tolist(), first.tolist(), strict=True):
                if x != own:
                    forest.append((r, int(hits[f])))
                    label[label == x] = own
    return la, lb, forest


def classes_of(vectors: DataFrame, d: int, turn: np.ndarray, grid: int, width: float) -> DataFrame:
    """(vec_id, label, key, cell, vec): key names label and vector, and is null
    where the row takes no part; cell is the grid cell of its leading coordinates."""
    held = vectors.sparkSession.sparkContext.broadcast(turn[:, :grid].copy())
    base, middle = 2 * math.ceil(1 / width) + 5, math.ceil(1 / width) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, keys, cells, vecs = b.column(1).to_pylist(), [], [], []
            for label, x in zip(labels, _usable(b.column(2)), strict=True):
                if x is None or label is None:
                    keys.append(None)
                    cells.append(None)
                    vecs.append(None)
                    continue
                raw, code = x.tobytes(), 0
                if len(x) == d:
                    at = np.floor(units(x[None, :])[0] @ held.value / width).astype(np.int64) + middle
                    for c in at.tolist():
                        code = code * base + c
                name = hashlib.md5(raw, usedforsecurity=False)
                name.update(label.encode())
                keys.append(name.hexdigest())
                cells.append(code)
                vecs.append(raw)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(keys, pa.string()), pa.array(cells, pa.int64()), pa.array(vecs, pa.binary())],
                names=["vec_id", "label", "key", "cell", "vec"])
    return vectors.mapInArrow(run, "vec_id long, label string, key string, cell long, vec binary")


def links(classes: DataFrame, d: int, turn: np.ndarray, grid: int, width: float, least: float, tile: int) -> DataFrame:
    """(a, b, n) over the distinct vectors (key, label, cell, vec, n): a row with
    b null says that a is linked to n other vectors of another key (a share of
    them: add up), a row with b that a and b are connected."""
    spark = classes.sparkSession
    base = 2 * math.ceil(1 / width) + 5
    marked = classes.withColumn("kind", F.concat_ws(":", (F.length("vec") / 8).cast("int"), "label"))
    cells = materialize(marked.groupBy("kind", "cell").agg(F.count("*").alias("n"))
                        .select("kind", "cell", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    dealt = marked.join(cells, ["kind", "cell"]) \
        .withColumn("t", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    tiles = materialize(dealt.groupBy("kind", "cell", "t").agg(F.collect_list(F.struct("key", "n", "vec")).alias("rows")))
    steps = [sum(x * base ** i for i, x in enumerate(p)) for p in itertools.product((-1, 0, 1), repeat=grid)]
    near = cells.select("kind", F.col("cell").alias("a"), F.col("tiles").alias("ka"),
                        F.explode(F.array([F.lit(s).cast("long") for s in sorted(steps) if s >= 0])).alias("step")) \
        .withColumn("b", F.col("a") + F.col("step")) \
        .join(cells.select("kind", F.col("cell").alias("b"), F.col("tiles").alias("kb")), ["kind", "b"]) \
        .withColumn("ta", F.explode(F.expr("sequence(0, ka - 1)"))).withColumn("tb", F.explode(F.expr("sequence(0, kb - 1)"))) \
        .where("a != b or ta <= tb").select("kind", "a", "ta", "b", "tb")
    met = near.join(tiles.select("kind", F.col("cell").alias("a"), F.col("t").alias("ta"), F.col("rows").alias("left")),
                    ["kind", "a", "ta"]) \
        .join(tiles.select("kind", F.col("cell").alias("b"), F.col("t").alias("tb"), F.col("rows").alias("right")),
              ["kind", "b", "tb"]) \
        .select(F.expr("a = b and ta = tb").alias("same"), "left", "right")
    held = spark.sparkContext.broadcast(turn)

    def opened(col: pa.Array, k: int) -> tuple[Tile, np.ndarray, list[str]]:
        rows = col[k].values
        vecs = np.frombuffer(b"".join(rows.field("vec").to_pylist()), np.float64).reshape(len(rows), -1)
        return Tile(vecs, held.value if vecs.shape[1] == d else None), \
            rows.field("n").to_numpy(zero_copy_only=False), rows.field("key").to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, same in enumerate(batch.column(0).to_pylist()):
                a, na, ka = opened(batch.column(1), k)
                b, nb, kb = (a, na, ka) if same else opened(batch.column(2), k)
                la, lb, forest = meet(a, b, na, nb, least, same)
                out = [(ka[i], None, int(la[i])) for i in np.nonzero(la)[0]]
                out += [(kb[i], None, int(lb[i])) for i in np.nonzero(lb)[0]]
                out += [(ka[i], kb[j], 0) for i, j in forest]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                     pa.array([x[2] for x in out], pa.int64())], names=["a", "b", "n"])
    return met.mapInArrow(run, "a string, b string, n long")


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", col: str = "embedding",
                    label_col: str = "label", tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors``.

    Rows are linked if their labels are equal, their vectors of one length and
    the cosine in double precision is ``least`` or more; n_links counts the other
    rows linked directly, component_id is the least vec_id reachable (itself
    included), kept says that it is the row's own. Rows without label, and vectors
    that are null, empty, zero or hold null or non-finite components, link with
    nothing. A null vec_id links like any other and names no component (one of
    nulls alone has a null id, and its rows are kept); rows that repeat a vec_id
    are rows of their own; an empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    batches_of(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(col).cast("array<double>").alias("vec"))
    common = rows.where("size(vec) > 0").groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = common["d"] if common else 1
    weights, turn = axes(rows, d)
    width = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-6
    grid = axes_for(common["count"] if common else 0, weights, width, tile)
    named = classes_of(rows, d, turn, grid, width)
    marked = materialize(named.select("vec_id", "key"))
    classes = materialize(named.where("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("cell").alias("cell"), F.first("vec").alias("vec"),
        F.count("*").alias("n"), F.min("vec_id").alias("least")))
    with rows_at_once(spark, 8):  # a row is two whole tiles
        found = materialize(links(classes, d, turn, grid, width, least, tile))
    counts = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    roots = materialize(components(found.where("b is not null").select("a", "b")))
    rooted = classes.select("key", "n", "least").join(roots.withColumnRenamed("node", "key"), "key", "left") \
        .withColumn("root", F.coalesce("root", "key")).join(counts, "key", "left")
    # Written, so that the join's exchange on a hot root can be split.
    ids = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    known = rooted.join(ids, "root").select(
        "key", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = marked.join(known, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
