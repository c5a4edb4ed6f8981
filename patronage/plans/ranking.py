"""Global ranks, running sums, rank bins and quantiles — without a
single-partition exchange.

``Window.orderBy`` with no partition key plans ``Exchange SinglePartition``:
one task would sort every row. Instead:

1. ``repartitionByRange(N, order)`` + ``sortWithinPartitions(order)``: the only
   exchange of rows. What a row needs of the rows before it in its own range is
   taken in that stage (its index, or a scan that carries its state through the
   sorted partition), and the result is written: the range split is computed
   once, nothing stays in memory, and a lost executor costs a task.
2. A table of ranges (N rows, N = partition count, bounded by configuration)
   gives what the ranges before hold; it is joined back by range.

The order must be total (callers append their key as a tie-break) so the
rank is deterministic and recomputation after a lost executor reproduces it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from patronage.session import materialize, ship_package


def range_partition(df: DataFrame, order: list[Column], n_parts: int | None = None) -> DataFrame:
    """Range-partition on ``order`` and sort within partitions.

    Without ``n_parts`` the count comes from ``spark.sql.shuffle.partitions``
    and AQE may coalesce small ranges; coalesced partitions are contiguous runs
    of ranges, so partition ids stay in global order (offsets are computed from
    the ids actually present, never from a planned count).
    """
    ranged = df.repartitionByRange(n_parts, *order) if n_parts else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def scanned(df: DataFrame, order: list[Column], scan: Callable, added: str, n_parts: int | None = None) -> DataFrame:
    """The rows in ranges of ``order``, with __pid (rising with the order), __mid
    (rising within a range) and the columns ``added`` (DDL) that ``scan`` makes:
    called once a range, it gives a function from a batch of rows to arrays, and
    is called for the range's batches in order. Written."""
    ship_package(df.sparkSession)
    tagged = range_partition(df, order, n_parts).withColumns({"__pid": F.spark_partition_id(),
                                                              "__mid": F.monotonically_increasing_id()})
    schema = T.StructType([*tagged.schema.fields, *T._parse_datatype_string(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = scan()
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, *step(b)], names=schema.names)
    return materialize(tagged.mapInArrow(run, schema))


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                n_parts: int | None = None) -> DataFrame:
    """RNK1: 1-based position of each row in the total order ``order``."""
    tagged = materialize(range_partition(df, order, n_parts)
                         .withColumn("__pid", F.spark_partition_id())
                         .withColumn("__mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = tagged.join(F.broadcast(offsets), "__pid", "inner")
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return out.withColumn(rank_col, F.col("__off") + local + 1).drop("__pid", "__mid", "__off")


def segment_starts(columns: list[pa.Array]) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns (nulls are equal)."""
    n = len(columns[0]) if columns else 0
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


class _Prefix:
    """Exclusive running sums within runs of equal group values, carried from batch to batch."""

    def __init__(self, group: list[str], sums: list[str]):
        self.group, self.sums = group, sums
        self.last: list | None = None
        self.carry = [0] * len(sums)

    def __call__(self, b: pa.RecordBatch) -> list[pa.Array]:
        keys = [b.column(g) for g in self.group]
        new = segment_starts(keys)
        same = self.last is not None and self.last == [k[0].as_py() for k in keys]
        out = []
        run = np.cumsum(new) - 1 if len(new) else np.zeros(0, np.int64)
        starts = np.flatnonzero(new)
        for i, c in enumerate(self.sums):
            v = b.column(c).fill_null(0).to_numpy(zero_copy_only=False)
            upto = np.concatenate([np.zeros(1, v.dtype), np.cumsum(v)])
            base = upto[starts]
            got = upto[:-1] - base[run]
            if same:
                got[run == 0] += self.carry[i]
            self.carry[i] = got[-1] + v[-1]
            out.append(pa.array(got))
        self.last = [k[-1].as_py() for k in keys]
        return out


def grouped_prefix(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, str],
                   n_parts: int | None = None) -> DataFrame:
    """Exclusive running sums within each group in ``order`` (a total order
    within the group), without putting a whole group in one task.

    Two levels: rows are range-partitioned on (group, order), so a large group
    spans several ranges; running sums are taken inside each (range, group) by a
    scan; each (range, group) gets the totals of the same group in earlier ranges
    from a table with at most ranges + groups rows. ``sums`` maps output column
    → summed column (numbers; a sum of integers is a long).
    """
    wide = df.withColumns({f"__v_{o}": F.col(c).cast("double" if df.schema[c].dataType in (T.DoubleType(), T.FloatType())
                                                    else "long") for o, c in sums.items()})
    kinds = {o: wide.schema[f"__v_{o}"].dataType.simpleString() for o in sums}
    values = [f"__v_{o}" for o in sums]
    groups = list(group)
    local = scanned(wide, [*[F.col(c) for c in group], *order], lambda: _Prefix(groups, values),
                    ", ".join(f"`__l_{o}` {k}" for o, k in kinds.items()), n_parts)
    totals = local.groupBy("__pid", *group).agg(*[F.sum(f"__v_{o}").alias(f"__t_{o}") for o in sums])
    wo = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__pid").alias("__p"), *[F.col(g).alias(f"__g_{i}") for i, g in enumerate(group)],
                            *[F.coalesce(F.sum(f"__t_{o}").over(wo), F.lit(0)).alias(f"__o_{o}") for o in sums])
    same = F.col("__pid") == F.col("__p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{i}"))
    return local.join(offsets, same).withColumns({o: F.col(f"__o_{o}") + F.col(f"__l_{o}") for o in sums}) \
        .drop("__pid", "__mid", "__p", *[f"__g_{i}" for i in range(len(group))],
              *[f"{x}{o}" for o in sums for x in ("__l_", "__o_", "__v_")])


def group_quantiles(df: DataFrame, group: str | None, value: str, probs: list[float],
                    n_parts: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy / ``percentile`` semantics)
    per group, without buffering a group's values in one task.

    Only distinct (group, value) pairs are sorted, with their counts: equal
    values take one row, so a value that most rows hold is no hot range. A
    pair covers the positions from the count below it on; for each probability
    the pairs that cover ⌊(n−1)p⌋ and ⌈(n−1)p⌉ give the value. Output:
    (group, p, quantile).
    """
    g = group or "__g"
    base = df.select((F.col(group) if group else F.lit(0)).alias(g), F.col(value).cast("double").alias("__v")) \
        .where(F.col("__v").isNotNull())
    counts = base.groupBy(g, "__v").agg(F.count(F.lit(1)).alias("__c"))
    sizes = counts.groupBy(g).agg(F.sum("__c").alias("__n"))
    run = grouped_prefix(counts, [g], [F.col("__v").asc()], {"__below": "__c"}, n_parts).join(sizes, g) \
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs]))) \
        .withColumn("__pos", (F.col("__n") - 1) * F.col("p"))

    def held(at: Column) -> Column:
        return (F.col("__below") <= at) & (at < F.col("__below") + F.col("__c"))
    lo, hi = held(F.floor("__pos")), held(F.ceil("__pos"))
    ends = run.where(lo | hi).groupBy(g, "p").agg(
        F.max(F.when(lo, F.col("__v"))).alias("__lo"), F.max(F.when(hi, F.col("__v"))).alias("__hi"),
        F.max(F.col("__pos") - F.floor("__pos")).alias("__frac"))
    out = ends.select(g, "p", F.when(F.col("__frac") == 0, F.col("__lo"))
                      .otherwise(F.col("__lo") + F.col("__frac") * (F.col("__hi") - F.col("__lo"))).alias("quantile"))
    return out if group else out.drop(g)


def rank_bin(rank: str | Column, n: str | Column, k: int) -> Column:
    """RNK2: ``qcut`` of ranks 1..n into k equal-count bins (1-based), exact
    integer form of ``max(1, ceil((rank-1)·k/(n-1)))``. Not ``ntile``."""
    r = F.col(rank) if isinstance(rank, str) else rank
    m = F.col(n) if isinstance(n, str) else n
    num = (r - 1) * k
    den = F.greatest(m - 1, F.lit(1))
    return F.greatest(F.lit(1), F.least(F.lit(k), F.floor((num + den - 1) / den).cast("int")))
