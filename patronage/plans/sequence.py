"""Previous-row lookups within a key, safe for a hot key.

``Window.partitionBy(key).orderBy(t)`` sends all rows of a key to one task;
if one customer holds a third of the rows, so does one task. Instead the
rows are range-partitioned on ``(key, t, tiebreak)`` — a hot key is split
across several ranges — and one scan of each sorted range carries the row
before along. The first row of a range takes the last row of the ranges before
it from a table of N rows, N = number of ranges. Rows are exchanged once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronage.plans.ranking import scanned, segment_starts


class _Before:
    """The value of the row before, null where the key differs; and whether a
    row is its range's first."""

    def __init__(self, key: str, value: str):
        self.key, self.value, self.last = key, value, None

    def __call__(self, b: pa.RecordBatch) -> list[pa.Array]:
        key, value = b.column(self.key), b.column(self.value)
        first = self.last is None
        new = segment_starts([key])
        if not first:
            new[0] = not self.last[0].equals(key.slice(0, 1))
        head = pa.nulls(1, value.type) if first else self.last[1]
        before = pa.concat_arrays([head, value.slice(0, len(value) - 1)])
        mask = new | key.is_null().to_numpy(zero_copy_only=False)
        self.last = (key.slice(len(key) - 1), value.slice(len(value) - 1))
        edge = np.zeros(len(key), bool)
        edge[0] = first
        return [pc.if_else(pa.array(mask), pa.nulls(len(value), value.type), before), pa.array(edge)]


def lag_within(df: DataFrame, key: str, order: list[str], value: str, out: str,
               n_parts: int | None = None) -> DataFrame:
    """Adds ``out`` = ``value`` of the previous row of the same ``key`` in
    ``order`` (which must make rows unique within a key), null for a key's first
    row and for a null key."""
    kind = df.schema[value].dataType.simpleString()
    rows = scanned(df, [F.col(c).asc() for c in [key, *order]], lambda: _Before(key, value),
                   f"`__before` {kind}, `__edge` boolean", n_parts)
    last = rows.groupBy("__pid").agg(F.max_by(F.struct(F.col(key).alias("k"), F.col(value).alias("v")), "__mid").alias("last"))
    upto = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select("__pid", F.last("last", ignorenulls=True).over(upto).alias("__carry"))
    carried = F.when(F.col("__carry.k") == F.col(key), F.col("__carry.v"))
    return rows.join(F.broadcast(carry), "__pid", "left") \
        .withColumn(out, F.when(F.col("__edge"), carried).otherwise(F.col("__before"))) \
        .drop("__pid", "__mid", "__before", "__edge", "__carry")
