"""Join helpers: broadcast only by Spark's own size check, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a dimension whose size is not known up front, without a hint.

    Spark broadcasts only when the side's size — the static estimate, or AQE's
    measured shuffle size at run time — is under
    ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join shuffles
    (sort-merge, skew-split by AQE).
    """
    return fact.join(dim, on, how)


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate to every row.

    Each column becomes a scalar subquery (``DataFrame.scalar``): Catalyst
    merges subqueries over the same aggregate, runs it once and inlines the
    values — no join, nothing collected by user code.
    """
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


#: Rows of a part whose sort or hash table is to fit a task's share of the memory.
PART_ROWS = 1 << 18


def parts_of(df: DataFrame, rows: int | None = None) -> int:
    """Parts to deal the rows out into: the session's number, or more where a part
    would have over ``PART_ROWS``. With a number given to ``repartition`` parts are
    not put together again by their compressed size, which says little of the memory."""
    n = df.count() if rows is None else rows
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PART_ROWS))
