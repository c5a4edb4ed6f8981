"""Approximate nearest neighbours by multi-index hashing.

Codes are signs of learned rotations of the centred vectors (iterative
quantisation, several rotations side by side). A block's codes are cut into
substrings, each with a bucket index. A query probes, for each substring, the
buckets within ``radius // substrings`` bits: by the pigeonhole principle no
code within the radius is missed. What the probes bring is checked on the whole
code and then ranked by the inner product of the original vectors. The radius
is learnt: the distance that holds ``COVER`` of the true neighbours of a few
queries, found by comparing these with every vector. A block in which fewer
than k codes lie within it widens it until there are k.

Index rows and queries meet block by block (every pair of an index block and a
query block once), and each meeting returns k rows a query at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import batches_of
from patronage.session import materialize

#: Bits of a code and of a substring.
BITS, PART = 256, 16
#: Vectors that the rotations are fitted on; queries that the radius is learnt from; neighbours it must cover.
SAMPLE, PROBES, COVER = 16_384, 192, 0.98
#: Vectors and queries in a block.
BLOCK, QUERIES = 16_384, 1024
ROUNDS, SEED = 25, 11
POP = np.bitwise_count(np.arange(1 << PART, dtype=np.uint32)).astype(np.uint8)


class Coder:
    """Mean and rotations; ``codes`` gives the signs as packed bytes."""

    def __init__(self, x: np.ndarray, bits: int = BITS):
        rng = np.random.default_rng(SEED)
        d = x.shape[1]
        self.mean = x.mean(axis=0) if len(x) else np.zeros(d)
        z = x - self.mean
        parts = []
        for _ in range(math.ceil(bits / d)):
            r = np.linalg.qr(rng.normal(size=(d, d)))[0]
            for _ in range(ROUNDS if len(z) >= d else 0):
                u, _, v = np.linalg.svd(np.sign(z @ r).T @ z)
                r = (u @ v).T
            parts.append(r)
        self.turn = np.concatenate(parts, axis=1)[:, :bits]

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.packbits((x - self.mean) @ self.turn > 0, axis=1)


class Block:
    """Bucket indexes over the substrings of some codes."""

    def __init__(self, codes: np.ndarray):
        self.words = np.ascontiguousarray(codes).view(np.uint64)
        self.parts = np.ascontiguousarray(codes).view(np.uint16)
        self.index = []
        for j in range(self.parts.shape[1]):
            order = np.argsort(self.parts[:, j], kind="stable")
            values, counts = np.unique(self.parts[order, j], return_counts=True)
            self.index.append((order, values, counts))

    def within(self, code: np.ndarray, radius: int, k: int) -> np.ndarray:
        """Rows whose codes differ in at most the radius; if they are fewer
        than k, the radius is that of the k-th nearest code."""
        n = len(self.words)
        seen = np.zeros(n, bool)
        per = radius // self.parts.shape[1]
        for (order, values, counts), q in zip(self.index, code.view(np.uint16), strict=True):
            seen[order[np.repeat(POP[values ^ q] <= per, counts)]] = True
        rows = np.nonzero(seen)[0]
        off = np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int32)
        near = rows[off <= radius]
        if len(near) >= min(k, n):
            return near
        off = np.bitwise_count(self.words ^ code.view(np.uint64)).sum(axis=1, dtype=np.int32)
        return np.nonzero(off <= np.partition(off, min(k, n) - 1)[min(k, n) - 1])[0]


def usable(vectors: DataFrame, id_col: str, col: str) -> DataFrame:
    """(vec_id, vec): one row for each id, vectors as bytes of doubles; of the
    most common length, without nulls, zeros or anything that is not finite."""
    v = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(col).cast("array<double>").alias("vec")) \
        .where("vec_id is not null and vec is not null and size(vec) > 0")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) \
        & F.exists("vec", lambda x: x != 0)
    v = v.where(fine)
    d = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.where(F.size("vec") == (d["d"] if d else 0))


def matrix(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.float64).reshape(len(col), -1)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def neighbours(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", col: str = "embedding",
               block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query.

    ``is_query`` is a condition on vec_id. Candidates are all rows of another
    vec_id; of rows that repeat a vec_id one (the least vector) takes part, rows
    without an id none. Unusable vectors (see ``usable``) take no part; an empty
    table gives no rows; other columns are not read. Equal scores go by vec_id.
    """
    spark = vectors.sparkSession
    batches_of(spark)
    fine = usable(vectors, id_col, col)
    one = materialize(fine.groupBy("vec_id").agg(F.min("vec").alias("vec")))
    # Bounded: SAMPLE vectors come to the driver, where the rotations are fitted.
    sample = one.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    coder = spark.sparkContext.broadcast(Coder(np.array([r["vec"] for r in sample], np.float64)))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array(b["vec"].tolist(), np.float64).reshape(len(b), -1)
            c = coder.value.codes(x)
            yield pd.DataFrame({"vec_id": b["vec_id"], "vec": [r.tobytes() for r in x], "code": [r.tobytes() for r in c]})
    rows = materialize(one.mapInPandas(coded, "vec_id long, vec binary, code binary"))
    n = rows.count()
    asked = rows.where(is_query(F.col("vec_id")))
    radius = learnt_radius(rows, asked, k)
    blocks, parts = max(1, math.ceil(n / block)), max(1, math.ceil(asked.count() / queries))
    left = rows.withColumn("ib", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .withColumn("qb", F.explode(F.expr(f"sequence(0, {parts - 1})")))
    right = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int")) \
        .withColumn("ib", F.explode(F.expr(f"sequence(0, {blocks - 1})")))

    def meet(a: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(q):
            ids, x = a["vec_id"].to_numpy(), matrix(a["vec"])
            index = Block(np.frombuffer(b"".join(a["code"]), np.uint8).reshape(len(a), -1))
            codes = np.frombuffer(b"".join(q["code"]), np.uint8).reshape(len(q), -1)
            for i, v, c in zip(q["vec_id"], matrix(q["vec"]), codes, strict=True):
                near = index.within(np.ascontiguousarray(c), radius, k + 1)
                near = near[ids[near] != i]
                s = x[near] @ v
                top = best(ids[near], s, k)
                out.append(pd.DataFrame({"query_id": i, "vec_id": ids[near][top], "score": s[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    found = left.groupBy("ib", "qb").cogroup(right.groupBy("ib", "qb")) \
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def learnt_radius(rows: DataFrame, asked: DataFrame, k: int) -> int:
    """Bits that hold ``COVER`` of the k true neighbours of ``PROBES`` queries
    (a bounded number), each compared with every vector."""
    some = asked.orderBy(F.xxhash64("vec_id", F.lit(2)), "vec_id").limit(PROBES).collect()
    if not some:
        return 0
    ids = np.array([r["vec_id"] for r in some])
    x = np.frombuffer(b"".join(bytes(r["vec"]) for r in some), np.float64).reshape(len(some), -1)
    codes = np.frombuffer(b"".join(bytes(r["code"]) for r in some), np.uint64).reshape(len(some), -1)
    held = rows.sparkSession.sparkContext.broadcast((ids, x, codes))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x, codes = held.value
        kept: list[pd.DataFrame] = [pd.DataFrame({"query_id": [], "score": [], "off": []})] * len(ids)
        for b in batches:
            own, v = b["vec_id"].to_numpy(), matrix(b["vec"])
            c = np.frombuffer(b"".join(b["code"]), np.uint64).reshape(len(b), -1)
            s = np.where(own[None, :] == ids[:, None], -np.inf, x @ v.T)
            for j, i in enumerate(ids):
                top = np.argsort(-s[j], kind="stable")[:k]
                off = np.bitwise_count(c[top] ^ codes[j]).sum(axis=1, dtype=np.int32)
                new = pd.DataFrame({"query_id": i, "score": s[j][top], "off": off})
                kept[j] = new if not len(kept[j]) else pd.concat([kept[j], new]).nlargest(k, "score", keep="first")
        for one in kept:
            yield one[one["score"] > -np.inf].astype({"query_id": "int64", "score": "float64", "off": "int32"})
    near = rows.mapInPandas(compare, "query_id long, score double, off int")
    top = near.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))) \
        .where(F.col("r") <= k).groupBy("off").count().collect()  # a row for each distance
    total, seen = sum(r["count"] for r in top), 0
    for r in sorted(top, key=lambda r: r["off"]):
        seen += r["count"]
        if seen >= COVER * total:
            return int(r["off"])
    return 0
