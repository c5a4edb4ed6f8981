"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words (ASCII-lowered, punctuation trimmed) and their
four- and five-character beginnings, hashed into buckets. The machine adds to
the linear weights an inner product of factors for each pair of terms present,
so a pair (an insult beside a group's name) can weigh more than its parts.

It is fitted on a bounded sample of labelled rows (``SAMPLE`` rows, half of each
class as far as there are, least hash first) in one task; the intercept is then
set back to the labelled rows' own share of positives. Every row is scored on
its whole text, without a shuffle.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of
from patronage.session import materialize

#: Labelled rows that the fit reads at most.
SAMPLE = 16_000
#: Hash buckets; buckets that take part at most; factors; score from which a text is toxic.
BUCKETS, ACTIVE, FACTORS, CUT = 1 << 22, 2048, 8, 0.7
#: A bucket takes part if it occurs in so many sampled texts, with such a difference between classes
#: (in standard errors).
LEAST, APART = 3, 3.0
STEPS, BATCH, RATE, DECAY, SEED = 900, 256, 0.1, 1e-4, 7
EDGES = b".,;:!?\"'()[]*_-"


def terms(text: str | None) -> set[int]:
    """Buckets of a text's terms."""
    words = {w.strip(EDGES) for w in set((text or "").encode().lower().split())}
    words.discard(b"")
    crc, out = zlib.crc32, set()
    heads = set()
    for w in words:
        out.add(crc(w) % BUCKETS)
        if len(w) > 4:
            c = w.decode(errors="replace")
            if len(c) > 4:
                heads.add(c[:4])
                if len(c) > 5:
                    heads.add(c[:5])
    out.update(crc(b"^" + h.encode()) % BUCKETS for h in heads)
    return out


class Machine:
    """Bias, linear weights and factors of the buckets that take part."""

    def __init__(self, buckets: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray):
        self.buckets, self.bias, self.weight, self.factor = buckets, float(bias), weight, factor
        self.place = {int(b): k for k, b in enumerate(buckets)}

    def score(self, text: str | None) -> float:
        place = self.place
        at = sorted(place[t] for t in terms(text) if t in place)
        z = self.bias
        if at:
            v = self.factor[at]
            z += self.weight[at].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum()
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

    def dump(self) -> bytes:
        f = io.BytesIO()
        np.savez(f, buckets=self.buckets, bias=self.bias, weight=self.weight, factor=self.factor)
        return f.getvalue()

    @staticmethod
    def load(data: bytes) -> Machine:
        with np.load(io.BytesIO(data)) as z:
            return Machine(z["buckets"], float(z["bias"]), z["weight"], z["factor"])


def fit(rows: list[tuple[list[int], int]], share: float) -> Machine:
    """A machine from (buckets, label) rows; share: of positives among all labelled rows."""
    y = np.array([label for _, label in rows], np.float64)
    ones, zeros = max(1.0, y.sum()), max(1.0, (1 - y).sum())
    flat = np.concatenate([np.asarray(t, np.int32) for t, _ in rows] or [np.zeros(0, np.int32)])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(t) for t, _ in rows])
    found = np.unique(flat)
    place = np.searchsorted(found, flat).astype(np.int32)
    del flat
    pos = np.bincount(place, y[owner], len(found))
    neg = np.bincount(place, 1 - y[owner], len(found))
    p = (pos + neg) / (ones + zeros)
    gap = (pos / ones - neg / zeros) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / ones + 1 / zeros))
    strength = np.where(pos + neg >= LEAST, np.abs(gap), 0)
    best = np.argsort(-strength, kind="stable")[:ACTIVE]
    best = np.sort(best[strength[best] >= APART])
    new = np.full(len(found), -1)
    new[best] = np.arange(len(best))
    rng = np.random.default_rng(SEED)
    weight, factor, bias = np.zeros(len(best)), rng.normal(0, 0.05, (len(best), FACTORS)), 0.0
    at = new[place]
    own, at = owner[at >= 0], at[at >= 0]
    cuts = np.searchsorted(own, np.arange(len(rows) + 1))
    x = [at[cuts[k]:cuts[k + 1]] for k in range(len(rows))]
    sums = [np.full(len(best), 1e-6), np.full((len(best), FACTORS), 1e-6), 1e-6]
    batches = max(1, len(rows) // BATCH)
    for _ in range(-(-STEPS // batches) if len(best) else 0):
        for part in np.array_split(rng.permutation(len(rows)), batches):
            dense = np.zeros((len(part), len(best)))
            for k, r in enumerate(part):
                dense[k, x[r]] = 1
            s = dense @ factor
            z = bias + dense @ weight + 0.5 * (s ** 2 - dense @ factor ** 2).sum(axis=1)
            e = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[part]) / len(part)
            steps = (dense.T @ e + DECAY * weight,
                     dense.T @ (e[:, None] * s) - (dense.T @ e)[:, None] * factor + DECAY * factor, e.sum())
            sums = [a + g ** 2 for a, g in zip(sums, steps, strict=True)]
            weight = weight - RATE * steps[0] / np.sqrt(sums[0])
            factor = factor - RATE * steps[1] / np.sqrt(sums[1])
            bias -= RATE * steps[2] / np.sqrt(sums[2])
    share = min(max(share, 1e-4), 1 - 1e-4)
    bias += np.log(share / (1 - share)) - np.log(ones / zeros)
    return Machine(found[best], bias, weight, factor)


def held_out():
    """Rows that are scored but never learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on the labelled documents outside the held-out third.

    Rows without doc_id, text or label are left out, repeated labels count once
    (toxic if any says so) and so do repeated documents. Without labelled rows of both
    classes the machine is the bare share of positives.
    """
    batches_of(docs.sparkSession)
    marked = materialize(
        labels.where("doc_id is not null and toxic is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = materialize(
        marked.join(docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct(),
                    "doc_id"))
    count = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("ones")).first()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    half = sample // 2
    picked = known.where("toxic = 1").orderBy(*order).limit(half) \
        .union(known.where("toxic = 0").orderBy(*order).limit(half))
    picked = materialize(picked)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [sorted(terms(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(got, pa.list_(pa.int32()))],
                                             names=["doc_id", "toxic", "terms"])
    # picked is bounded by the sample, so every executor can hold it.
    seen = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .join(F.broadcast(picked), "doc_id") \
        .mapInArrow(read, "doc_id long, toxic int, terms array<int>")
    seen = materialize(seen.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "terms"), F.xxhash64("terms")).alias("r"))
                       .select("doc_id", "r.*"))
    share = (count["ones"] / count["n"]) if count["n"] else 0.0

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        rows = list(zip(pdf["terms"], pdf["toxic"], strict=True))
        return pd.DataFrame({"model": [fit(rows, share).dump()]})
    got = seen.groupBy(F.lit("all").alias("fit")).applyInPandas(train, "model binary").collect()
    return Machine.load(got[0]["model"]) if got else fit([], share)


def score_texts(docs: DataFrame, machine: Machine, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for each document row."""
    batches_of(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(machine.dump())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine.load(data.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m.score(t) for t in b.column(1).to_pylist()], pa.float64())],
                names=["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double") \
        .select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                (F.col("score") >= cut).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from ``cut`` on) for
    every document row, from its text alone.

    A null or empty text has no terms and gets the bare share of positives; a
    null doc_id is kept (not held out); repeated rows repeat; an empty table
    gives none; other columns are not read.
    """
    return score_texts(docs, learn(docs, labels), cut)


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows whose text scores below ``cut``, all columns kept."""
    batches_of(docs.sparkSession)
    machine = learn(docs, labels)
    data = docs.sparkSession.sparkContext.broadcast(machine.dump())

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Machine.load(data.value)
        for texts in parts:
            yield pd.Series([m.score(t) for t in texts], dtype="float64")
    return docs.where(score(F.col("text").cast("string")) < cut)
