"""Poisson bootstrap that sorts the rows once, whatever the number of replicates.

A row's weight in a replicate is a Poisson(1) draw from a hash of its key and
the replicate's number: two multiplicative rounds modulo a prime, integers only,
so Catalyst, numpy and SQL give the same weights on any layout of the data.

Rows are range-partitioned on (model, score, key) and written. Each range takes
the running sums of all replicates together, a matrix of about a thousand rows
at a time, and gives its totals; a tie that lies across ranges is given as
pieces. What is shuffled afterwards is ranges x replicates, not rows x
replicates. The rank correlation needs both ranks of the rows with a target
other than 0 (returning customers) in every replicate: each of them goes out once,
with its ranks by score in one value of two bytes a replicate, is sorted by target,
and gets its weights again from its key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from patronage.plans.ranking import range_partition
from patronage.session import materialize, ship_package

#: Modulus (a Mersenne prime; x -> x^5 permutes its residues) and the steps of replicate and seed.
PRIME, REPLICATE_STEP, SEED_STEP = 2 ** 31 - 1, 1_000_003, 7_777_777
#: Hash values below the k-th limit have a weight of at most k (the distribution function of Poisson(1)).
LIMITS = [math.floor(PRIME * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(12)]
#: Cells (rows x replicates) of one matrix, and of the part of it whose weights are drawn together.
CELLS, CACHED = 1 << 20, 1 << 15
#: Rows of a range, unless that makes more ranges than ``spark.sql.shuffle.partitions``.
RANGE = 1 << 14


def key_hashes(key: str) -> dict[str, Column]:
    """Two 28-bit numbers from the digest of the key."""
    digest = F.md5(F.col(key).cast("string"))
    return {"__h1": F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint"),
            "__h2": F.conv(F.substring(digest, 8, 7), 16, 10).cast("bigint")}


def _fold(x: np.ndarray, spare: np.ndarray) -> None:
    """A smaller number of the same residue (in place): 2 ** 31 is 1 modulo PRIME."""
    np.right_shift(x, np.uint64(31), out=spare)
    np.bitwise_and(x, np.uint64(PRIME), out=x)
    np.add(x, spare, out=x)


def _fifths(x: np.ndarray, square: np.ndarray, spare: np.ndarray) -> None:
    """x ** 5 of numbers up to PRIME, in place, within 64 bits; the result is up to PRIME + 2."""
    np.multiply(x, x, out=square)
    _fold(square, spare)
    np.multiply(square, square, out=square)
    _fold(square, spare)
    _fold(square, spare)
    np.multiply(square, x, out=x)
    _fold(x, spare)
    _fold(x, spare)


def weights(h1: np.ndarray, h2: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """Weights of rows (down) in replicates 1 to ``n_boot`` (across), a byte each."""
    out = np.empty((len(h1), n_boot), np.uint8)
    step = max(1, CACHED // n_boot)
    of_replicate = ((np.arange(1, n_boot + 1, dtype=np.int64) * REPLICATE_STEP + seed * SEED_STEP) % PRIME).astype(np.uint64)
    h1, h2 = (h.astype(np.uint64)[:, None] for h in (h1, h2))
    held = [np.empty((min(step, len(out)), n_boot), np.uint64) for _ in range(3)]
    for i in range(0, len(out), step):
        w = out[i:i + step]
        x, square, spare = (m[:len(w)] for m in held)
        np.add(h1[i:i + step], of_replicate, out=x)
        _fold(x, spare)
        _fifths(x, square, spare)
        np.add(x, h2[i:i + step], out=x)
        _fold(x, spare)
        _fifths(x, square, spare)
        np.subtract(x, np.uint64(PRIME), out=x, where=x >= PRIME)
        x = x.astype(np.uint32)
        np.greater_equal(x, LIMITS[0], out=w.view(bool))
        for limit in LIMITS[1:4]:
            w += x >= limit
        rare = np.flatnonzero(x >= LIMITS[4])
        w.reshape(-1)[rare] = np.searchsorted(np.array(LIMITS), x.reshape(-1)[rare], side="right")
    return out


def draws(h1: np.ndarray, h2: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """``weights`` as doubles."""
    return weights(h1, h2, n_boot, seed).astype(np.float64)


def replicate_weights(df: DataFrame, key: str, n_boot: int, seed: int) -> DataFrame:
    """A row for each replicate in which the row has weight: ``replicate``, ``w``."""
    rep = df.withColumns(key_hashes(key)).withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(n_boot))))
    rep = rep.withColumn("__x", (F.col("__h1") + F.col("replicate").cast("bigint") * REPLICATE_STEP + seed * SEED_STEP)
                         % PRIME)
    for add in ("__h2", None):
        rep = rep.withColumn("__s", F.col("__x") * F.col("__x") % PRIME) \
            .withColumn("__x", F.col("__s") * F.col("__s") % PRIME * F.col("__x") % PRIME)
        if add:
            rep = rep.withColumn("__x", (F.col("__x") + F.col(add)) % PRIME)
    w = sum((F.col("__x") >= t).cast("int") for t in LIMITS)
    return rep.withColumn("w", w).where("w > 0").drop("__h1", "__h2", "__x", "__s")


def replicate_sums(df: DataFrame, group: list[str], key: str, sums: dict[str, str], n_boot: int, seed: int) -> DataFrame:
    """(group, replicate, sums): the weighted sum of each expression in every
    replicate. A task sums the matrices of its rows, so what is shuffled does not
    depend on the rows. Few groups a task are meant (bins, models)."""
    ship_package(df.sparkSession)
    rows = df.select(*group, *[F.expr(e).cast("double").alias(f"__e_{c}") for c, e in sums.items()], key) \
        .where(F.col(key).isNotNull()).withColumns(key_hashes(key)).drop(key)
    kinds = [rows.schema[g] for g in group]
    n = len(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        step = max(1, CELLS // n_boot)
        for b in batches:
            keys = pa.StructArray.from_arrays(b.columns[:n], names=group).to_pylist()
            codes: dict[tuple, int] = {}
            of = np.array([codes.setdefault(tuple(k.values()), len(codes)) for k in keys], np.int64)
            values = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns[n:-2]])
            h1, h2 = (c.to_numpy(zero_copy_only=False) for c in b.columns[-2:])
            for name, code in codes.items():
                at = np.flatnonzero(of == code)
                mine = total.setdefault(name, np.zeros((len(sums), n_boot)))
                for i in range(0, len(at), step):
                    some = at[i:i + step]
                    mine += values[:, some] @ draws(h1[some], h2[some], n_boot, seed)
        for name, got in total.items():
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([v] * n_boot, f) for v, f in zip(name, arrow, strict=True)],
                 pa.array(np.arange(1, n_boot + 1, dtype=np.int32)), *[pa.array(x) for x in got]],
                names=[*group, "replicate", *sums])
    schema = T.StructType([*kinds, T.StructField("replicate", T.IntegerType()),
                           *[T.StructField(c, T.DoubleType()) for c in sums]])
    arrow = [to_arrow_type(f.dataType) for f in kinds]
    return rows.mapInArrow(run, schema).groupBy(*group, "replicate").agg(*[F.sum(c).alias(c) for c in sums])


#: What a range of scores gives: its totals (kind 0), pieces of ties (1), rows with a target other than 0 (2).
#: ``cubes`` is the sum of n ** 3 - n over ties of n: what the variance of mid-ranks lacks for them.
FIGURES = ("w", "wy", "pos", "neg", "above_w", "above_neg", "d", "pos_in", "cubes")
#: What a range of targets gives: its totals (kind 0) and pieces of ties (1); m is a sum of weight x rank by score.
BY_TARGET = ("w", "wneg", "above_w", "m", "am", "m_in", "m_up", "cubes")
#: A row that is sent on: its key's hashes, and twice its ranks as ``least`` and what each replicate has above it.
SENT = {"h1": pa.int64(), "h2": pa.int64(), "least": pa.float64(), "twice": pa.binary()}


def _schema(figures: tuple[str, ...], sent: dict[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("kind", pa.int32()), ("model", pa.string()), ("pid", pa.int32()), ("replicate", pa.int32()),
                      ("p", pa.float64()), ("y", pa.float64()), *[(f, pa.float64()) for f in figures], *sent.items()])


_SCHEMA, _TARGET_SCHEMA = _schema(FIGURES, SENT), _schema(BY_TARGET, {})
GIVEN, GIVEN_BY_TARGET = (", ".join(f"{f.name} {from_arrow_type(f.type).simpleString()}" for f in s) for s in (_SCHEMA, _TARGET_SCHEMA))


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows; single values are repeated, columns not named are null."""
    def column(field: pa.Field) -> pa.Array:
        v = columns.get(field.name)
        if v is None or isinstance(v, pa.Array):
            return pa.nulls(n, field.type) if v is None else v
        if isinstance(v, str):
            return pa.array([v] * n, field.type)
        return pa.array(np.broadcast_to(v, n).astype(field.type.to_pandas_dtype()))
    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)


def _above(first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Running sums of the rows before each, from ``first`` on."""
    out = np.empty_like(rows)
    for i in range(len(rows)):
        np.add(out[i - 1], rows[i - 1], out=out[i]) if i else np.copyto(out[0], first)
    return out


def _together(w: np.ndarray) -> np.ndarray:
    """The sum of rows of weights (not more rows than cells of a matrix)."""
    return w.sum(axis=0, dtype=np.int32)


class _Sorted:
    """Takes one model's rows of one range in falling order of the first column, a matrix
    at a time, without breaking ties where it can."""
    schema: pa.Schema
    figures: tuple[str, ...]

    def __init__(self, model: str, pid: int, n_boot: int, seed: int):
        self.model, self.pid, self.n_boot, self.seed = model, pid, n_boot, seed
        self.numbers = np.arange(1, n_boot + 1)
        self.sums = {f: np.zeros(n_boot) for f in self.figures}
        self.held: list[np.ndarray] | None = None
        self.started, self.open = False, None

    def add(self, columns: list[np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        """Takes rows, None at the end. The last tie is held back until it has ended."""
        last = columns is None
        if last:
            rows = self.held
        else:
            rows = columns if self.held is None else [np.concatenate(pair) for pair in zip(self.held, columns, strict=True)]
        n = len(rows[0])
        step = max(1, CELLS // self.n_boot)
        at = 0
        while at < n:
            end = min(n, at + step)
            if end < n or not last:
                cut = at + int(np.searchsorted(-rows[0][at:end], -rows[0][end - 1]))  # start of the last tie
                if cut > at:
                    end = cut
                elif end - at < step:
                    break
            whole = last and end == n
            yield from self._take([c[at:end] for c in rows], whole,
                                  end < n and rows[0][end] == rows[0][end - 1] or not last and end == n)
            at = end
        self.held = [c[at:] for c in rows]

    def _ties(self, values: np.ndarray, last: bool, more: bool) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the ties, and which of them may go on in another matrix or range."""
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        piece = np.zeros(len(starts), bool)
        piece[0] = not self.started or self.open == values[0]
        piece[-1] |= last or more
        self.started, self.open = True, values[-1] if more else None
        return starts, piece

    def _take(self, rows: list[np.ndarray], last: bool, more: bool) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def _given(self, kind: int, **columns) -> pa.RecordBatch:
        return _batch(self.schema, self.n_boot, kind=kind, model=self.model, pid=self.pid, replicate=self.numbers, **columns)

    def totals(self) -> pa.RecordBatch:
        return self._given(0, **{f: v for f, v in self.sums.items() if not f.startswith("above_")})


class _Range(_Sorted):
    """Sums over rows (p, y, two hashes) in falling order of the score. Running sums are kept
    at ties that need them: those of several rows, with a target other than 0, or in pieces."""
    schema, figures = _SCHEMA, FIGURES

    def __init__(self, model: str, pid: int, n_boot: int, seed: int, ranks: bool):
        super().__init__(model, pid, n_boot, seed)
        self.ranks = ranks

    def _take(self, rows: list[np.ndarray], last: bool, more: bool) -> Iterator[pa.RecordBatch]:
        p, y, h1, h2 = rows
        w = weights(h1, h2, self.n_boot, self.seed)
        starts, piece = self._ties(p, last, more)
        ends = np.r_[starts[1:], len(p)]
        moved = y != 0
        several = ends - starts > 1
        at = np.flatnonzero(several | piece | np.logical_or.reduceat(moved, starts))
        s, done = self.sums, 0
        run, pos_before = s["w"], s["pos"]
        above_w, own, pos = (np.zeros((len(at), self.n_boot)) for _ in range(3))
        for k, (a, b) in enumerate(zip(starts[at].tolist(), ends[at].tolist(), strict=True)):
            if a > done:
                run = run + _together(w[done:a])
            above_w[k] = run
            own[k] = _together(w[a:b]) if b - a > 1 else w[a]
            up = y[a:b] > 0
            if up.any():
                pos[k] = own[k] if up.all() else _together(w[a:b][up])
            run, done = run + own[k], b
        s["w"] = run + _together(w[done:])
        s["pos"] = s["pos"] + pos.sum(axis=0)
        s["neg"] = s["w"] - s["pos"]
        neg, above_neg = own - pos, above_w - _above(pos_before, pos)
        inner = ~piece[at]
        up = inner & pos.any(axis=1)
        s["d"] += (pos[up] * (above_neg[up] + neg[up] / 2)).sum(axis=0)
        s["pos_in"] += pos[up].sum(axis=0)
        n = own[inner]
        s["cubes"] += ((n * n - 1) * n).sum(axis=0)
        single = np.ones(len(starts), bool)
        single[at] = False
        n = w[starts[single]].astype(np.float32)
        s["cubes"] += ((n * n - 1) * n).sum(axis=0, dtype=np.float64)
        s["wy"] = s["wy"] + y[moved] @ w[moved].astype(np.float64)
        for k in np.flatnonzero(~inner):
            yield self._given(1, p=p[starts[at[k]]], w=own[k], pos=pos[k], neg=neg[k], above_w=above_w[k], above_neg=above_neg[k])
        if self.ranks and moved.any():
            rows_at = np.flatnonzero(moved)
            tie = np.searchsorted(starts, rows_at, side="right") - 1
            loose, of = piece[tie], np.searchsorted(at, tie)
            twice = 2 * above_w[of] + own[of] + 1
            twice[loose] = 0
            least = twice.min(axis=1)
            twice -= least[:, None]
            packed = twice.astype(np.uint16 if twice.max() < 1 << 16 else np.uint32)
            yield _batch(_SCHEMA, len(rows_at), kind=2, model=self.model, pid=self.pid,
                         p=pa.array(np.where(loose, p[rows_at], 0.0), mask=~loose), y=y[rows_at], h1=h1[rows_at], h2=h2[rows_at],
                         least=least, twice=pa.array([x.tobytes() for x in packed], pa.binary()))


class _Targets(_Sorted):
    """Sums over rows (-y, two hashes, rank by score in each replicate as offset, least, twice)
    in rising order of the target."""
    schema, figures = _TARGET_SCHEMA, BY_TARGET

    def __init__(self, model: str, pid: int, n_boot: int, seed: int, offsets: np.ndarray):
        super().__init__(model, pid, n_boot, seed)
        self.offsets = offsets

    def _take(self, rows: list[np.ndarray], last: bool, more: bool) -> Iterator[pa.RecordBatch]:
        y, h1, h2, place, least, twice = rows
        y = -y
        w = draws(h1, h2, self.n_boot, self.seed)
        starts, piece = self._ties(y, last, more)
        wm = w * (self.offsets[place] + (twice + least[:, None]) / 2)
        own, m = (np.add.reduceat(x, starts, axis=0) if len(starts) < len(y) else x for x in (w, wm))
        s, of = self.sums, y[starts]
        above_w = _above(s["w"], own)
        inner = ~piece
        s["am"] += ((above_w + (own + 1) / 2) * m)[inner].sum(axis=0)
        s["m_in"] += m[inner].sum(axis=0)
        s["m_up"] += m[inner & (of > 0)].sum(axis=0)
        s["cubes"] += ((own * own - 1) * own)[inner].sum(axis=0)
        s["w"] = s["w"] + own.sum(axis=0)
        s["wneg"] = s["wneg"] + own[of < 0].sum(axis=0)
        s["m"] = s["m"] + m.sum(axis=0)
        for k in np.flatnonzero(piece):
            yield self._given(1, y=of[k], w=own[k], m=m[k], above_w=above_w[k])


def _summed(make: Callable[[str, int], _Sorted], runs: Callable[[pa.RecordBatch], Iterator[tuple]]) -> Callable:
    """A function for ``mapInArrow`` over rows in runs of one model and range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            for model, pid, columns in runs(b):
                if now is None or (now.model, now.pid) != (model, pid):
                    if now is not None:
                        yield from now.add(None)
                        yield now.totals()
                    now = make(model, pid)
                yield from now.add(columns)
        if now is not None:
            yield from now.add(None)
            yield now.totals()
    return run


def _runs(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(model, pid, [p, y, h1, h2]) of each run of rows of one model and range in (model, pid, p, y, h1, h2) batches."""
    yield from _parts(batch, [batch.column(k).to_numpy(False) for k in range(2, 6)])


def _parts(batch: pa.RecordBatch, values: list[np.ndarray]) -> Iterator[tuple]:
    """(model, range, rows of the values) of each run in a batch whose first two columns are model and range."""
    model = np.array(batch.column(0).to_pylist(), object)
    pid = batch.column(1).to_numpy(False)
    cuts = np.flatnonzero(np.r_[True, (model[1:] != model[:-1]) | (pid[1:] != pid[:-1])]) if len(model) else []
    for a, b in zip(cuts, [*cuts[1:], len(model)], strict=True):
        yield model[a], int(pid[a]), [v[a:b] for v in values]


def _ordered() -> list[Column]:
    return [F.col("model").asc(), F.col("p").desc(), F.col("key").asc()]


def _n_ranges(rows: int, spark) -> int:
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return min(max(1, -(-rows // RANGE)), most)


def bootstrap(scores: DataFrame, n_boot: int, seed: int, fraction: float, ranks: bool = True) -> DataFrame:
    """(model, replicate, auc, spearman, top_capture) of (model, key, y, p) rows.

    Mid-ranks count weights as repetitions; the top takes rows by score (ties by
    key) up to max(floor(fraction x weight), 1), the last one in part. Replicates
    with one class only are left out. Without ``ranks`` spearman is null. Rows
    without model, score or target are left out, and those without key, which have no
    weight; an empty frame gives no rows.
    """
    spark = scores.sparkSession
    ship_package(spark)
    rows = scores.select("model", "key", F.col("p").cast("double").alias("p"), F.col("y").cast("double").alias("y")) \
        .where("model is not null and key is not null and p is not null and y is not null and not isnan(p) and not isnan(y)") \
        .withColumns(key_hashes("key"))
    n_parts = _n_ranges(rows.count(), spark)
    ranged = materialize(range_partition(rows, _ordered(), n_parts).withColumn("pid", F.spark_partition_id())
                         .select("model", "pid", "p", "y", "__h1", "__h2", "key"))
    # A written range may be read in parts: its rows are brought together again (a range is one partition's worth).
    together = ranged.repartition(n_parts, "model", "pid").sortWithinPartitions("model", "pid", F.col("p").desc(), "key") \
        .select("model", "pid", "p", "y", "__h1", "__h2")
    given = materialize(together.mapInArrow(_summed(lambda model, pid: _Range(model, pid, n_boot, seed, ranks), _runs), GIVEN))

    part = ["model", "replicate"]
    upto = Window.partitionBy(*part).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = given.where("kind = 0").withColumns({
        "bw": F.coalesce(F.sum("w").over(upto), F.lit(0.0)), "bn": F.coalesce(F.sum("neg").over(upto), F.lit(0.0))})
    ranges = materialize(ranges.select(*part, "pid", "w", "wy", "pos", "neg", "d", "pos_in", "cubes", "bw", "bn"))
    before = ranges.select(*part, "pid", "bw", "bn")
    ties = materialize(given.where("kind = 1").select(*part, "pid", "p", "w", "pos", "neg", "above_w", "above_neg") \
        .join(before, [*part, "pid"]).groupBy(*part, "p").agg(
            F.sum("w").alias("w"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
            F.min(F.col("bw") + F.col("above_w")).alias("aw"), F.min(F.col("bn") + F.col("above_neg")).alias("an")) \
        .withColumn("mid", F.col("aw") + (F.col("w") + 1) / 2))
    inner = ranges.groupBy(*part).agg(
        F.sum("w").alias("all_w"), F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"), F.sum("wy").alias("all_wy"),
        F.sum(F.expr("d + bn * pos_in")).alias("d1"), F.sum("cubes").alias("q1"))
    outer = ties.groupBy(*part).agg(F.sum(F.expr("pos * (an + neg / 2)")).alias("d2"),
                                    F.sum(F.expr("w * w * w - w")).alias("q2"))
    out = inner.join(outer, part).join(_top(ranged, ranges, inner, n_boot, seed, fraction), part) \
        .withColumn("auc", F.expr("(all_pos * all_neg - d1 - d2) / nullif(all_pos * all_neg, 0)"))
    if not ranks:
        return out.where("all_pos > 0 and all_neg > 0").select(*part, "auc", F.lit(None).cast("double").alias("spearman"),
                                                   "top_capture")
    high = _by_target(given.where("kind = 2"), before, ties, n_boot, seed)
    both = out.join(high, part, "left").na.fill(0.0, ["wn", "wneg", "m", "am", "m_up", "qy"]) \
        .withColumn("zeros", F.expr("all_w - wn")) \
        .withColumn("a0", F.expr("wneg + (zeros + 1) / 2")) \
        .withColumn("square", F.expr("(all_w + 1) * (all_w + 1) / 4")) \
        .withColumn("cov", F.expr("(a0 * (all_w * (all_w + 1) / 2 - m) + am + zeros * m_up) / all_w - square")) \
        .withColumn("cube", F.expr("all_w * all_w * all_w - all_w")) \
        .withColumn("va", F.expr("(cube - qy - (zeros * zeros * zeros - zeros)) / (12 * all_w)")) \
        .withColumn("vb", F.expr("(cube - q1 - q2) / (12 * all_w)"))
    # Scores rank downwards in ``cov``: the sign turns.
    spearman = F.when(F.expr("least(va, vb) > 1e-12 * square"), -F.col("cov") / F.sqrt(F.col("va") * F.col("vb")))
    return both.where("all_pos > 0 and all_neg > 0").select(*part, "auc", spearman.alias("spearman"), "top_capture")


def _by_target(moved: DataFrame, before: DataFrame, ties: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """(model, replicate) sums over the rows with a target other than 0: weight (wn; wneg of
    targets below 0), weight x rank by score (m; m_up of targets above 0), that x rank by
    target among these rows (am), and n ** 3 - n of their ties (qy)."""
    spark, part = moved.sparkSession, ["model", "replicate"]
    # What a range or a tie across ranges adds to ranks: ranges x replicates, bounded by the parameters and not the rows.
    places: dict[tuple, int] = {}
    offsets = []
    for frame, at, value in ((before, "pid", "bw"), (ties, "p", "mid")):
        for key, one in frame.select(*part, at, value).toPandas().groupby(["model", at], sort=False):
            places[at, *key] = len(offsets)
            offsets.append(np.zeros(n_boot))
            offsets[-1][one["replicate"].to_numpy() - 1] = one[value].to_numpy()
    held = spark.sparkContext.broadcast((places, np.array(offsets).reshape(-1, n_boot)))

    def runs(batch: pa.RecordBatch) -> Iterator[tuple]:
        model, pid, p = (batch.column(c).to_pylist() for c in ("model", "pid", "p"))
        place = np.array([held.value[0]["pid", m, i] if v is None else held.value[0]["p", m, v]
                          for m, i, v in zip(model, pid, p, strict=True)], np.int64)
        y, h1, h2, least = (batch.column(c).to_numpy(False) for c in ("y", "h1", "h2", "least"))
        packed = batch.column("twice").to_pylist()
        twice = np.stack([np.frombuffer(v, np.uint16 if len(v) == 2 * n_boot else np.uint32) for v in packed]) if packed else \
            np.zeros((0, n_boot), np.uint16)
        yield from _parts(batch.select(["model", "range"]), [-y, h1, h2, place, least, twice])

    rows = range_partition(moved.select("model", "y", "pid", "p", "h1", "h2", "least", "twice"),
                           [F.col("model").asc(), F.col("y").asc()], _n_ranges(moved.count(), spark)) \
        .withColumn("range", F.spark_partition_id())
    given = materialize(rows.mapInArrow(
        _summed(lambda model, pid: _Targets(model, pid, n_boot, seed, held.value[1]), runs), GIVEN_BY_TARGET))
    upto = Window.partitionBy(*part).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = materialize(given.where("kind = 0").withColumn("bw", F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
                         .select(*part, "pid", "bw", "w", "wneg", "m", "am", "m_in", "m_up", "cubes"))
    inside = ranges.groupBy(*part).agg(
        F.sum("w").alias("wn"), F.sum("wneg").alias("wneg"), F.sum("m").alias("m"),
        F.sum(F.expr("am + bw * m_in")).alias("am1"), F.sum("m_up").alias("up1"), F.sum("cubes").alias("q1"))
    across = given.where("kind = 1").select(*part, "pid", "y", "w", "m", "above_w").join(ranges.select(*part, "pid", "bw"), [*part, "pid"]) \
        .groupBy(*part, "y").agg(F.sum("w").alias("w"), F.sum("m").alias("m"), F.min(F.col("bw") + F.col("above_w")).alias("aw")) \
        .groupBy(*part).agg(F.sum(F.expr("(aw + (w + 1) / 2) * m")).alias("am2"), F.sum(F.expr("if(y > 0, m, 0)")).alias("up2"),
                            F.sum(F.expr("w * w * w - w")).alias("q2"))
    return inside.join(across, part).select(*part, "wn", "wneg", "m", F.expr("am1 + am2").alias("am"),
                                            F.expr("up1 + up2").alias("m_up"), F.expr("q1 + q2").alias("qy"))


def _top(ranged: DataFrame, ranges: DataFrame, totals: DataFrame, n_boot: int, seed: int, fraction: float) -> DataFrame:
    """(model, replicate, top_capture): whole ranges before the cut, and the rows
    of the one range in which a replicate's cut lies."""
    part = ["model", "replicate"]
    goal = totals.select(*part, "all_wy", F.greatest(F.floor(F.col("all_w") * fraction), F.lit(1)).cast("double").alias("k"))
    at = ranges.select(*part, "pid", "w", "wy", "bw").join(goal, part)
    whole = at.groupBy(*part).agg(F.max("all_wy").alias("all_wy"),
                                  F.sum(F.expr("if(bw + w <= k, wy, 0)")).alias("sure"))
    # One range for each model and replicate at most: the parameters bound this table, not the rows.
    needs: dict[tuple[str, int], list[tuple[int, float]]] = {}
    cut = at.where("bw < k and bw + w > k").select(*part, "pid", F.expr("k - bw").alias("need"))
    for r in cut.collect():
        needs.setdefault((r["model"], r["pid"]), []).append((r["replicate"], r["need"]))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, None
        for b in batches:
            for model, pid, (_, y, h1, h2) in _runs(b):
                if now != (model, pid):
                    if now is not None:
                        yield done(now[0])
                    now, done = (model, pid), _Cut(needs[model, pid], n_boot, seed)
                done.add(y, h1, h2)
        if now is not None:
            yield done(now[0])
    held = ranged.sparkSession.createDataFrame(sorted(needs), "model string, pid int")
    rows = ranged.join(F.broadcast(held), ["model", "pid"], "left_semi").repartition("model", "pid") \
        .sortWithinPartitions("model", "pid", F.col("p").desc(), "key") \
        .select("model", "pid", "p", "y", "__h1", "__h2")
    some = rows.mapInArrow(take, "model string, replicate int, part double")
    return whole.join(some, part, "left").select(
        *part, (F.lit(100.0) * (F.col("sure") + F.coalesce("part", F.lit(0.0)))
                / F.greatest("all_wy", F.lit(1e-9))).alias("top_capture"))


class _Cut:
    """What the replicates cut in one range still take there."""

    def __init__(self, needs: list[tuple[int, float]], n_boot: int, seed: int):
        self.replicates = np.array([r for r, _ in needs], np.int64)
        self.left = np.array([need for _, need in needs])
        self.got = np.zeros(len(needs))
        self.n_boot, self.seed = n_boot, seed

    def add(self, y: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> None:
        step = max(1, CELLS // self.n_boot)
        for at in range(0, len(y), step):
            if not (self.left > 0).any():
                return
            s = slice(at, at + step)
            w = weights(h1[s], h2[s], self.n_boot, self.seed)[:, self.replicates - 1]
            total = _together(w)
            whole, moved = total <= self.left, y[s] != 0
            self.got += np.where(whole, y[s][moved] @ w[moved].astype(np.float64), 0.0)
            some = np.flatnonzero(~whole & (self.left > 0))  # those whose cut is here
            if len(some):
                v = w[:, some].astype(np.float64)
                self.got[some] += y[s] @ np.clip(self.left[some] - (np.cumsum(v, axis=0) - v), 0, v)
            self.left = self.left - total

    def __call__(self, model: str) -> pa.RecordBatch:
        n = len(self.replicates)
        return pa.RecordBatch.from_arrays([pa.array([model] * n, pa.string()), pa.array(self.replicates.astype(np.int32)),
                                           pa.array(self.got)], names=["model", "replicate", "part"])
