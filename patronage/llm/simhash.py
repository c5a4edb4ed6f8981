"""SimHash near-duplicate classes by tiled exact comparison.

Fingerprints are compared with numpy exclusive-or and bit counts, tile against
tile. A tile holds fingerprints whose segments have equal bit counts; two tiles
are compared only if their counts differ by no more than the radius in all
(bit counts of segments differ by at most the differing bits), so no link is
lost. More and shorter segments are used as the corpus grows, which keeps tiles
near one size; a larger cell is dealt over several tiles.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of
from patronage.llm.components import components
from patronage.session import materialize

BITS, SEED = 64, 42
#: Fingerprints in a tile, about.
TILE = 4096


def fingerprint(text: str | None, size: int = 3) -> int:
    """Unsigned SimHash of a text's word shingles (ASCII lower-cased)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    if len(words) <= size:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        starts = [0, *ends]
        h = xxhash.xxh64_digest
        digests = b"".join([h(joined[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:], strict=False)])
    n = len(digests) // 8
    votes = np.zeros(BITS, np.int64)
    rows = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for at in range(0, n, 1 << 16):
        votes += np.unpackbits(rows[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, mark: Column | None = None) -> DataFrame:
    """(doc_id, fp) for each row, and mark if one is given; fp is the fingerprint's 64 bits as a long."""
    batches_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, size) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *b.schema.names[2:]])
    more = [] if mark is None else [mark.cast("string").alias("mark")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more) \
        .mapInArrow(run, "doc_id long, fp long" + (", mark string" if more else ""))


def segments_for(n: int, tile: int = TILE) -> int:
    """Segments that bring a cell of n random fingerprints to about one tile."""
    for s in (1, 2, 4, 8):
        cells = (math.sqrt(2 * math.pi * math.e) * math.sqrt(BITS / s) / 2) ** s
        if n / cells <= tile:
            break
    return s


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links that join what lies within the radius between two tiles: every
    close pair is connected through them, and there are fewer than members."""
    n = len(a)
    label = np.arange(n if same else n + len(b))
    right = label if same else label[n:]
    out = []
    step = max(1, (1 << 18) // max(1, len(b)))
    for at in range(0, n, step):
        close = np.bitwise_count(a[at:at + step, None] ^ b[None, :]) <= radius
        rows, cols = np.nonzero(close)
        if not len(rows):
            continue
        cuts = np.searchsorted(rows, np.arange(close.shape[0] + 1))
        for r in np.unique(rows):
            hits = cols[cuts[r]:cuts[r + 1]]
            labels, first = np.unique(right[hits], return_index=True)
            own = label[at + r]
            for l, f in zip(labels.tolist(), first.tolist(), strict=True):
                if l != own:
                    out.append((int(a[at + r]), int(b[hits[f]])))
                    label[label == l] = own
    return out


def links(fps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``fps`` (fp) that
    connect exactly what pairs within the radius connect. A dense cell gives a
    forest, not its pairs."""
    n = fps.count()
    s = segments_for(n, tile)
    width = BITS // s
    base = width + 2 * radius + 1
    mask = (1 << width) - 1
    part = (lambda i: F.col("fp")) if s == 1 else \
        (lambda i: F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask)))
    cell = sum((F.bit_count(part(i)).cast("long") + radius) * base ** i for i in range(s))
    marked = fps.select("fp", cell.alias("cell"))
    cells = marked.groupBy("cell").agg(F.count("*").alias("n")) \
        .select("cell", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    cells = materialize(cells)
    tiles = materialize(
        marked.join(cells, "cell").select("cell", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int").alias("t"), "fp")
        .groupBy("cell", "t").agg(F.collect_list("fp").alias("fps")))
    deltas = [d for d in itertools.product(range(-radius, radius + 1), repeat=s) if sum(map(abs, d)) <= radius] \
        if s <= 4 else list(_ball(s, radius))
    codes = sorted({c for d in deltas if (c := sum(x * base ** i for i, x in enumerate(d))) >= 0})
    pairs = cells.select(F.col("cell").alias("a"), F.col("tiles").alias("ka"),
                         F.explode(F.array([F.lit(c).cast("long") for c in codes])).alias("d")) \
        .withColumn("b", F.col("a") + F.col("d")).drop("d") \
        .join(cells.select(F.col("cell").alias("b"), F.col("tiles").alias("kb")), "b") \
        .withColumn("ta", F.explode(F.expr("sequence(0, ka - 1)"))) \
        .withColumn("tb", F.explode(F.expr("sequence(0, kb - 1)"))) \
        .where("a != b or ta <= tb").select("a", "ta", "b", "tb")
    met = pairs.join(tiles.select(F.col("cell").alias("a"), F.col("t").alias("ta"), F.col("fps").alias("left")),
                     ["a", "ta"]) \
        .join(tiles.select(F.col("cell").alias("b"), F.col("t").alias("tb"), F.col("fps").alias("right")), ["b", "tb"])
    met = met.select((F.expr("a = b and ta = tb")).alias("same"), "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            one, two = batch.column(1), batch.column(2)
            for k, same in enumerate(batch.column(0).to_pylist()):
                out += forest(one[k].values.to_numpy(False).view(np.uint64),
                              two[k].values.to_numpy(False).view(np.uint64), radius, same)
            got = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], names=["a", "b"])
    return met.mapInArrow(run, "a long, b long")


def _ball(s: int, radius: int) -> Iterator[tuple[int, ...]]:
    """Integer points of s dimensions whose absolute values add up to at most radius."""
    if s == 0:
        yield ()
        return
    for x in range(-radius, radius + 1):
        for rest in _ball(s - 1, radius - abs(x)):
            yield (x, *rest)


def rooted(known: DataFrame, radius: int, tile: int) -> DataFrame:
    """The rows (fp, least), one for each fp, with the root of the fingerprint's component."""
    met = materialize(components(links(known.select("fp"), radius, tile)))
    return known.join(met, known["fp"] == met["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = 3, size: int = 3, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each document row.

    Documents are linked if their fingerprints differ in at most ``radius`` bits;
    component_id is the least doc_id reachable. Equal fingerprints meet before
    anything is compared, so copies cost one comparison. Texts without words
    (null, empty, blank) have fingerprint zero and link like any other. A null
    doc_id is kept and never names a component (a component of nulls alone has a
    null id); repeated rows are repeated; an empty table gives no rows; other
    columns are not read.
    """
    rows = materialize(fingerprints(docs, size))
    named = rooted(materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least"))), radius, tile)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 3, size: int = 3, tile: int = TILE) -> DataFrame:
    """The documents without near duplicates: of each component one row stays,
    the one with the least doc_id (null after all others) and, of rows that share
    it, the least digest of all columns. Rows that are equal in all columns are
    one row; a component of null doc_ids alone keeps a row too. Columns may have
    any name. Only rows that stand more than once are moved."""
    marked = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.md5(F.to_json(F.struct("*"))).alias("mark"))
    rows = materialize(fingerprints(marked, size, F.col("mark")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("mark").alias("mark")))
    named = rooted(materialize(rows.groupBy("fp").agg(first.alias("least"))), radius, tile)
    least = named.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.mark").alias("mark"))
    marks = materialize(least.join(rows.groupBy("mark").agg((F.count("*") > 1).alias("copies")), "mark"))
    kept = marked.select("row", "mark").join(marks, "mark")
    return kept.where("not copies").select("row.*") \
        .union(kept.where("copies").dropDuplicates(["mark"]).select("row.*"))
