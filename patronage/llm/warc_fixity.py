"""Merkle fixity audit of WARC replicas, in DataFrame functions.

Records are hashed where they lie; above them stand hashes of ordered offset
ranges, each of some ranges of the level below, then whole files, then groups of
files, up to one root. The trees of two replicas are grown side by side and
compared from the root down; only the children of ranges that differ are looked
at, and at the bottom the records of a differing range are matched by offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.session import materialize

#: Bits of a lowest range's bytes, of the ranges in a range above, and of the files in a group.
RANGE_BITS, FAN_BITS, GROUP_BITS = 13, 4, 8
#: Levels of ranges, and of groups of files.
RANGES, GROUPS = 3, 3
#: Page ids that share a WARC file.
PER_FILE = 256


def record(uri: Column, payload: Column) -> Column:
    """A WARC resource record as text."""
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def archive(pages: DataFrame) -> DataFrame:
    """Pages as records of WARC files: file, page_id, uri, content.

    A file holds the pages of ``PER_FILE`` consecutive ids in order of id, uri
    and content. Null urls and payloads count as empty; pages without an id lie
    in file -1; repeated rows are records of their own.
    """
    rows = pages.select(
        F.coalesce(F.floor(F.col("page_id") / PER_FILE), F.lit(-1)).cast("bigint").alias("file"),
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.select("file", "page_id", "uri", record(F.col("uri"), F.col("html")).alias("content"))


def hashed(records: DataFrame, content: Column | None = None) -> DataFrame:
    """file, page_id, uri, length, sha256 of each record, without its content."""
    c = F.col("content") if content is None else content
    return records.select("file", "page_id", "uri", F.octet_length(c).cast("bigint").alias("length"),
                          F.sha2(c, 256).alias("sha256"))


def laid_out(records: DataFrame) -> DataFrame:
    """The hashed records with their offsets: the sum of the lengths before."""
    w = Window.partitionBy("file").orderBy("page_id", "uri", "sha256").rowsBetween(Window.unboundedPreceding, 0)
    return records.withColumn("offset", F.sum("length").over(w) - F.col("length"))


def _node(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One hash for each side and key, over the ordered hashes below (a bounded number)."""
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "sha256"))),
                                    lambda x: F.concat_ws(":", x[order].cast("string"), x["sha256"])), "\n")
    return rows.groupBy("side", *keys).agg(F.sha2(said, 256).alias("sha256"))


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of (side, file, at, sha256) from records (side, file, offset,
    sha256) up: offset ranges, each file's whole, groups of files, and one root.

    The lowest level and the files' are written; each level between and above
    is a small part of the one below it, and grown from it where it is read."""
    low = records.select("side", "file", "offset", F.shiftright("offset", RANGE_BITS).alias("at"), "sha256")
    levels = [materialize(_node(low, ["file", "at"], "offset"))]
    for _ in range(RANGES - 1):
        up = levels[-1].withColumnRenamed("at", "below").withColumn("at", F.shiftright("below", FAN_BITS))
        levels.append(_node(up, ["file", "at"], "below"))
    # Above the levels of ranges a file has few left: they are joined whole.
    levels.append(materialize(_node(levels[-1], ["file"], "at")))
    for _ in range(GROUPS):
        up = levels[-1].select("side", F.col("file").alias("below"), F.shiftright("file", GROUP_BITS).alias("file"), "sha256")
        levels.append(_node(up, ["file"], "below"))
    return levels


def differing(level: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hashes differ between the sides, or that one side lacks."""
    sides = [F.max(F.when(F.col("side") == k, F.col("sha256"))) for k in (0, 1)]
    return level.groupBy(*keys).agg(sides[0].alias("a"), sides[1].alias("b")).where("not a <=> b").select(*keys)


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """file, offset, uri, length, sha256, found_sha256, status of every record
    that differs between replica ``a`` and its copy ``b`` (both file, offset,
    uri, length, sha256): changed, missing from the copy, or extra in it.

    Equal or empty replicas give no rows. Rows that repeat an offset are
    compared by their hashes together. Rows without file or offset are left out.
    """
    cols = ["file", "offset", "uri", "length", "sha256"]
    both = a.select(F.lit(0).alias("side"), *cols).unionByName(b.select(F.lit(1).alias("side"), *cols))
    both = materialize(both.where("file is not null and offset is not null").groupBy("side", "file", "offset").agg(
        F.min("uri").alias("uri"), F.min("length").alias("length"),
        F.array_join(F.sort_array(F.collect_list("sha256")), "+").alias("sha256")))
    levels = tree(both)
    bad = differing(levels[-1], ["file"])
    for level in reversed(levels[RANGES:-1]):  # groups and files of a differing group
        near = bad.select(F.col("file").alias("__up"))
        bad = differing(level.join(near, F.shiftright("file", GROUP_BITS) == F.col("__up"), "left_semi"), ["file"])
    bad = differing(levels[RANGES - 1].join(bad, "file", "left_semi"), ["file", "at"])
    for level in reversed(levels[:RANGES - 1]):  # ranges of a differing range
        near = bad.select(F.col("file").alias("__f"), F.col("at").alias("__a"))
        bad = differing(level.join(near, (F.col("file") == F.col("__f"))
                                   & (F.shiftright("at", FAN_BITS) == F.col("__a")), "left_semi"), ["file", "at"])
    near = bad.select(F.col("file").alias("__f"), F.col("at").alias("__a"))
    suspect = both.join(near, (F.col("file") == F.col("__f"))
                        & (F.shiftright("offset", RANGE_BITS) == F.col("__a")), "left_semi")

    def of(side: int, c: str):
        return F.max(F.when(F.col("side") == side, F.col(c)))
    met = suspect.groupBy("file", "offset").agg(
        F.coalesce(of(0, "uri"), of(1, "uri")).alias("uri"), F.coalesce(of(0, "length"), of(1, "length")).alias("length"),
        of(0, "sha256").alias("sha256"), of(1, "sha256").alias("found_sha256"))
    status = F.when(F.col("found_sha256").isNull(), "missing").when(F.col("sha256").isNull(), "extra").otherwise("changed")
    return met.where("not sha256 <=> found_sha256").withColumn("status", status)


def damaged_copy(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replicas of an archive for a drill: the original, and a copy in which page
    ids 13 modulo 97 have their first byte overwritten and ids 7 modulo 89 are
    unreadable. Contents are hashed where they are read and not moved."""
    hit = F.coalesce(F.col("page_id") % 97 == 13, F.lit(False))
    both = records.select("file", "page_id", "uri", F.octet_length("content").cast("bigint").alias("length"),
                          F.sha2("content", 256).alias("sha256"),
                          F.when(hit, F.sha2(F.concat(F.lit("#"), F.expr("substring(content, 2)")), 256)).alias("other"))
    both = materialize(laid_out(both))
    copy = both.where("page_id is null or page_id % 89 != 7") \
        .withColumn("sha256", F.coalesce("other", "sha256"))
    return both.drop("other", "page_id"), copy.drop("other", "page_id")
