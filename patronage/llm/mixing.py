"""Mixing sources to target weights by temperature, in DataFrame functions.

Source token shares are raised to an exponent and normalised. The exponent is
the largest (nearest to the natural mix) whose weights reach a target entropy,
or, if that would repeat a source too often, the least that keeps the
repetition limit; both are found by bisecting its interval, four halvings (a
section of 16) in each round, which is one aggregate over the sources. The weights are realised as block permutations:
a source's budget is met by whole passes (blocks), each in an order of its own,
and a cut in the order of the last pass: the documents up to the one that
reaches the budget, so a source falls short of no budget and runs over by less
than a document. The cut is found in two levels, sums of key ranges and then the
keys of one range, so a hot source is never one task's sort; choosing the rows
then takes no shuffle of texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import WORD
from patronage.session import materialize

#: Share of the highest entropy to reach; passes over a source at most; budget as a share of all tokens.
ENTROPY, REPEATS, BUDGET, SEED = 0.98, 4.0, 1.0, 42
#: Points of a sectioning round, rounds, and decimals kept of the exponent.
POINTS, ROUNDS, DECIMALS = 17, 7, 6
#: Rows of a source that one key range should hold, about.
RANGE_ROWS = 50_000
KEY_BITS = 60


def digest(text: Column) -> Column:
    """Tells texts of one doc_id (or of none) apart."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def key(epoch: Column, seed: int = SEED) -> Column:
    """Place of a document (doc_id, digest) in the order of a pass (60 bits of a digest)."""
    said = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest")
    return F.conv(F.substring(F.md5(said), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def exponent(sources: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float = BUDGET) -> float:
    """The exponent for (source, t) rows with t > 0; 1 if there is at most one."""
    total = sources.agg(F.sum("t").alias("t"), F.count("*").alias("n")).first()
    if (total["n"] or 0) < 2:
        return 1.0
    p = F.col("t") / F.lit(float(total["t"]))
    goal = entropy * math.log(total["n"])

    def measured(points: list[float]) -> list:
        at = sources.select(p.alias("p"), F.explode(F.array([F.lit(x) for x in points])).alias("a"))
        w = F.pow("p", F.col("a"))
        rows = at.groupBy("a").agg(F.sum(w).alias("z"), F.sum(w * F.col("a") * F.log("p")).alias("e"),
                                   F.max(w / F.col("p")).alias("most")).collect()  # one row for each point
        return sorted((r["a"], math.log(r["z"]) - r["e"] / r["z"], budget * r["most"] / r["z"]) for r in rows)

    def least(good) -> float:
        """The least point of [0, 1] from which ``good`` holds (0 or 1 at the ends)."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            rows = measured([low + (high - low) * k / (POINTS - 1) for k in range(POINTS)])
            if good(rows[0]):
                return low
            right = next((k for k, r in enumerate(rows) if good(r)), None)
            if right is None:
                return high
            low, high = rows[right - 1][0], rows[right][0]
        return high
    # Entropy falls and repetition falls as the exponent grows.
    flat = least(lambda r: r[1] < goal)
    fair = least(lambda r: r[2] <= repeats)
    return round(max(flat, fair), DECIMALS)


def plan(rows: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float = BUDGET,
         seed: int = SEED) -> DataFrame:
    """(source, weight, tokens, budget, passes, cut) from (doc_id, digest, source, t)
    rows: a document of the source takes part in ``passes`` passes, and in one
    more if its key there is at most ``cut``."""
    sources = materialize(rows.groupBy("source").agg(F.sum("t").alias("t"), F.count("*").alias("n")).where("t > 0"))
    sums = sources.agg(F.sum("t").alias("t"), F.max("n").alias("n")).first()
    whole, most = sums["t"] or 0, sums["n"] or 0
    alpha = exponent(sources, entropy, repeats, budget)
    w = F.pow(F.col("t") / F.lit(float(max(whole, 1))), F.lit(alpha))
    z = sources.agg(F.sum(w).alias("z")).first()["z"] or 1.0
    share = w / F.lit(z)
    asked = F.least(F.floor(share * F.lit(float(math.floor(budget * whole)))), F.floor(F.col("t") * repeats))
    wanted = sources.select("source", share.alias("weight"), F.col("t").alias("tokens"), asked.cast("bigint").alias("budget"))
    wanted = materialize(wanted.withColumn("passes", F.expr("budget div tokens"))
                         .withColumn("left", F.expr("budget - passes * tokens")))
    bits = min(24, max(6, math.ceil(math.log2(max(1, most / RANGE_ROWS)))))
    shift = KEY_BITS - bits

    def same(a: DataFrame, b: DataFrame) -> Column:
        return a["source"].eqNullSafe(b["src"])
    passes = wanted.select(F.col("source").alias("src"), "passes", "left")
    keyed = rows.where("t > 0").join(passes, same(rows, passes)) \
        .select("source", "left", key(F.col("passes"), seed).alias("key"), "t") \
        .withColumn("range", F.shiftright("key", shift))
    ranges = keyed.groupBy("source", "range", "left").agg(F.sum("t").alias("t"))
    upto = F.sum("t").over(Window.partitionBy("source").orderBy("range"))
    ranges = ranges.withColumn("before", upto - F.col("t")).where("before < left and before + t >= left") \
        .select(F.col("source").alias("src"), F.col("range").alias("r"), "before")
    ranges = materialize(ranges)
    inside = keyed.join(ranges, keyed["source"].eqNullSafe(ranges["src"]) & (keyed["range"] == ranges["r"])) \
        .groupBy("source", "before", "left", "key").agg(F.sum("t").alias("t"))
    earlier = F.col("before") + F.sum("t").over(Window.partitionBy("source").orderBy("key")) - F.col("t")
    cuts = inside.withColumn("earlier", earlier).where("earlier < left").groupBy(F.col("source").alias("src")) \
        .agg(F.max("key").alias("cut"))
    return materialize(wanted.join(cuts, F.col("source").eqNullSafe(F.col("src")), "left").select(
        "source", "weight", "tokens", "budget", "passes", F.coalesce("cut", F.lit(-1)).alias("cut")))


def drawn(rows: DataFrame, chosen: DataFrame, seed: int = SEED) -> DataFrame:
    """The (doc_id, digest, source, ...) rows once for each pass that they take
    part in, with epoch and place. Rows without tokens are in no pass."""
    p = chosen.select(F.col("source").alias("src"), "passes", "cut")
    out = rows.join(p, rows["source"].eqNullSafe(p["src"])) \
        .withColumn("n", F.col("passes") + (key(F.col("passes"), seed) <= F.col("cut")).cast("int")) \
        .where("n > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, n - 1)")))
    return out.withColumn("place", key(F.col("epoch"), seed))


def narrow(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, source, t) of each row."""
    return materialize(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("digest"),
        F.col("source").cast("string").alias("source"), tokens(F.col("text")).alias("t")))


def mixture(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float = BUDGET,
            seed: int = SEED) -> DataFrame:
    """One row for each document and pass: doc_id, source, n_tokens, epoch,
    place (order within the source's pass).

    Texts without words (null, empty) have no tokens and are in no pass; a null
    source is a source; rows that share doc_id and text share a place and are
    taken or left together; an empty table gives no rows; other columns are not read.
    """
    rows = narrow(docs)
    out = drawn(rows.where("t > 0"), plan(rows, entropy, repeats, budget, seed), seed)
    return out.select("doc_id", "source", F.col("t").alias("n_tokens"), "epoch", "place")


def mixed(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float = BUDGET,
          seed: int = SEED) -> DataFrame:
    """The mixture as rows of ``docs``: its columns, whatever their names, a row for each pass."""
    chosen = plan(narrow(docs), entropy, repeats, budget, seed)
    rows = docs.where(F.col("text").rlike(WORD)).select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("digest"),
        F.col("source").cast("string").alias("source"))
    return drawn(rows, chosen, seed).select("row.*")
