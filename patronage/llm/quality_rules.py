"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every text gets its counts; ratios of the texts that pass the two fixed base
rules feed quantile sketches, one per language, source and measure. A sketch is
a histogram over logarithmic buckets (relative accuracy 2 %): sketches merge by
adding counts, so the same rows serve a source, its language and the corpus,
and the result does not depend on how rows are dealt. A measure's fence lies
``SPREAD`` interquartile ranges beyond the upper (for word length also the
lower) quartile, and at least its ``MARGIN`` away from it; a text beyond a fence
of its own language and source is rejected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import SPACE, WORD
from patronage.session import materialize

#: Base rules.
LEAST_WORDS, MOST_REPEATS = 50, 50
#: Sketches: first bucket's end, logarithm of the bucket ratio (1.02 / 0.98).
FLOOR, STEP = 0.001, 0.040005334613699
#: Texts that a source's sketch needs; below, its language's is used, and then the corpus's.
ENOUGH = 200
SPREAD = 3.0
MARGIN = {"symbols": 0.1, "dup_lines": 0.4, "repeats": 0.3, "word_length": 1.0}
MEASURES = {
    "symbols": "n_symbols / n_words", "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words", "word_length": "word_chars / n_words",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(docs: DataFrame, size: int = 3) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words (long) and base_failed; columns of these names are replaced.

    Repeated windows are found by their 64-bit hashes, sorted within the row
    only where some repeat; the words they cover are then counted from the gaps
    between their positions. No row leaves its place.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = F.size("__words")
    windows = F.when(n >= size, F.transform(
        F.sequence(F.lit(0), n - size),
        lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(size)]))).otherwise(
        F.array().cast("array<bigint>"))
    marked = F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    def twin(x: Column, k: Column) -> Column:
        return F.coalesce(F.get("__z", k - 1)["h"] == x["h"], F.lit(False)) | \
            F.coalesce(F.get("__z", k + 1)["h"] == x["h"], F.lit(False))
    at = F.sort_array(F.transform(F.filter("__z", twin), lambda x: x["i"]))
    covered = F.aggregate("__at", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-size).alias("end")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(size), p + size - a["end"])).alias("n"),
                                                (p + size).alias("end")), lambda a: a["n"])
    drop = ("__words", "__lines", "__h", "__z", "__at")
    out = docs.withColumns({
        "__words": F.filter(F.split(text, f"{SPACE}+"), lambda w: w != ""),
        "__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
        "word_chars": F.char_length(F.regexp_replace(text, f"{SPACE}+", "")).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint")})
    out = out.withColumns({"__h": windows, "n_words": n.cast("bigint"), "n_lines": F.size("__lines").cast("bigint"),
                           "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint")})
    out = out.withColumn("__z", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(marked)))
    out = out.withColumn("__at", at).withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))
    return out.drop(*drop).withColumn(
        "base_failed", F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATS} * n_words"))


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the sketch of each language, source
    and measure over the texts that pass the base rules."""
    rows = counted.where("not base_failed").select(
        "lang", "source", F.expr("stack({}, {}) as (measure, x)".format(
            len(MEASURES), ", ".join(f"'{m}', cast({e} as double)" for m, e in MEASURES.items()))))
    bucket = F.when(F.col("x") < FLOOR, 0).otherwise(1 + F.floor(F.log(F.col("x") / FLOOR) / STEP)).cast("int")
    return rows.groupBy("lang", "source", "measure", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of ``keys``: n texts, and low and high of each
    measure, from the merged sketches."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "measure")
    run = merged.withColumns({"upto": F.sum("n").over(w.orderBy("bucket")), "all": F.sum("n").over(w)})
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(FLOOR * F.exp((F.col("bucket") - 0.5) * STEP))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(q * F.col("all")), value))
    cut = run.groupBy(*keys, "measure").agg(F.max("all").alias("n"), quantile(0.25).alias("q1"),
                                            quantile(0.75).alias("q3"))
    away = reduce(lambda e, m: e.when(F.col("measure") == m, MARGIN[m]), MARGIN, F.when(F.lit(False), 0.0))
    reach = F.greatest(SPREAD * (F.col("q3") - F.col("q1")), away)
    cut = cut.select(*keys, "measure", "n", (F.col("q3") + reach).alias("high"), (F.col("q1") - reach).alias("low"))
    return cut.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("measure") == m, F.col("high"))).alias(f"high_{m}") for m in MEASURES],
        F.max(F.when(F.col("measure") == "word_length", F.col("low"))).alias("low_word_length"))


LIMITS = [f"high_{m}" for m in MEASURES] + ["low_word_length"]


def thresholds(sketch: DataFrame) -> DataFrame:
    """__lang, __source and limits, from the first of source, language and corpus with enough texts."""
    def named(df: DataFrame, tag: str, *keys: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"__{k}{tag}") for k in keys], F.struct("n", *LIMITS).alias(f"__{tag}"))
    own = named(fences(sketch, ["lang", "source"]), "own", "lang", "source")
    tongue = named(fences(sketch, ["lang"]), "tongue", "lang")
    every = fences(sketch.withColumn("all_texts", F.lit("all")), ["all_texts"]) \
        .select(F.struct("n", *LIMITS).alias("__every"), F.lit("all").alias("__k"))
    out = own.join(tongue, F.col("__langown").eqNullSafe(F.col("__langtongue")), "left") \
        .withColumn("__k", F.lit("all")).join(F.broadcast(every), "__k", "left")  # one row
    best = F.when(F.col("__own.n") >= ENOUGH, F.col("__own")).when(F.col("__tongue.n") >= ENOUGH, F.col("__tongue")) \
        .otherwise(F.col("__every"))
    return out.select(F.col("__langown").alias("__lang"), F.col("__sourceown").alias("__source"),
                      best.alias("__limits"))


def judge(docs: DataFrame) -> DataFrame:
    """The rows with their counts, base_failed and kept.

    Null texts count as empty and fail the base rules; a null lang or source is
    a value of its own; where no text of a language and source passes the base
    rules there is nothing to judge by and none is kept; repeated rows are judged
    alike; an empty table gives no rows. Other columns are passed through.
    """
    return judge_counted(counts(docs))


def judge_counted(counted: DataFrame) -> DataFrame:
    """The same for rows that have their counts. They are written once: the
    sketches and the verdicts both read them."""
    counted = materialize(counted)
    limits = materialize(thresholds(sketches(counted)))
    joined = counted.join(limits, F.col("lang").eqNullSafe(F.col("__lang"))
                          & F.col("source").eqNullSafe(F.col("__source")), "left")
    inside = " and ".join([f"{e} <= __limits.high_{m}" for m, e in MEASURES.items()]
                          + [f"{MEASURES['word_length']} >= __limits.low_word_length"])
    kept = F.expr(f"case when base_failed then false else coalesce({inside}, true) end")
    return joined.withColumn("kept", kept).drop("__lang", "__source", "__limits")


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"),
                         F.col("source").cast("string").alias("source"))
    out = counts(narrow).drop("text")
    return judge_counted(out).select("doc_id", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with the columns they came with (whatever their names)."""
    rows = docs.select(F.struct("*").alias("__row"), "text", F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"))
    return judge_counted(counts(rows).drop("text")).where("kept").select("__row.*")
