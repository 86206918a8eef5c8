"""Quality rules with adaptive thresholds (built-in column functions only).

Every text is reduced to a few integer measures. Per language and source a
quantile sketch of each measure is kept: a histogram over log-linear buckets
(exact up to 63, then 32 buckets per power of two, so a quantile is off by at
most 1/32 of its value). Sketches merge by adding bucket counts, so they are one
grouped sum with map-side combine: a source with a third of all rows reaches the
shuffle as a few hundred buckets per task. The fences replace fixed cutoffs:
a text fails when a measure lies beyond ``quartile + REACH * spread`` of its own
language and source, where the spread is the distance of the quartiles, at least
the measure's ``least``.

Nulls: a null text has no words; null languages and sources are groups of their
own. Empty texts fail the base rule. Repeated rows are judged one by one. An empty
table gives an empty result. Of extra columns only those asked for are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let, stored, words_of

NOT_SPACE = r"[^\x20\x09-\x0D]"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
REACH = 6
#: Measure -> (least spread, lower fence too).
RULES = {"symbols": (20, False), "capitals": (20, False), "dup_lines": (50, False), "word_length": (60, True)}


def windows_of(words: Column) -> Column:
    """Hashes of all windows of five words, in text order.

    64-bit hashes of 64-bit word hashes: within one text of a million words the
    chance of two unlike windows with one hash is below one in ten million.
    """

    def hashed(h: Column) -> Column:
        return F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))),
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def covered(windows: Column) -> Column:
    """Words under the windows that occur twice or more."""
    tagged = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def repeats(sorted_windows: Column) -> Column:
        return F.transform(
            sorted_windows,
            lambda x, j: F.when(
                (F.get(sorted_windows, j - 1)["w"] == x["w"]) | (F.get(sorted_windows, j + 1)["w"] == x["w"]), x["i"]
            ),
        )

    return F.aggregate(
        F.sort_array(F.array_compact(let(tagged, repeats))),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts and the verdict of the base rule."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.regexp_like(x, F.lit(NOT_SPACE)))
    out = (
        docs.withColumn("__words", words_of(F.col(text)))
        .withColumn("__windows", windows_of(F.col("__words")))
        .withColumn("__lines", lines)
        .withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace(body, "[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("__capitals", F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")).cast("long"))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn(
            "n_repeat_words",
            F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), covered(F.col("__windows"))).otherwise(
                F.lit(0).cast("long")
            ),
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    ratio = lambda top, of, scale: F.expr(f"{top} * {scale} div greatest({of}, 1)")
    return (
        out.withColumn("base_failed", failed)
        .withColumn("m_symbols", ratio("n_symbols", "n_words", 1000))
        .withColumn("m_capitals", ratio("__capitals", "word_chars", 1000))
        .withColumn("m_dup_lines", ratio("n_dup_lines", "n_lines", 1000))
        .withColumn("m_word_length", ratio("word_chars", "n_words", 100))
        .drop("__words", "__windows", "__lines", "__capitals", "n_lines")
    )


def bucket(value: Column) -> Column:
    """Log-linear bucket of a whole number from 0: exact to 63, then 32 per power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    step = F.call_function("shiftright", value, shift)
    return (shift * 64 + step).cast("int")


def bucket_floor(code: Column) -> Column:
    """Smallest value of a bucket."""
    return F.call_function("shiftleft", F.pmod(code, F.lit(64)).cast("long"), F.floor(code / 64).cast("int"))


def sketches(measured: DataFrame) -> DataFrame:
    """One row per language, source, rule and bucket: the mergeable sketch."""
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"m_{r}").alias("value")) for r in RULES))
    return (
        measured.select("__lang", "__source", F.explode(rules).alias("x"))
        .select("__lang", "__source", F.col("x.rule").alias("rule"), bucket(F.col("x.value")).alias("bucket"))
        .groupBy("__lang", "__source", "rule", "bucket")
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame) -> DataFrame:
    """Quartiles and fences per language and source, from merged sketches.

    A group's buckets number at most a few hundred a rule, whatever its rows.
    """
    pairs = F.sort_array(F.collect_list(F.struct("bucket", "n")))

    def quantile(per_cent: int) -> Column:
        reached = F.aggregate(
            "pairs",
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).alias("at")),
            lambda a, x: F.struct(
                (a["seen"] + x["n"]).alias("seen"),
                F.when((a["at"] < 0) & (100 * (a["seen"] + x["n"]) >= per_cent * F.col("total")), x["bucket"])
                .otherwise(a["at"])
                .alias("at"),
            ),
            lambda a: a["at"],
        )
        return bucket_floor(reached)

    least = F.create_map(*(F.lit(v) for r, (s, _) in RULES.items() for v in (r, s)))
    grouped = sketch.groupBy("__lang", "__source", "rule").agg(pairs.alias("pairs"), F.sum("n").alias("total"))
    quartiles = grouped.withColumn("q1", quantile(25)).withColumn("q3", quantile(75))
    spread = F.greatest(F.col("q3") - F.col("q1"), least[F.col("rule")])
    return (
        quartiles.withColumn("low", F.col("q1") - REACH * spread)
        .withColumn("high", F.col("q3") + REACH * spread)
        .groupBy("__lang", "__source")
        .agg(
            *(
                F.max(F.when(F.col("rule") == r, F.col(side))).alias(f"{side}_{r}")
                for r, (_, both) in RULES.items()
                for side in (("low", "high") if both else ("high",))
            )
        )
    )


def _measured(docs: DataFrame, columns: list[str], text: str, lang: str, source: str) -> DataFrame:
    renamed = docs.withColumns({"__lang": F.col(lang), "__source": F.col(source)})
    kept = list(dict.fromkeys([*columns, "__lang", "__source"]))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return measure(renamed, text).select(*kept, *counts, *[f"m_{r}" for r in RULES])


def _judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Measured rows with fences and ``kept``.

    The fences are stored (a row per language and source), so every row is judged by
    the same thresholds even when a task runs again. Their join is left to Spark's own
    size estimate: broadcast while small, else a shuffle.
    """
    limits = stored(limits, "fences").withColumnsRenamed({"__lang": "__l", "__source": "__s"})
    joined = measured.join(
        limits, F.col("__lang").eqNullSafe(F.col("__l")) & F.col("__source").eqNullSafe(F.col("__s")), "left"
    )
    odd = F.lit(False)
    for rule, (_, both) in RULES.items():
        value = F.col(f"m_{rule}")
        odd = odd | (value > F.col(f"high_{rule}"))
        if both:
            odd = odd | (value < F.col(f"low_{rule}"))
    return joined.withColumn("kept", ~F.col("base_failed") & ~odd).drop("__lang", "__source", "__l", "__s")


def judge(docs: DataFrame, columns: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``columns`` of ``docs`` with base counts, ``base_failed``, measures, fences and ``kept``.

    The texts are read once: the measures are written to the shared folder with
    the columns asked for; sketches and verdicts read them back by column.
    """
    measured = stored(_measured(docs, columns, text, lang, source), "measures")
    return _judged(measured, fences(sketches(measured)))


def verdicts(docs: DataFrame) -> DataFrame:
    """Base counts and verdict of every document."""
    return judge(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns, whatever their names.

    The texts are read twice, for the fences and for the verdicts, so that no second
    copy of them is written.
    """
    apart = docs.select(F.struct("*").alias("__row"), "text", "lang", "source")
    measured = _measured(apart, ["__row"], "text", "lang", "source")
    return _judged(measured, fences(sketches(measured))).where("kept").select("__row.*")
