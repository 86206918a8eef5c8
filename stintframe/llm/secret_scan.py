"""Secret scan with sliding-window entropy (built-in column functions only).

Three kinds are found by their form: ``assign`` (a key word, a separator and a
value of at least 8 characters), ``access`` (key ids) and ``hex`` (long runs of
hex digits). The entropy scan adds a fourth kind, ``entropy``: candidate strings
are runs of token characters; over each, a window slides whose counts per
character are kept by adding the character that enters and taking off the one
that leaves, and with them the sum of ``c * log2(c)``. The Shannon entropy of the
window is compared with the threshold of the candidate's character class.

Matches have no positions in Spark SQL, so they are taken from the lengths of the
pieces between matches. Positions are code points, the end is exclusive.

Allow list: candidates without a digit or without a letter, words joined by one
sign each that end in at most eight digits, UUIDs, and candidates that hold a known
dummy value are no findings of the entropy scan; neither are those inside a base
span. Addresses and paths have no rule of their own.

A null text counts as empty. Texts without findings return zero counts and empty
strings. Repeated rows are scanned one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let

# The forms of the three kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_VALUE = 8
KINDS = ["assign", "access", "hex", "entropy"]

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WIDTH = 20
#: Least entropy of a window, in thousandths of a bit, by character class.
LEAST = {"hex": 3000, "alnum": 3700, "base64": 3900}
# Substrings of known dummy keys.
DUMMIES = ["example", "EXAMPLE", "xxxx", "XXXX", "0000000", "1234567890", "abcdefghij", "ABCDEFGHIJ"]
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"

SPAN = "array<struct<start:int,end:int,found:string>>"


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches with positions and the text of one group."""
    parts = F.struct(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gaps"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("lengths"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )

    def fold(p: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            start = a["at"] + F.get(p["gaps"], i)
            end = start + F.get(p["lengths"], i)
            span = F.struct(start.alias("start"), end.alias("end"), F.get(p["values"], i).alias("found"))
            return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
        return F.aggregate(F.sequence(F.lit(0), F.size(p["lengths"]) - 1), zero, step, lambda a: a["spans"])

    return F.when(F.regexp_like(text, F.lit(pattern)), let(parts, fold)).otherwise(F.array().cast(SPAN))


def window_weights() -> list[int]:
    """Thousandths of ``c * log2(c)`` for counts 0 to WIDTH; whole numbers, so sums are exact."""
    return [round(1000 * c * math.log2(c)) if c else 0 for c in range(WIDTH + 1)]


def peak_entropy(candidate: Column) -> Column:
    """Highest window entropy of a candidate, in thousandths of a bit.

    With counts ``c`` in a window of ``WIDTH``, the entropy is ``log2(WIDTH) -
    sum(c log2 c) / WIDTH``: the least sum gives the peak.
    """
    weights = F.array(*map(F.lit, window_weights()))
    codes = F.transform(
        F.split(candidate, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)) - 1
    )

    def fold(p: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            into = F.get(p["codes"], i)
            out = F.when(i >= WIDTH, F.get(p["codes"], i - WIDTH)).otherwise(F.lit(-1))
            leaving = F.when(out >= 0, F.get(a["counts"], out)).otherwise(F.lit(1))
            entering = F.get(a["counts"], into) - F.when(out == into, 1).otherwise(0)
            total = (
                a["sum"]
                + F.get(p["weights"], leaving - 1)
                - F.get(p["weights"], leaving)
                + F.get(p["weights"], entering + 1)
                - F.get(p["weights"], entering)
            )
            counts = F.transform(
                a["counts"],
                lambda c, k: c + F.when(k == into, 1).otherwise(0) - F.when(k == out, 1).otherwise(0),
            )
            least = F.when(i >= WIDTH - 1, F.least(a["least"], total)).otherwise(a["least"])
            return F.struct(counts.alias("counts"), total.alias("sum"), least.alias("least"))

        zero = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).alias("sum"), F.lit(10**9).alias("least")
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(p["codes"]) - 1), zero, step, lambda a: a["least"])

    least = let(F.struct(codes.alias("codes"), weights.alias("weights")), fold)
    return F.lit(round(1000 * math.log2(WIDTH))) - F.floor(least / WIDTH)


def suspicious(found: Column) -> Column:
    """Candidate passes the allow list and the entropy threshold of its class."""
    allowed = (
        ~F.regexp_like(found, F.lit("[0-9]"))
        | ~F.regexp_like(found, F.lit("[A-Za-z]"))
        | F.regexp_like(found, F.lit(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"))
        | F.regexp_like(found, F.lit(r"^[A-Za-z]+([-_/=+][A-Za-z]+)*[-_/=+]?[0-9]{1,8}$"))
        | F.regexp_like(found, F.lit("|".join(DUMMIES)))
    )
    least = (
        F.when(F.regexp_like(found, F.lit("^[0-9a-f]+$")), LEAST["hex"])
        .when(F.regexp_like(found, F.lit("^[0-9A-Za-z]+$")), LEAST["alnum"])
        .otherwise(LEAST["base64"])
    )
    return F.when(allowed, False).otherwise(peak_entropy(found) >= least)


def _named(spans: Column, kind: int) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    )


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``: lists of (start, kind, end), by start and then kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(located(body, ASSIGN, 2), lambda s: F.length(s["found"]) >= MIN_VALUE)
    base = F.sort_array(
        F.concat(_named(assign, 0), _named(located(body, ACCESS), 1), _named(located(body, HEX), 2))
    )
    candidates = F.filter(located(body, CANDIDATE), lambda s: suspicious(s["found"]))
    outside = let(
        F.struct(F.col("base").alias("b"), candidates.alias("c")),
        lambda p: F.filter(
            p["c"], lambda s: ~F.exists(p["b"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        ),
    )
    return docs.withColumn("base", base).withColumn(
        "spans", F.sort_array(F.concat("base", _named(outside, 3)))
    )


def digests(docs: DataFrame) -> DataFrame:
    """Counts per kind, hash of the base spans, all spans as text."""
    found = scan(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans get one mark.

    ``text`` and, if there is one, ``n_chars`` are made anew; all other columns stay,
    whatever their names.
    """

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        gap = F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(a["out"], gap, F.lit(mark))).otherwise(a["out"]).alias("out"),
        )

    cleaned = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))),
    )
    found = scan(docs.select(F.struct("*").alias("__row"), "text"))
    found = found.withColumn("text", F.when(F.size("spans") > 0, cleaned).otherwise(F.col("text")))
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    row = F.col("__row")
    return found.select(*(made.get(c, row.getField(c)).alias(c) for c in docs.columns))
