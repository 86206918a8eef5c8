"""Exact dedup by two-pass Bloom filtering (built-in column functions only).

Texts are equal when they are identical after every space, tab and line end is
deleted; that is decided by the SHA-256 of what is left. Every text is read once:
its digest, length and id form a narrow table in the shared folder. Over that
table two passes run:

1. every digest sets two cells of a counting Bloom filter, kept as a relation
   (cell, count) with map-side combine; cells set twice or more are packed into
   words of 64 bits;
2. every digest whose two cells are both set twice is possibly repeated. Only
   such rows shuffle and are compared by digest; the rest pass straight through.

A repeated digest sets its cells at least twice, so none is missed; of the others
about 1.4 % meet two foreign cells and shuffle for nothing. The filter holds
``CELLS_A_ROW`` cells a row and is cut by ranges of a hash of the digest into
filters for about ``rows_per_filter`` rows, met one after another. The digests
are sorted by that hash inside each file, so a round reads only its range. One
filter has at most ``rows_per_filter / 4`` words of 16 bytes (134 MB at the
default), which bounds what is broadcast at every table size.

A copy group may hold any share of the rows: cells and groups are combined before
they shuffle, and the join of the groups with their rows can be split by Spark.

Of equal texts the row with the most code points stays, then the one with the
smallest id (null ids last). Rows alike in both are told apart by a hash of the
text and by a stored row number, so exactly one row of a group stays. Null texts
count as empty texts, and all texts without any other character are equal. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import SPACES, stored

CELLS_A_ROW = 16
ROWS_PER_FILTER = 1 << 25
WORD_BITS = 6


def normalised_sha256(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without spaces, tabs and line ends."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, ""), 256)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, raw, sha, place, row): one narrow row a document, stored, sorted by ``place`` in each file."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.length(body).cast("long").alias("n_chars"),
        F.xxhash64(body).alias("raw"),
        normalised_sha256(F.col(text)).alias("sha"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(narrow.withColumn("place", F.xxhash64("sha")).sortWithinPartitions("place"), "digests")


def _cell(number: int, cells: int) -> Column:
    return F.pmod(F.xxhash64("sha", F.lit(number)), F.lit(cells))


def _word(cell: Column) -> Column:
    return F.shiftright(cell, WORD_BITS)


def _bit(cell: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int"))


def repeated_cells(rows: DataFrame, cells: int) -> DataFrame:
    """(word, bits): the cells that were set twice or more, 64 to a word; words without any are left out."""
    counts = rows.select(F.explode(F.array(_cell(1, cells), _cell(2, cells))).alias("cell")).groupBy("cell").count()
    return (
        counts.where("count > 1")
        .groupBy(_word(F.col("cell")).alias("word"))
        .agg(F.bit_or(_bit(F.col("cell"))).alias("bits"))
    )


def with_possible(rows: DataFrame, repeated: DataFrame, cells: int) -> DataFrame:
    """Add ``possible``: both cells of the digest were set twice or more."""
    for k in (1, 2):
        words = repeated.select(F.col("word").alias(f"__word{k}"), F.col("bits").alias(f"__bits{k}"))
        rows = rows.withColumn(f"__word{k}", _word(_cell(k, cells))).join(F.broadcast(words), f"__word{k}", "left")
    hits = [F.coalesce(F.col(f"__bits{k}"), F.lit(0)).bitwiseAND(_bit(_cell(k, cells))) != 0 for k in (1, 2)]
    return rows.withColumn("possible", hits[0] & hits[1]).drop("__word1", "__word2", "__bits1", "__bits2")


def compared(rows: DataFrame) -> DataFrame:
    """Verdicts of possibly repeated rows, by digest."""
    order = F.struct(
        (-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"), "raw", "row"
    )
    groups = rows.groupBy("sha").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    return rows.join(groups, "sha").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _verdicts_of(rows: DataFrame, expected: int) -> DataFrame:
    """Verdicts of the rows of one filter."""
    cells = max(1 << WORD_BITS, CELLS_A_ROW * expected)
    marked = with_possible(rows, repeated_cells(rows, cells), cells)
    single = marked.where("not possible").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return single.unionByName(compared(marked.where("possible")))


def verdicts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_filter: int = ROWS_PER_FILTER
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    narrow = digests(docs, doc_id, text)
    total = narrow.count()
    rounds = max(1, -(-total // rows_per_filter))
    width = 2**64 // rounds
    parts = []
    for k in range(rounds):
        low = -(2**63) + k * width
        rows = narrow if rounds == 1 else narrow.where(F.col("place") >= low)
        rows = rows if k == rounds - 1 else rows.where(F.col("place") < low + width)
        parts.append(stored(_verdicts_of(rows, min(total, rows_per_filter)), "exact"))
    return reduce(DataFrame.unionByName, parts)


def without_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_filter: int = ROWS_PER_FILTER
) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows of groups of one are not touched; the list of repeated rows (id and
    digest) decides about the others. Repeats under one id come down to the row
    with the most code points.
    """
    names = docs.columns
    repeats = (
        verdicts(docs, doc_id, text, rows_per_filter)
        .where("group_size > 1")
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
        .agg(F.max("kept").alias("__stays"), F.count("*").alias("__times"))
    )
    known = docs.select("*", normalised_sha256(F.col(text)).alias("__own")).join(
        repeats, (F.col("__own") == F.col("__sha")) & F.col(doc_id).eqNullSafe(F.col("__id")), "left"
    )
    once = known.where("__times is null or (__stays and __times = 1)").select(names)
    order = F.struct(F.length(F.coalesce(F.col(text), F.lit(""))), -F.xxhash64(text).cast("decimal(20,0)"))
    again = (
        known.where("__stays and __times > 1")
        .groupBy("__sha", "__id")
        .agg(F.max_by(F.struct(*names), order).alias("__row"))
        .select("__row.*")
    )
    return once.unionByName(again)
