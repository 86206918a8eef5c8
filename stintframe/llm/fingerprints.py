"""Bottom-k document fingerprints (built-in column functions only).

A fingerprint is the sorted list of the ``SIZE`` smallest distinct hashes of a
text's shingles (five words, as they stand). Two sketches merge by union, sort
and cut, so parts of a text or a corpus can be sketched apart. From sketches
alone come the resemblance (Jaccard likeness), the containment and the number of
distinct shingles.

A text of fewer than five words has its whole word sequence as one shingle; null
texts count as empty; an empty text has an empty fingerprint. Two empty
fingerprints are alike (1.0), an empty one is unlike any other (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import let, words_of

SHINGLE = 5
SIZE = 128
#: Hashes are spread over this many values (xxhash64, signed).
SPACE = 2.0**64
BLOCK = 256  # ids by their upper bits
SPAN_BITS = 19


def shingle_hashes(text: Column) -> Column:
    """Hashes of the shingles, in text order, repeats included."""

    def windows(h: Column) -> Column:
        return F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (SHINGLE - 1), F.lit(1))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, SHINGLE))),
        )

    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), windows)


def sketch(text: Column, size: int = SIZE) -> Column:
    """The ``size`` smallest distinct shingle hashes; empty for a text without words."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text))), 1, size)


def merge(a: Column, b: Column, size: int = SIZE) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Share of the merged sketch that both sides hold."""
    both = merge(a, b, size)
    common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.greatest(F.size(both), F.lit(1)))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    place = (F.element_at(a, -1).cast("double") + SPACE / 2 + 1) / SPACE
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / place)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds too."""
    likeness, na, nb = resemblance(a, b, size), distinct_shingles(a, size), distinct_shingles(b, size)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), likeness / (1 + likeness) * (na + nb) / na))


def as_text(a: Column) -> Column:
    return F.concat_ws(",", F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))))


def _next_heads(level: DataFrame, depth: int) -> DataFrame:
    """(key, next): for each key the head of the next key that exists, null for the last."""
    if depth == 0:
        return level.select("key", F.lead("head").over(Window.orderBy("key")).alias("next"))
    wide = level.withColumn("span", F.shiftright("key", SPAN_BITS))
    heads = wide.groupBy("span").agg(F.min("head").alias("head")).withColumnRenamed("span", "key")
    above = _next_heads(heads, depth - 1).select(F.col("key").alias("span"), F.col("next").alias("far"))
    near = F.lead("head").over(Window.partitionBy("span").orderBy("key"))
    return wide.withColumn("near", near).join(above, "span").select("key", F.coalesce("near", "far").alias("next"))


def following(blocks: DataFrame) -> DataFrame:
    """(block, next): the next block number that has rows; after the last comes the first.

    A plain lead over all blocks would be one task. Numbers are compared inside
    spans of 2**19, then the first ones of the spans inside wider spans; the last
    level has at most 2**18 numbers whatever the size of the table.
    """
    level = blocks.select(F.col("block").alias("key"), F.col("block").alias("head"))
    first = blocks.agg(F.min("block").alias("first"))
    out = _next_heads(level, 2).join(F.broadcast(first), F.lit(True), "left")  # one row
    return out.select(F.col("key").alias("block"), F.coalesce("next", "first").alias("next"))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch) by ascending id; the last is followed by the first.

    Ids are whole numbers, so a block of ``BLOCK`` consecutive numbers holds as
    many rows at most. Texts are shuffled once, by block; the next row is found
    inside the block, and the last row of a block meets the first of the next one
    in a join of one row a block. Rows of one id are ordered by their text.
    """
    numbered = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.shiftright(F.col(doc_id).cast("long"), 8), F.lit(-(2**55) - 1)).alias("block"),
    )
    order = Window.partitionBy("block").orderBy("doc_id", "text")
    ranged = (
        numbered.repartition("block")
        .sortWithinPartitions("block", "doc_id", "text")
        .withColumn("sketch", sketch(F.col("text")))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_sketch", F.lead("sketch").over(order))
        .withColumn("place", F.row_number().over(order))
    )
    columns = ["doc_id", "text", "sketch", "next_text", "next_sketch"]
    inner = ranged.where("next_text is not null").select(columns)
    heads = ranged.where("place = 1").select(
        F.col("block").alias("next"), F.col("text").alias("next_text"), F.col("sketch").alias("next_sketch")
    )
    steps = following(numbered.select("block").distinct())
    tails = ranged.where("next_text is null").drop("next_text", "next_sketch", "place").join(steps, "block")
    return inner.unionByName(tails.join(heads, "next").select(columns))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last half of its characters replaced by as many from
    the start of the next document.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.length("text") - half)
    edited = F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half))
    out = with_next(docs).withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited")))
    return out.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_inside"),
        distinct_shingles(F.col("sketch")).alias("n_shingles_estimate"),
    )
