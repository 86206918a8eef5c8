"""Piece encoding and decoding on a relational lattice.

The text gets a word mark before it and for every space, and is cut before each
mark: no piece but runs of marks, which never win, reaches over one, so words are
encoded apart and every distinct word once. Substrings of a word, as long as the
longest piece, are joined with the piece table; the edges of a word are grouped
by end, and a higher-order ``aggregate`` folds them to the best path (Viterbi) by
the sum of the pieces' scores. Characters without a piece become byte pieces.

Ties go to the path whose last piece is longer. Words of over ``LONG`` characters
are folded in the same way inside a task, since the fold in SQL copies its state.

A null text counts as empty; the empty text has no pieces. Repeated rows are
encoded one by one; an empty table gives no rows. Decoding gives the text back
except that the word mark U+2581 in a text comes back as a space.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import stored

MARK = "▁"
LONG = 400
#: Score of a character without a piece: below any path of pieces.
UNKNOWN = -1e6


def piece_table(spark: SparkSession, model: str) -> DataFrame:
    """(id, piece, score, byte): the vocabulary file as a table; control pieces aside.

    ``byte`` is the value of a byte piece, else null. A vocabulary has a bounded size.
    """
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = [
        (i, p.id_to_piece(i), float(p.get_score(i)), int(p.id_to_piece(i)[3:5], 16) if p.is_byte(i) else None)
        for i in range(p.get_piece_size())
        if not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i))
    ]
    return spark.createDataFrame(rows, "id int, piece string, score double, byte int")


def words_of(text: Column) -> Column:
    """Words with their mark, in text order; the text begins with a mark of its own."""
    marked = F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(MARK)))
    cut = F.regexp_extract_all(marked, F.lit(f"(?s){MARK}[^{MARK}]*"), F.lit(0))
    return F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))


def lattice(words: DataFrame, table: DataFrame) -> DataFrame:
    """(word, end, start, score, ids): edges of the words' lattices; positions count from 0."""
    plain = table.where("byte is null")
    longest = plain.agg(F.coalesce(F.max(F.length("piece")), F.lit(1)).alias("n")).first()["n"]
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
    parts = starts.select(
        "word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("start")))).alias("size")
    ).select("word", "start", (F.col("start") + F.col("size")).alias("end"), F.substring("word", F.col("start") + 1, F.col("size")).alias("piece"))
    known = parts.join(plain.select("piece", "id", "score"), "piece").select(
        "word", "start", "end", "score", F.array("id").alias("ids")
    )
    # Characters as bytes: one table of 256 byte pieces, as a literal list in byte order.
    byte_ids = [r["id"] for r in table.where("byte is not null").orderBy("byte").collect()]
    character = F.hex(F.encode(F.substring("word", F.col("start") + 1, F.lit(1)), "utf-8"))
    ids = F.transform(
        F.sequence(F.lit(0), (F.length(character) / 2 - 1).cast("int")),
        lambda k: F.get(
            F.array(*map(F.lit, byte_ids)), F.conv(F.substring(character, 2 * k + 1, F.lit(2)), 16, 10).cast("int")
        ),
    )
    unknown = starts.select("word", "start", (F.col("start") + 1).alias("end"), F.lit(UNKNOWN).alias("score"), ids.alias("ids"))
    return known.unionByName(unknown)


def best_path(ends: list[list[dict]]) -> list[int]:
    """The fold for one long word: edges grouped by end, as in :func:`encoded_words`."""
    state = [(0.0, 0, None)]
    for edges in ends:
        score, back, e = max(((state[e["start"]][0] + e["score"], e["start"], e) for e in edges), key=lambda x: (x[0], -x[1]))
        state.append((score, back, e))
    out, at = [], len(state) - 1
    while at:
        out.append(state[at][2]["ids"])
        at = state[at][1]
    return [i for ids in reversed(out) for i in ids]


def encoded_words(words: DataFrame, table: DataFrame) -> DataFrame:
    """(word, ids) of distinct words."""
    edges = lattice(words, table)
    by_end = edges.groupBy("word", "end").agg(F.collect_list(F.struct("start", "score", "ids")).alias("edges"))
    grouped = by_end.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("end", "edges"))).alias("ends"))

    def step(state: Column, at: Column) -> Column:
        options = F.transform(
            at["edges"],
            lambda e: F.struct(
                (F.get(state, e["start"])["score"] + e["score"]).alias("score"),
                (-e["start"]).alias("back"),
                F.concat(F.get(state, e["start"])["ids"], e["ids"]).alias("ids"),
            ),
        )
        return F.concat(state, F.array(F.array_max(options)))

    zero = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"), F.array().cast("array<int>").alias("ids")))
    short = grouped.where(F.length("word") <= LONG).select(
        "word", F.aggregate("ends", zero, step, lambda s: F.element_at(s, -1)["ids"]).alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [best_path([x["edges"] for x in ends]) for ends in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.list_(pa.int32()))], ["word", "ids"])

    return short.unionByName(grouped.where(F.length("word") > LONG).mapInArrow(run, "word string, ids array<int>"))


def encode(rows: DataFrame, model: str, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ids of every row of ``rows``."""
    table = piece_table(rows.sparkSession, model)
    numbered = rows.select(
        F.monotonically_increasing_id().alias("row"), *keys, F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    numbered = stored(numbered, "texts")
    places = numbered.select("row", F.posexplode(words_of(F.col("text"))).alias("pos", "word"))
    known = stored(encoded_words(places.select("word").distinct(), table), "words")
    found = (
        places.join(known, "word")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("parts"))
        .select("row", F.flatten("parts.ids").alias("ids"))
    )
    joined = numbered.join(found, "row", "left")
    return joined.select(*keys, "text", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))


def decode(encoded: DataFrame, model: str, keys: list[str]) -> DataFrame:
    """``encoded`` with ``decoded``: the text of its ids."""
    table = piece_table(encoded.sparkSession, model)
    bytes_of = F.when(F.col("byte").isNull(), F.hex(F.encode("piece", "utf-8"))).otherwise(F.lpad(F.hex("byte"), 2, "0"))
    # The vocabulary has a bounded size: its bytes, in id order, are one literal list.
    spelled = {r["id"]: r["x"] for r in table.select("id", bytes_of.alias("x")).collect()}
    listed = encoded.sparkSession.createDataFrame([([spelled.get(i, "") for i in range(max(spelled) + 1)],)], "spelled array<string>")
    raw = F.array_join(F.transform("ids", lambda i: F.get(F.col("spelled"), i)), "")
    marked = F.decode(F.unhex(raw), "utf-8")
    text = F.substring(F.replace(marked, F.lit(MARK), F.lit(" ")), 2, 2**31 - 1)
    return encoded.join(F.broadcast(listed), F.lit(True), "left").withColumn("decoded", text).drop("spelled")
