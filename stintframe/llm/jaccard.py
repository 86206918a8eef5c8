"""Similarity join on sets of word shingles: links of Jaccard 0.85 or more.

1. Documents with the same set are one class; classes are what is joined.
2. Prefix filter: sets are put in one global order, tokens of very common
   passages last. Two linked sets share a token among their first ``n -
   ceil(0.85 n) + 1``. Which tokens are common only steers the order, never the
   result; they are found by counts per block of documents, summed over all.
3. Tiles: the classes that share a prefix token. Tiles with the same members are
   one tile. Inside a tile, members are sorted by size and compared within the
   size band that 0.85 allows, by hashed bitmaps: bits of one set missing in the
   other bound their overlap from above. Surviving pairs go to an exact
   intersection of the sorted hash arrays.
4. Members of a tile are first held against leaders, in a few rounds; classes that
   are connected already need no comparison, since only the component counts. At
   the end all pairs of unlike components in a tile are compared. Large tiles are
   cut into cells by size band and hash, so that no task holds more than a cell.

A null or empty text has an empty set and is linked with nothing. A text with
fewer than four words has its whole word sequence as the one shingle. Repeated
rows are copies. Sets are compared as 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path
from .columns import stored
from .components import components
from .hashing import mix, shingles, words

WORDS = 4
PERCENT = 85
#: Bitmaps have at least one bit per shingle, a power of two, this many at least.
LEAST_BITS = 512
#: Rows of a tile that are compared in one piece, and pairs that a task holds at a time.
CELL_ROWS, PAIR_ROWS = 1 << 15, 1 << 17
#: Rounds against leaders before all pairs of unlike components are compared.
ROUNDS = 3
#: A token is common when one of so many documents holds it, and at least MANY.
ONE_OF, MANY = 1000, 16
#: Texts whose sets are made at a time.
BLOCK_ROWS = 1000
#: Bits of the filter that tells which sets are needed again.
FILTER_BITS = 1 << 20


def sets_of(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    found = words(texts)
    for i in range(len(texts)):
        yield np.unique(shingles(found.of(i), k))


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def set_id(tokens: np.ndarray) -> int:
    """One hash of a whole set, as a signed number."""
    with np.errstate(over="ignore"):
        total = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def bitmap(tokens: np.ndarray) -> bytes:
    width = max(LEAST_BITS, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else LEAST_BITS
    marks = np.zeros(width, np.uint8)
    marks[(tokens >> np.uint64(20)).astype(np.int64) & (width - 1)] = 1
    return np.packbits(marks).tobytes()


def folded(rows: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (a row of words each) as those of a smaller width: halves laid over each other."""
    while rows.shape[-1] > words:
        half = rows.shape[-1] // 2
        rows = rows[..., :half] | rows[..., half:]
    return rows


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def common_tokens(docs: DataFrame, k: int, rows: int) -> np.ndarray:
    """Tokens that about one of ``ONE_OF`` documents holds; at most ``2 * ONE_OF`` times a document's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(sets_of(batch.column(0), k))
            tokens, counts = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
            often = counts >= max(2, len(sets) // (2 * ONE_OF))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["token", "n"]
            )

    counted = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    common = counted.where(F.col("n") >= max(MANY, rows // ONE_OF)).select("token")
    return np.sort(np.array(common.toArrow().column(0).to_numpy(), np.int64).view(np.uint64))


def prefixes(docs: DataFrame, k: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc_id, n, sid, prefix, bits, text) of every document; an empty set has n 0 and no prefix.

    The text is kept rather than the set, which is larger; sets are made again for
    the few classes that are compared exactly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            sizes, ids, heads, lengths, bits = [], [], [], [0], []
            for tokens in sets_of(batch.column(1), k):
                n = len(tokens)
                head = tokens[:0]
                if n:
                    late = np.isin(tokens, common, assume_unique=True) if len(common) else np.zeros(n, bool)
                    head = np.concatenate([tokens[~late], tokens[late]])[: prefix_length(n, percent)]
                sizes.append(n)
                ids.append(set_id(tokens))
                heads.append(head)
                lengths.append(lengths[-1] + len(head))
                bits.append(bitmap(tokens))
            flat = np.concatenate(heads).view(np.int64) if heads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat)),
                    pa.array(bits, pa.binary()),
                    batch.column(1),
                ],
                ["doc_id", "n", "sid", "prefix", "bits", "text"],
            )

    schema = "doc_id long, n long, sid long, prefix array<long>, bits binary, text string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _gather(batches: Iterator[pa.RecordBatch], *columns: str) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in columns]
    for batch in batches:
        for part, name in zip(parts, columns):
            part.append(batch.column(name).to_numpy(zero_copy_only=False))
    return [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]


def _runs(keys: np.ndarray) -> np.ndarray:
    """Bounds of equal keys in a sorted array."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]


def _pairs_once(key: np.ndarray, sid: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by (key, sid), each pair once."""
    order = np.lexsort((sid, key))
    key, sid, n = key[order], sid[order], n[order]
    if len(key):
        fresh = np.r_[True, (np.diff(key) != 0) | (np.diff(sid) != 0)]
        key, sid, n = key[fresh], sid[fresh], n[fresh]
    return key, sid, n


def tiles(sets: DataFrame) -> DataFrame:
    """(tile, sid, n): classes sharing a prefix token; equal member lists of a task are one tile."""
    rows = sets.select(F.explode("prefix").alias("token"), "sid", "n").repartition("token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, sid, n = _pairs_once(*_gather(batches, "token", "sid", "n"))
        bounds = _runs(token)
        lengths = np.diff(bounds)
        shared = np.repeat(lengths > 1, lengths)
        sid, n, lengths = sid[shared], n[shared], lengths[lengths > 1]
        heads = np.cumsum(lengths) - lengths
        if not len(heads):
            return
        tile = mix(np.add.reduceat(mix(sid.view(np.uint64)), heads) + lengths.astype(np.uint64)).view(np.int64)
        _, first = np.unique(tile, return_index=True)
        once = np.zeros(len(tile), bool)
        once[first] = True
        keep = np.repeat(once, lengths)
        tile = np.repeat(tile, lengths)[keep]
        sid, n = sid[keep], n[keep]
        for at in range(0, len(tile), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(tile[part]), pa.array(sid[part]), pa.array(n[part])], ["tile", "sid", "n"])

    return rows.mapInArrow(run, "tile long, sid long, n long").dropDuplicates(["tile", "sid"])


def near_sizes(a: str, b: str, percent: int):
    return (100 * F.least(F.col(a), F.col(b))) >= (percent * F.greatest(F.col(a), F.col(b)))


def leader_pairs(tiled: DataFrame, percent: int, turn: int) -> DataFrame:
    """Per class the leader of unlike root that it shares the most tiles with; tiled: (tile, sid, n, root).

    Leaders are drawn anew each turn, by a hash.
    """
    order = F.struct(F.xxhash64("sid", F.lit(turn)), "sid", "n", "root")
    leaders = tiled.groupBy("tile").agg(F.min(order).alias("leader"))
    return (
        tiled.join(leaders, "tile")
        .select("sid", "n", "root", F.col("leader.sid").alias("with"), F.col("leader.n").alias("m"), F.col("leader.root").alias("r"))
        .where((F.col("root") != F.col("r")) & near_sizes("n", "m", percent))
        .groupBy("sid", "with")
        .agg(F.count("*").alias("shared"))
        .groupBy("sid")
        .agg(F.max(F.struct("shared", "with")).alias("best"))
        .select(F.least("sid", "best.with").alias("a"), F.greatest("sid", "best.with").alias("b"))
        .distinct()
    )


def arrays_of(sets: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """(sid, tokens) of the classes in ``needed``; sets: (sid, text), a class once or more.

    Which sets are needed is told by a bitmap of fixed size over hashed ids, built
    in Spark; a set with a bit of its own by chance is dropped by the join after.
    """
    place = F.pmod(F.xxhash64("sid"), F.lit(FILTER_BITS))
    parts = (
        needed.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        .collect()
    )
    marked = sets.sparkSession.sparkContext.broadcast({r["bucket"]: bytes(r["bits"]) for r in parts})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = marked.value
        for batch in batches:
            seen, keep = set(), []
            for sid, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # bucket numbers of Spark count from 1 for positive numbers, 0 stands for 0
                bucket, bit = ((at - 1) // 32768 + 1, (at - 1) % 32768) if at > 0 else (0, 0)
                code = bitmap.get(bucket)
                keep.append(code is not None and bool(code[bit >> 3] >> (bit & 7) & 1) and sid not in seen)
                seen.add(sid)
            for part in blocks([batch.select(["sid", "text"]).filter(pa.array(keep, pa.bool_()))]):
                whole = [tokens.tobytes() for tokens in sets_of(part.column(1), k)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole, pa.binary())], ["sid", "tokens"])

    found = sets.select("sid", place.alias("place"), "text").mapInArrow(run, "sid long, tokens binary")
    return found.join(needed, "sid", "left_semi").dropDuplicates(["sid"])


def linked(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact likeness reaches ``percent``."""
    left = arrays.select(F.col("sid").alias("a"), F.col("tokens").alias("x"))
    right = arrays.select(F.col("sid").alias("b"), F.col("tokens").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def most_common(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of sets of sizes n and m with bitmaps x and y (a row of words each)."""
    words = min(x.shape[-1], y.shape[-1])
    x, y = folded(x, words), folded(y, words)
    missing = np.bitwise_count(x & ~y).sum(-1).astype(np.int64)
    extra = np.bitwise_count(y & ~x).sum(-1).astype(np.int64)
    return np.minimum(n - missing, m - extra)


def possible(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the bitmaps allow; marks: (sid, n, bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            x, y = ([np.frombuffer(v, np.uint64) for v in batch.column(c).to_pylist()] for c in ("x", "y"))
            most = np.array([int(most_common(*v)) for v in zip(n, m, x, y)], np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(100 * most >= percent * (n + m - most), pa.bool_()))

    left = marks.select(F.col("sid").alias("a"), "n", F.col("bits").alias("x"))
    right = marks.select(F.col("sid").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def verified(sets: DataFrame, pairs: DataFrame, percent: int, k: int) -> DataFrame:
    """The links among stored candidate pairs; arrays are made for their members only."""
    members = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    return stored(linked(pairs, arrays_of(sets, members, k), percent), "links")


def celled(tiled: DataFrame, percent: int, rows: int = CELL_ROWS) -> DataFrame:
    """``tiled`` with ``cell`` and ``side``, a row once for each cell it belongs to.

    A tile of up to ``rows`` rows is one cell, side 0: all its pairs. A larger one
    is cut by size into bands, so wide that sizes that may link lie in one band or
    in neighbours, and a band by a hash into parts. A cell then holds a part of a
    band as side 1 and a part of the same or the next band as side 2; pairs are
    formed between sides. Every pair of near sizes meets in a cell.
    """
    width = max(math.log(100 / percent), 1e-9) * 1.0001
    placed = tiled.withColumn("band", F.floor(F.log("n") / F.lit(width)))
    large = (
        placed.groupBy("tile", "band")
        .agg(F.count("*").alias("m"))
        .groupBy("tile")
        .agg(F.sum("m").alias("all"), F.ceil(F.max("m") / rows).cast("long").alias("parts"))
        .where(F.col("all") > rows)
        .select("tile", "parts")
    )
    placed = placed.join(large, "tile", "left").withColumn("part", F.pmod(F.xxhash64("sid", F.lit(7)), F.col("parts")))

    def role(band: Column, i: Column, j: Column, side: int) -> Column:
        return F.struct(F.xxhash64("tile", band, i, j).alias("cell"), F.lit(side).alias("side"))

    every = F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)
    roles = F.when(F.col("parts").isNull(), F.array(F.struct(F.col("tile").alias("cell"), F.lit(0).alias("side")))).otherwise(
        F.concat(
            F.transform(every, lambda k: role(F.col("band"), F.col("part"), k, 1)),
            F.transform(every, lambda k: role(F.col("band"), k, F.col("part"), 2)),
            F.transform(every, lambda k: role(F.col("band") - 1, k, F.col("part"), 2)),
        )
    )
    return placed.withColumn("role", F.explode(roles)).select("role.cell", "role.side", "sid", "n", "root")


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of complete cells from batches in order of ``cell``; one open cell is held at a time."""
    held, open_cell = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy()
        last = int(_runs(cell)[-2])
        if held and not last and cell[0] == open_cell:
            held.append(batch)
            continue
        ended = pa.Table.from_batches([*held, batch.slice(0, last)])
        if ended.num_rows:
            yield ended
        held, open_cell = [batch.slice(last)], cell[-1]
    if held:
        yield pa.Table.from_batches(held)


def pairs_of_cells(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that sizes and bitmaps allow; rows of a cell ascend by (n, sid)."""
    cell, side, sid, n, root = (table.column(c).to_numpy() for c in ("cell", "side", "sid", "n", "root"))
    bits = table.column("bits").to_pylist()
    width = np.array([len(x) // 8 for x in bits], np.int64)
    bounds = _runs(cell)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        # Sorted by size, so rows of one bitmap width are neighbours.
        edges = lo + _runs(width[lo:hi])
        parts = [(s, np.frombuffer(b"".join(bits[s:e]), np.uint64).reshape(e - s, -1)) for s, e in zip(edges[:-1], edges[1:])]
        # The band of row i ends where sizes exceed n / 0.85.
        ends = np.searchsorted(n[lo:hi], n[lo:hi] * 100 // percent, side="right") + lo
        for begin, rows_of_width in parts:
            for i in range(begin, begin + len(rows_of_width)):
                if side[i] == 2:
                    continue
                for first, others in parts:
                    j = np.arange(max(i + 1, first), min(ends[i - lo], first + len(others)))
                    j = j[(root[j] != root[i]) & (side[j] != 1)]
                    if not len(j):
                        continue
                    most = most_common(n[i], n[j], rows_of_width[i - begin], others[j - first])
                    j = j[100 * most >= percent * (n[i] + n[j] - most)]
                    if len(j):
                        yield np.minimum(sid[i], sid[j]), np.maximum(sid[i], sid[j])


def banded_pairs(tiled: DataFrame, marks: DataFrame, percent: int, rows: int = CELL_ROWS) -> DataFrame:
    """Pairs of unlike roots in a tile that sizes and bitmaps allow; tiled: (tile, sid, n, root), marks: (sid, bits).

    Bitmaps come to the rows last, and travel once. A task holds one cell and one
    batch of pairs at a time.
    """

    def packed(found: list[tuple]) -> pa.RecordBatch:
        pairs = np.unique(np.stack([np.concatenate(c) for c in zip(*found)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0].copy()), pa.array(pairs[1].copy())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for table in whole_cells(batches):
            for a, b in pairs_of_cells(table, percent):
                found.append((a, b))
                size += len(a)
                if size >= PAIR_ROWS:
                    yield packed(found)
                    found, size = [], 0
        if found:
            yield packed(found)

    marked = celled(tiled, percent, rows).join(marks.select("sid", "bits"), "sid")
    ordered = marked.repartition("cell").sortWithinPartitions("cell", "n", "sid", "side")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def link_components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id); the smallest doc_id reachable by links."""
    rows = docs.select("doc_id", "text")
    common = common_tokens(rows, k, rows.select("doc_id").count())
    # The sets hold the texts: they are removed as soon as the classes are stored.
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "sets")
    made = prefixes(rows, k, percent, common)
    made.write.parquet(path)
    sets = spark.read.schema(made.schema).parquet(path)
    filled = sets.where("n > 0")
    tiled = stored(tiles(filled), "tiles")
    marks = filled.groupBy("sid").agg(F.any_value("n").alias("n"), F.any_value("bits").alias("bits"))
    roots = filled.select(F.col("sid").alias("node"), F.col("sid").alias("root")).limit(0)
    links = None

    for turn in range(ROUNDS + 1):
        now = tiled.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        if turn < ROUNDS:
            pairs = possible(leader_pairs(now, percent, turn), marks, percent)
        else:  # what is left: every pair of unlike components in a tile
            mixed = now.groupBy("tile").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("tile")
            pairs = banded_pairs(now.join(mixed, "tile", "left_semi"), marks, percent)
        found = verified(filled, stored(pairs, "pairs"), percent, k)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = components(links)
    classed = sets.select("doc_id", "n", "sid").join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    # An empty set is a class of its own: its key is its document.
    key = F.when(F.col("n") > 0, F.coalesce("root", "sid"))
    classed = classed.select("doc_id", "n", key.alias("key"))
    lowest = classed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"))
    classes = classed.join(lowest, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id")
    )
    classes = stored(classes, "classes")
    remove_path(spark, path)
    return classes


def first_of_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest id, a row without an id last.

    Rows are named by a hash of their text, so rows that share a doc_id or have none
    are documents like others. Rows without words are linked with nothing and stay.
    """
    apart = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), "text")
    classes = link_components(apart.select(F.col("key").alias("doc_id"), "text"), k, percent)
    groups = classes.select(
        F.col("doc_id").alias("key"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group")
    ).distinct()
    rows = apart.groupBy("key", "id").agg(F.count("*").alias("times")).join(groups, "key")
    order = F.struct(F.col("id").isNull(), "id", "key", "times")
    first = rows.where("group is not null").groupBy("group").agg(F.min(order).alias("first"))
    stay = first.select("first.key", F.col("first.id").alias("of"), "first.times").unionByName(
        rows.where("group is null").select("key", F.col("id").alias("of"), F.lit(1).cast("long").alias("times"))
    )
    kept = apart.withColumnRenamed("key", "own").join(stay, (F.col("own") == F.col("key")) & F.col("id").eqNullSafe(F.col("of")))
    # Copies under one id or none: any that is first by all its columns.
    copies = kept.where("times > 1").groupBy("key").agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    return kept.where("times = 1").select("__row.*").unionByName(copies.select("__row.*"))
