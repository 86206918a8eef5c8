"""Repeated passages across documents, by chaining shared k-mer seeds.

1. Seeds: hashes of 8 consecutive words; the smallest of every 12 neighbours is
   kept, so any 19 shared words share a seed.
2. Matches: every seed is matched with its first holder (smallest document) and
   with the holder before its own document, so a passage held by many documents
   gives up to two sources per holder, not all pairs. A passage whose parts have
   unlike first holders is found in the holder before. Seeds of one document alone
   drop out.
3. Chains: per document and source, matches are taken by position; a Fenwick tree
   over the source positions gives the best earlier match at a gap cost that grows
   with the words skipped on both sides.
4. Alignment: chains are aligned word by word, over edits, and extended at both
   ends. Passages of at least 50 words with 80 of 100 words equal are kept.

Words are compared with A-Z as a-z. Null and empty texts, and texts of under 8
words, hold no passage. Copies of a row are documents like others; rows with one
doc_id are never matched with each other. The first holder of a passage, by
doc_id, is a source only and is left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side
from ..session import small_side
from .hashing import Words, shingles, words

K, NEIGHBOURS = 8, 12
GAP = 0.1
LEAST_WORDS = 50
LEAST_EQUAL = 0.8
#: Words beside a chain that the alignment may take in, and how far it looks for words that fit again.
MARGIN, LOOK = 24, 24
ANCHOR = 3


def minimizers(hashes: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Positions that are the smallest of some window of neighbours."""
    n = len(hashes)
    if n <= neighbours:
        return np.array([int(hashes.argmin())]) if n else np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, neighbours)
    return np.unique(windows.argmin(1) + np.arange(len(windows)))


def seeds(docs: DataFrame, k: int = K) -> DataFrame:
    """(seed, doc_id, pos)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words(batch.column(1))
            ids = batch.column(0).to_pylist()
            keys, places, owners = [], [], []
            for i, doc in enumerate(ids):
                own = found.of(i)
                if len(own) < k or doc is None:
                    continue
                h = shingles(own, k)
                at = minimizers(h)
                keys.append(h[at])
                places.append(at)
                owners.append(np.full(len(at), doc, np.int64))
            join = lambda parts, t: np.concatenate(parts).astype(t) if parts else np.zeros(0, t)
            columns = [join(keys, np.uint64).view(np.int64), join(owners, np.int64), join(places, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["seed", "doc_id", "pos"])

    return docs.select("doc_id", "text").mapInArrow(run, "seed long, doc_id long, pos int")


def matches(found: DataFrame) -> DataFrame:
    """(doc_id, pos, source, source_pos): every seed with its places in other documents.

    These are the first place in the first holder, the one of the same number there
    (counted round if it has fewer, so repeated lines lie along each other), and
    the first place in the last holder before the document. One sort by seed,
    document and position serves all.
    """
    places = Window.partitionBy("seed", "doc_id").orderBy("pos")
    holders = Window.partitionBy("seed")
    before = holders.orderBy("doc_id").rangeBetween(Window.unboundedPreceding, -1)
    ranked = found.withColumn("k", F.row_number().over(places)).withColumns(
        {
            "first": F.min(F.struct("doc_id", "pos")).over(holders),
            "last": F.max("doc_id").over(holders),
            "prior": F.max(F.struct(F.col("doc_id").alias("source"), (-F.col("pos")).alias("turned"))).over(before),
        }
    )
    own = F.collect_list(F.when(F.col("doc_id") == F.col("first.doc_id"), F.col("pos"))).over(holders)
    listed = ranked.where("first.doc_id < last").withColumn("places", F.sort_array(own)).where("doc_id > first.doc_id")
    at = lambda source, pos: F.struct(source.alias("source"), pos.alias("source_pos"))
    first = F.col("first.doc_id")
    ends = F.array(
        at(first, F.col("first.pos")),
        at(first, F.expr("places[(k - 1) % size(places)]")),
        at(F.col("prior.source"), -F.col("prior.turned")),
    )
    return listed.select("doc_id", "pos", F.explode(F.array_distinct(ends)).alias("m")).select("doc_id", "pos", "m.*")


def chains_of(x: list[int], y: list[int], k: int = K) -> list[tuple[int, int, int, int]]:
    """Disjoint chains (x0, x1, y0, y1) of matches sorted by (x, y), best first; ends are word positions."""
    n = len(x)
    rank = {v: r + 1 for r, v in enumerate(sorted(set(y)))}
    size = len(rank)
    tree: list[tuple[float, int]] = [(-1.0, -1)] * (size + 1)
    score, back = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and x[j] == x[i]:  # matches of one position don't follow each other
            r, best = rank[y[j]] - 1, (-1.0, -1)
            while r > 0:
                best = max(best, tree[r])
                r -= r & -r
            reach = best[0] - GAP * (x[j] + y[j]) if best[1] >= 0 else 0.0
            score[j] = k + max(0.0, reach)
            back[j] = best[1] if reach > 0 else -1
            j += 1
        for m in range(i, j):
            value, r = (score[m] + GAP * (x[m] + y[m]), m), rank[y[m]]
            while r <= size:
                if value > tree[r]:
                    tree[r] = value
                r += r & -r
        i = j
    used, out = [False] * n, []
    for m in sorted(range(n), key=lambda m: (-score[m], m)):
        if used[m]:
            continue
        at, low = m, m
        while at >= 0 and not used[at]:
            used[at], low = True, at
            at = back[at]
        out.append((x[low], x[m] + k, y[low], y[m] + k))
    return out


def chains(matched: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, source, x0, x1, y0, y1); a document's matches come to one task in order."""
    ordered = matched.repartition("doc_id").sortWithinPartitions("doc_id", "source", "pos", "source_pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple[int, int] | None = None
        x: list[int] = []
        y: list[int] = []
        out: list[tuple] = []

        def close() -> None:
            if key is not None:
                out.extend((*key, *c) for c in chains_of(x, y, k))

        def emit() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64()] + [pa.int32()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "source", "x0", "x1", "y0", "y1"]
            )

        for batch in batches:
            doc, src, pos, spos = (batch.column(c).to_numpy() for c in ("doc_id", "source", "pos", "source_pos"))
            cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(src) != 0)) + 1
            bounds = [0, *cuts.tolist(), len(doc)]
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if lo == hi:
                    continue
                if key != (int(doc[lo]), int(src[lo])):
                    close()
                    key, x, y = (int(doc[lo]), int(src[lo])), [], []
                x += pos[lo:hi].tolist()
                y += spos[lo:hi].tolist()
            if out:
                yield emit()
                out = []
        close()
        yield emit()

    return ordered.mapInArrow(run, "doc_id long, source long, x0 int, x1 int, y0 int, y1 int")


def align(a: np.ndarray, b: np.ndarray, i: int, j: int, stop: int) -> tuple[int, int, int]:
    """Walk from words i of a and j of b; (end in a, end in b, equal words).

    Equal stretches are crossed at once. At a difference the nearest place where
    ``ANCHOR`` words agree again is taken, at most ``LOOK`` words on. Beyond
    ``stop`` in ``a``, where the chain ends, differences are no longer crossed.
    """
    equal, end_i, end_j = 0, i, j
    while i < len(a) and j < len(b):
        n = min(len(a) - i, len(b) - j)
        unlike = np.flatnonzero(a[i : i + n] != b[j : j + n])
        run = int(unlike[0]) if len(unlike) else n
        equal, i, j = equal + run, i + run, j + run
        if run:
            end_i, end_j = i, j
        if i >= stop or run == n:
            break
        step = None
        for far in range(1, 2 * LOOK):
            for di in range(max(0, far - LOOK), min(far, LOOK) + 1):
                p, q = i + di, j + far - di
                if p + ANCHOR <= len(a) and q + ANCHOR <= len(b) and (a[p : p + ANCHOR] == b[q : q + ANCHOR]).all():
                    step = (p, q)
                    break
            if step:
                break
        if not step:
            break
        i, j = step
    return end_i, end_j, equal


def passage(a: np.ndarray, b: np.ndarray, x: tuple[int, int], y: tuple[int, int]) -> tuple[int, int, int, int, int]:
    """Aligned passage (start and end in a, in b, equal words) around a chain."""
    i, j, equal = x[0], y[0], 0
    while i > 0 and j > 0 and a[i - 1] == b[j - 1]:
        i, j, equal = i - 1, j - 1, equal + 1
    end_i, end_j, more = align(a, b, x[0], y[0], x[1])
    return i, end_i, j, end_j, equal + more


def _source_words(chained: DataFrame, docs: DataFrame) -> DataFrame:
    """Chains with the source's word hashes around them (from word ``from``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, None
        for batch in batches:
            kept, begins = [], []
            for source, text, y0, y1 in zip(*(batch.column(c) for c in ("source", "text", "y0", "y1"))):
                if source != last:
                    last, found = source, words(pa.array([text.as_py()], pa.string())).hashes
                begin = max(0, y0.as_py() - MARGIN)
                kept.append(found[begin : y1.as_py() + MARGIN].tobytes())
                begins.append(begin)
            rest = [batch.column(c) for c in ("doc_id", "source", "x0", "x1", "y0", "y1")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(begins, pa.int32()), pa.array(kept, pa.binary())],
                ["doc_id", "source", "x0", "x1", "y0", "y1", "from", "words"],
            )

    # Joined by the texts' own column, so that Spark uses one shuffle of the texts for this join and the next.
    turned = chained.select(F.col("doc_id").alias("of"), F.col("source").alias("doc_id"), "x0", "x1", "y0", "y1")
    joined = turned.join(docs, "doc_id").select(
        F.col("of").alias("doc_id"), F.col("doc_id").alias("source"), "x0", "x1", "y0", "y1", "text"
    )
    return joined.mapInArrow(
        run, "doc_id long, source long, x0 int, x1 int, y0 int, y1 int, from int, words binary"
    )


def code_points(found: Words) -> np.ndarray:
    """Code points before each byte of a single text."""
    return np.r_[0, np.cumsum((found.data & 0xC0) != 0x80)]


def passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, source_id, start, end, n_words, n_equal, source_word): repeats of earlier documents' passages.

    Positions are code points, the end exclusive.
    """
    rows = docs.select("doc_id", "text")
    chained = chains(matches(seeds(rows)))
    fitted = _source_words(chained.where(F.col("x1") - F.col("x0") >= least_words // 2), rows).join(rows, "doc_id")
    schema = "doc_id long, source_id long, start long, end long, n_words int, n_equal int, source_word int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found, points = None, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["doc_id"] != last:
                    last, found = row["doc_id"], words(pa.array([row["text"]], pa.string()))
                    points = code_points(found)
                own, src = found.hashes, np.frombuffer(row["words"], np.uint64)
                begin = row["from"]
                if row["x1"] > len(own):
                    continue  # another row of the same id
                i, e, j, f, equal = passage(own, src, (row["x0"], row["x1"]), (row["y0"] - begin, row["y1"] - begin))
                if e - i >= least_words and equal >= LEAST_EQUAL * max(e - i, f - j):
                    start, end = points[found.starts[i]], points[found.ends[e - 1]]
                    out.append((row["doc_id"], row["source"], int(start), int(end), e - i, equal, j + begin))
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "source_id", "start", "end", "n_words", "n_equal", "source_word"],
            )

    return fitted.select("doc_id", "source", "x0", "x1", "y0", "y1", "from", "words", "text").mapInArrow(run, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from all documents but the first that holds them.

    Spans are told by doc_id, so rows that share one, or have none, keep their texts.
    The spans are stored first: where they are small, the documents aren't shuffled again.
    """
    single = docs.groupBy("doc_id").agg(F.count("*").alias("__rows")).where("__rows = 1").select("doc_id")
    spans = (
        passages(docs)
        .join(single, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"))
    )
    spans = small_side(spans)

    def step(a: Column, s: Column) -> Column:
        gap = F.substring("text", a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(a["at"], s["end"].cast("int")).alias("at"), F.concat(a["out"], gap).alias("out"))

    rest = F.aggregate(
        "__spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.length("text"))),
    )
    cut = docs.join(spans, "doc_id", "left").withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(rest))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)
