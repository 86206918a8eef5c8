"""Best-fit packing by a grouping genetic algorithm.

A document is its token ids and one closing id 0. Only documents above the
sequence length are cut: full pieces fill a sequence each, and the first piece,
which may be shorter, is packed like a whole document.

Packing runs on (document, length) rows only. Rows are dealt by hash into shards
of about ``SHARD`` items; the number of shards follows the data. Each shard is
packed by ``ISLANDS`` islands, tasks of their own with unlike seeds. An
individual is a list of bins. Crossover injects whole well-filled bins of a mate,
removes the bins that now hold a document twice, and best-fits the displaced
documents, longest first. After every epoch the islands of a shard exchange their
best individual through a shuffle (elite migration). At the end, bins of the best
individual that are well filled stay; the documents of the others go to a second,
smaller round of shards, until one shard is left or a round settles less than
half of its documents.

Nulls: a null text is empty; an empty text is the closing id alone. Null ids are
kept. Repeated rows are packed one by one. An empty table gives no rows.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import stored

LENGTH = 2048
END_ID = 0
SHARD = 2048
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 5
#: A bin stays after a round if at most this many tokens are free.
WELL_FILLED = 8
ROUND = 1 << 59
#: Units kept by one task's encoder.
CACHE = 200_000
#: White space that may join the space before or after it in one token.
CROWDED = re.compile(r"  | \n|\n |[^\S \n]| $")

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of the public byte-level vocabulary, as little-endian unsigned 32-bit bytes.

    In texts whose spaces stand alone, no token reaches over the start of a
    space, so the stretches between them are encoded apart and remembered. Other
    texts are encoded whole. Texts with the vocabulary's special token go to the
    tokenizer itself, which knows it.
    """

    def __init__(self, vocabulary: str, ranks: str) -> None:
        import base64

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        got = np.array(self.fast.encode_ordinary(unit), "<u4").tobytes()
        if len(self.known) < CACHE and len(unit) < 64:
            self.known[unit] = got
        return got

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if CROWDED.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        head, *rest = text.split(" ")
        known, unit = self.known, self._unit
        parts = [known.get(head) or unit(head)] if head else []
        parts += [known.get(u) or unit(u) for u in (" " + r for r in rest)]
        return b"".join(parts)


def pieces_of(total: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first may be shorter."""
    first = total % length or min(total, length)
    return [(0, first)] + [(s, length) for s in range(first, total, length)]


def piece_rows(docs: DataFrame, vocabulary: str, ranks: str, length: int = LENGTH) -> DataFrame:
    """One row per piece, with the checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                for k, (s, n) in enumerate(pieces_of(len(ids) // 4, length)):
                    rows.append((doc, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


def best_fit(items: list[int], lengths: list[int], bins: list[list[int]], free: list[int], limit: int) -> None:
    """Put items, longest first, each into the fullest bin that takes it."""
    open_bins = sorted((f, b) for b, f in enumerate(free) if f > 0)
    for i in sorted(items, key=lengths.__getitem__, reverse=True):
        at = bisect_left(open_bins, (lengths[i], -1))
        if at == len(open_bins):
            left, b = limit, len(bins)
            bins.append([])
            free.append(limit)
        else:
            left, b = open_bins.pop(at)
        bins[b].append(i)
        free[b] = left - lengths[i]
        if free[b]:
            insort(open_bins, (free[b], b))


def fitness(bins: list[list[int]], lengths: list[int], limit: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones (free room gathered in few bins)."""
    return -len(bins), sum((sum(lengths[i] for i in b) / limit) ** 2 for b in bins)


def crossover(a: list[list[int]], b: list[list[int]], lengths: list[int], limit: int, rng: random.Random) -> list[list[int]]:
    full = sorted(b, key=lambda x: sum(lengths[i] for i in x), reverse=True)
    share = full[: max(1, len(full) // 2)]
    injected = [x for x in share if rng.random() < 0.5] or share[:1]
    taken = {i for x in injected for i in x}
    kept, displaced = [], []
    for x in a:
        if taken.isdisjoint(x):
            kept.append(x)
        else:
            displaced += [i for i in x if i not in taken]
    loose = sorted(range(len(kept)), key=lambda k: sum(lengths[i] for i in kept[k]))[: 1 + len(kept) // 50]
    for k in sorted(loose, reverse=True):  # mutation: the worst bins are dissolved
        displaced += kept.pop(k)
    bins = [list(x) for x in injected + kept]
    best_fit(displaced, lengths, bins, [limit - sum(lengths[i] for i in x) for x in bins], limit)
    return bins


def evolve(population: list[list[list[int]]], lengths: list[int], limit: int, rng: random.Random) -> list[list[list[int]]]:
    """Some generations; the population comes back best first. Stops at the lower bound."""
    bound = -(-sum(lengths) // limit)
    rank = lambda bins: fitness(bins, lengths, limit)
    scored = sorted(((rank(p), k, p) for k, p in enumerate(population)), reverse=True)
    for _ in range(GENERATIONS):
        if len(scored[0][2]) <= bound:
            break
        mates = rng.sample(range(len(scored)), 2) if len(scored) > 1 else [0, 0]
        child = crossover(scored[mates[0]][2], scored[mates[1]][2], lengths, limit, rng)
        worst = scored[-1]
        scored[-1] = max(((rank(child), -1, child), worst))
        scored = [(s, k, p) for k, (s, _, p) in enumerate(sorted(scored, key=lambda x: x[0], reverse=True))]
    return [p for _, _, p in scored]


def _founders(lengths: list[int], limit: int, rng: random.Random) -> list[list[list[int]]]:
    out = []
    for k in range(POPULATION):
        bins: list[list[int]] = []
        items = list(range(len(lengths)))
        if k == 0:
            best_fit(items, lengths, bins, [], limit)
        else:  # random parts of the items first, then the rest: unlike individuals
            rng.shuffle(items)
            cut = rng.randrange(len(items) + 1)
            free: list[int] = []
            best_fit(items[:cut], lengths, bins, free, limit)
            best_fit(items[cut:], lengths, bins, free, limit)
        out.append(bins)
    return out


def _coded(bins: list[list[int]], n: int) -> bytes:
    out = np.zeros(n, "<i4")
    for b, items in enumerate(bins):
        out[items] = b
    return out.tobytes()


def _decoded(code: bytes) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(np.frombuffer(code, "<i4").tolist()):
        bins.setdefault(b, []).append(i)
    return list(bins.values())


def _epoch(problems: DataFrame, epoch: int, limit: int) -> DataFrame:
    """(shard, island, lengths, elites, best): islands evolve, founders or immigrants first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").tolist()
                rng = random.Random(f"{row['shard']}/{row['island']}/{epoch}")
                people = [_decoded(c) for c in row["elites"] or []]
                if -(-sum(lengths) // limit) < min((len(p) for p in people), default=len(lengths) + 1):
                    people = evolve((people + _founders(lengths, limit, rng))[: POPULATION + ISLANDS], lengths, limit, rng)
                best = people[0]
                score = fitness(best, lengths, limit)
                out.append((row["shard"], row["island"], row["lengths"], _coded(best, len(lengths)), score[0] + score[1] / (len(lengths) + 1)))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["shard", "island", "lengths", "best", "score"]
            )

    return problems.mapInArrow(run, "shard long, island int, lengths binary, best binary, score double")


def _round(items: DataFrame, shards: int, limit: int, name: str) -> DataFrame:
    """Items with shard, bin and the bin's fill, from the best island of each shard."""
    # One row an item; a shard's items are gathered in a fixed order, about SHARD of them by the hash.
    dealt = items.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(name)), F.lit(shards)))
    listed = dealt.groupBy("shard").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "piece", "start", "length", "ids_crc32"))).alias("items")
    )
    listed = stored(listed, "shards")
    packed = _to_bytes(listed)
    current = packed.select("shard", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"), "lengths", F.lit(None).cast("array<binary>").alias("elites"))
    for epoch in range(EPOCHS):
        spread = current.repartition("shard", "island")
        done = stored(_epoch(spread, epoch, limit), "epoch")
        elites = done.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("score", "best")), asc=False).alias("e"))
        current = done.select("shard", "island", "lengths").join(
            elites.select("shard", F.col("e.best").alias("elites")), "shard"
        )
    best = elites.select("shard", F.col("e")[0]["best"].alias("best"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins = np.frombuffer(row["best"], "<i4").astype(np.int64)
                lengths = np.array([x["length"] for x in row["items"]], np.int64)
                fill = np.bincount(bins, lengths).astype(np.int64)
                order = np.argsort(bins, kind="stable")
                run = np.cumsum(lengths[order]) - lengths[order]
                head = np.r_[True, np.diff(bins[order]) != 0]
                offsets = np.empty(len(bins), np.int64)
                offsets[order] = run - np.repeat(run[head], np.diff(np.r_[np.flatnonzero(head), len(bins)]))
                columns = [pa.array([x[c] for x in row["items"]], t) for c, t in zip(FIELDS, TYPES)]
                columns += [pa.array(np.full(len(bins), row["shard"])), pa.array(bins), pa.array(fill[bins]), pa.array(offsets)]
                yield pa.RecordBatch.from_arrays(columns, [*FIELDS, "shard", "bin", "fill", "offset"])

    return listed.join(best, "shard").select("shard", "items", "best").mapInArrow(
        place, PIECE + ", shard long, bin long, fill long, offset long"
    )


FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32"]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _to_bytes(listed: DataFrame) -> DataFrame:
    """(shard, lengths): the lengths of a shard's items, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.array(x, "<i4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], ["shard", "lengths"])

    lengths = listed.select("shard", F.transform("items", lambda x: x["length"].cast("int")).alias("lengths"))
    return lengths.mapInArrow(run, "shard long, lengths binary")


def pack(docs: DataFrame, vocabulary: str, ranks: str, length: int = LENGTH) -> DataFrame:
    """One row per piece with its sequence and offset.

    Sequence numbers: rounds and shards count upwards in their own bits, so
    numbers of unlike rounds, shards and bins differ.
    """
    pieces = stored(piece_rows(docs, vocabulary, ranks, length), "pieces")
    full = F.col("length") == length
    alone = F.lit(8).cast("long") * ROUND + F.monotonically_increasing_id()
    result = pieces.where(full).select(*FIELDS, alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = pieces.where(~full)
    count = items.count()
    for level in range(8):
        if not count:
            break
        shards = -(-count // SHARD)
        placed = stored(_round(items, shards, length, f"round{level}"), "placed")
        number = F.lit(level).cast("long") * ROUND + F.col("shard") * (1 << 24) + F.col("bin")
        numbered = placed.select(*FIELDS, number.alias("sequence_id"), "offset", "fill")
        items = placed.where(F.col("fill") < length - WELL_FILLED).select(*FIELDS)
        before, count = count, items.count()
        if shards == 1 or level == 7 or 2 * count > before:
            return result.unionByName(numbered.drop("fill"))
        result = result.unionByName(numbered.where(F.col("fill") >= length - WELL_FILLED).drop("fill"))
    return result
