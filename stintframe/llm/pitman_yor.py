"""Hierarchical Pitman-Yor language model with Gibbs-sampled seating.

Restaurants: one for every preceding word and one for the start of a text; all
have the unigram restaurant as their parent, and that has the uniform base over
the vocabulary and the unknown word. A word's customers in a context are its
bigram occurrences in the training texts; its tables in all contexts are its
customers in the parent.

Spark deals words to buckets by hash, so a bucket holds all restaurants' tables
for its words. What buckets share are the restaurants' sums (customers, tables).
After each sweep every bucket sends its part of them, packed and cut by ranges of
context hashes; the ranges are summed in tasks of their own, and every bucket gets
back the sums of the contexts it holds. In a sweep, the customers of every word in
every context stand up and are seated again one by one (existing tables or a new
one by the Chinese restaurant rule), then those of the parent; the new seating is
accepted by the Metropolis rule that makes the block move an exact Gibbs step for
the bucket. Predictive probabilities are averaged over the sweeps after the
burn-in.

Scoring uses the same buckets: texts are cut into words once, the words of a
block of documents travel to their buckets as packed columns, and partial scores
return to the documents by a sum. A bucket's states come before its blocks, so
one copy of them serves all blocks. Nothing sized by the vocabulary or by the
corpus meets in one task or on the driver.

A null text counts as empty; an empty text is its end alone. Without training
texts, every word has the uniform probability. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import stored
from .hashing import words

START = np.uint64(0)  # restaurant of text starts; the others have the hash of their word
#: Word hashes have 54 bits above ten empty ones.
LOW = np.uint64(1023)
END = np.uint64(0xE0D0E0D0E0D0E000)
STRENGTH = 1.0
SWEEPS, BURN_IN = 3, 1
#: Customers seated one by one; beyond, blocks of a sixteenth of those seated.
SINGLY = 64
#: Words of training text behind one bucket.
BUCKET_WORDS = 2_000_000
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 5) = 1"
HELD = f"coalesce({HELD_OUT}, false) as held"


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes with an end after each text, hash of the word before or 0 at a start, text number)."""
    found = words(texts)
    n = len(texts)
    counts = np.diff(found.first)
    owner = np.repeat(np.arange(n), counts + 1)
    token = np.full(len(owner), END, np.uint64)
    ends = np.cumsum(counts + 1) - 1
    inner = np.ones(len(owner), bool)
    inner[ends] = False
    token[inner] = found.hashes & ~LOW
    before = np.zeros(len(owner), np.uint64)
    before[1:] = token[:-1]
    before[(ends + 1)[:-1]] = 0
    if len(before):
        before[0] = 0
    return token, before, owner


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words ascending, word and word before of every token as one number, text number).

    The number is that of the word times ``len(words) + 1``, plus 0 at a start or
    one more than that of the word before.
    """
    token, before, owner = tokens_of(texts)
    known, at = np.unique(token, return_inverse=True)
    prior = np.zeros(len(at), np.int64)
    prior[1:] = at[:-1] + 1
    prior[before == START] = 0
    return known, at.astype(np.int64) * (len(known) + 1) + prior, owner


def counted_runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, np.int64)
    return sorted_keys[at], np.diff(np.r_[at, len(sorted_keys)])


def bucket_bounds(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are equal ranges of hashes, so sorted keys are sorted by bucket too."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]
    return np.r_[0, np.searchsorted(sorted_keys, np.array(edges, np.uint64)), len(sorted_keys)]


def narrow(numbers: np.ndarray) -> bytes:
    """Numbers from 0 in two bytes each, or four if one of them needs it."""
    return numbers.astype(np.int16 if not len(numbers) or numbers.max() < 1 << 15 else np.int32).tobytes()


def widened(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, np.int16 if len(packed) == 2 * n else np.int32)


def packed_pairs(known: np.ndarray, keys: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Distinct words, pairs of each, distinct contexts and context number of each pair, from ascending distinct keys."""
    word, prior = np.divmod(keys, len(known) + 1)
    word, per = counted_runs(word)
    listed, context = np.unique(prior, return_inverse=True)
    hashes = np.r_[START, known][listed]
    return known[word].tobytes(), per.astype(np.int32).tobytes(), hashes.tobytes(), narrow(context)


def pairs_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Word and context hash of every packed pair."""
    per = np.frombuffer(row["per"], np.int32)
    context = widened(row["context"], int(per.sum()))
    return np.repeat(np.frombuffer(row["token"], np.uint64), per), np.frombuffer(row["contexts"], np.uint64)[context]


def parts_of(known: np.ndarray, keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of the ascending keys' buckets that are not empty."""
    bounds = np.searchsorted(keys, bucket_bounds(known, buckets) * (len(known) + 1))
    return [(b, lo, hi) for b, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])) if lo < hi]


def training_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, token, per, contexts, context, n): customers per word and context of a block of texts, packed per bucket.

    Pairs of held-out texts alone have no customers; they make their contexts
    known to the bucket, which needs the sums of these restaurants to score them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                known, keys, owner = numbered(batch.column(0))
                keys = np.sort(2 * keys + held[owner])
                pairs, _ = counted_runs(keys >> 1)
                first = np.searchsorted(keys, 2 * pairs)
                n = np.add.reduceat(1 - (keys & 1), first) if len(keys) else keys
                parts = parts_of(known, pairs, buckets)
                rows = [(b, *packed_pairs(known, pairs[lo:hi]), n[lo:hi].astype(np.int32).tobytes()) for b, lo, hi in parts]
                types = [pa.int32()] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], COUNTED)

    schema = "bucket int, " + ", ".join(f"{c} binary" for c in COUNTED[1:])
    return docs.selectExpr("text", HELD).mapInArrow(run, schema)


def occurrences(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, size, facts, token, per, contexts, context, n, owner): a block's words for one bucket.

    ``token``, ``per``, ``contexts`` and ``context`` list the distinct pairs, ``n``
    how many occurrences each has; ``owner`` has an entry per occurrence. The
    block's first row also has ``facts``: ids, held-out marks and token counts of
    its documents. All are packed numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                known, keys, owner = numbered(batch.column(1))
                order = np.argsort(keys)
                keys, owner = keys[order], owner[order]
                size, block = batch.num_rows, block + 1
                ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                facts = b"".join(x.tobytes() for x in (ids, np.bincount(owner, minlength=size).astype(np.int64), held, null))
                rows = []
                for b, lo, hi in parts_of(known, keys, buckets):
                    pairs, n = counted_runs(keys[lo:hi])
                    own = (n.astype(np.int32).tobytes(), owner[lo:hi].astype(np.int16).tobytes())
                    rows.append((b, block, size, None if rows else facts, *packed_pairs(known, pairs), *own))
                types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], NAMES)

    schema = "bucket int, block long, size int, " + ", ".join(f"{c} binary" for c in NAMES[3:])
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text", HELD).mapInArrow(run, schema)


#: Documents of a block; owners are numbers of two bytes.
BLOCK = 4096
COUNTED = ["bucket", "token", "per", "contexts", "context", "n"]
NAMES = ["bucket", "block", "size", "facts", "token", "per", "contexts", "context", "n", "owner"]


def seat(customers: np.ndarray, base: np.ndarray, others: np.ndarray, discount: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Seat the customers of each word anew; (tables, log of the proposal's weights).

    ``base`` is the parent's probability of the word and ``others`` the tables of
    all other words in the restaurant.
    """
    n = len(customers)
    tables = np.ones(n)
    fresh = (STRENGTH + discount * others) * base
    weight = np.log(fresh)
    seated = 1
    live = np.flatnonzero(customers > 1)
    while len(live):
        block = 1 if seated < SINGLY else max(1, seated // 16)
        t, c = tables[live], customers[live]
        new = (STRENGTH + discount * (others[live] + t)) * base[live]
        total = seated - discount * t + new
        size = np.minimum(block, c - seated)
        chance = np.minimum(new / total, 1.0)
        come = (rng.random(len(live)) < chance) if block == 1 else rng.binomial(size.astype(np.int64), chance)
        tables[live] = t + come
        weight[live] += size * np.log(total)
        seated += block
        live = live[c > seated]
    return tables, weight


def sweep(word: np.ndarray, context: np.ndarray, customers: np.ndarray, tables, weight, top, totals: dict, discounts, vocabulary: int, rng):
    """One sweep over a bucket; rows are (word, context), sorted by word.

    Returns tables per row, their weights, and tables per word in the parent.
    """
    n_words = int(word.max()) + 1 if len(word) else 0
    c_top, t_top = totals["customers"][-1], totals["tables"][-1]
    d_low, d_top = discounts
    parent_customers = np.bincount(word, tables, n_words)
    uniform = 1.0 / (vocabulary + 1)
    base = (np.maximum(parent_customers - d_top * top, 0) + (STRENGTH + d_top * t_top) * uniform) / (STRENGTH + max(c_top, 1))
    others = np.maximum(totals["tables"][context] - tables, 0)
    proposed, its = seat(customers, base[word], others, d_low, rng)
    accept = (weight == 0) | (np.log(rng.random(len(word))) < its - weight)  # 0: not seated yet
    tables, weight = np.where(accept, proposed, tables), np.where(customers > 1, np.where(accept, its, weight), 0)
    parent_customers = np.bincount(word, tables, n_words)
    top, _ = seat(parent_customers, np.full(n_words, uniform), np.maximum(t_top - top, 0), d_top, rng)
    return tables, weight, top


STATE_COLUMNS = ["word", "rows", "context", "customers", "tables", "weight", "top"]
STATE = (
    "bucket int, " + ", ".join(f"{c} binary" for c in STATE_COLUMNS) + ", contexts binary, trained long, seated double, topped double"
)
#: Packed customers and tables of a range of a bucket's contexts.
SUMS = "bucket int, part int, c binary, t binary"


def _state(bucket, token, per, context, customers, tables, weight, top, contexts) -> pa.RecordBatch:
    """A bucket's state; ``contexts`` are the hashes behind the context numbers."""
    seated = float(tables.sum())
    packed = [token, per.astype(np.int32), context, customers.astype(np.int32), tables.astype(np.int32), weight.astype(np.float32), top.astype(np.int32)]
    packed = [narrow(x) if x is context else x.tobytes() for x in packed] + [contexts.tobytes()]
    sums = [pa.array([int(customers.sum())], pa.int64()), pa.array([seated]), pa.array([float(top.sum())])]
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in packed), *sums],
        ["bucket", *STATE_COLUMNS, "contexts", "trained", "seated", "topped"],
    )


def _unpack(row: dict) -> tuple:
    kinds = (("word", np.uint64), ("rows", np.int32), ("customers", np.int32), ("tables", np.int32), ("weight", np.float32), ("top", np.int32))
    word, rows, customers, *rest = (np.frombuffer(row[c], t) for c, t in kinds)
    return word, rows, widened(row["context"], len(customers)), customers, *rest


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: packed columns are long, so a batch is not turned into objects at once."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _summed(token: np.ndarray, context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal pairs summed; ordered by word, then context."""
    order = np.lexsort((context, token))
    token, context, n = token[order], context[order], n[order]
    at = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (context[1:] != context[:-1])])
    return token[at], context[at], np.add.reduceat(n, at)


def _counted(dealt: DataFrame) -> DataFrame:
    """First state of every bucket: a table for every word and context."""

    def state(bucket: int, found: list) -> pa.RecordBatch:
        token, context, n = _summed(*map(np.concatenate, zip(*found)))
        contexts = np.unique(context)
        token, context, n = token[n > 0], np.searchsorted(contexts, context[n > 0]), n[n > 0]
        distinct, per = counted_runs(token)
        return _state(bucket, distinct, per, context, n, np.ones(len(n)), np.zeros(len(n)), np.ones(len(distinct)), contexts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, found = None, []
        for row in _rows(batches):
            if row["bucket"] != bucket:
                if found:
                    yield state(bucket, found)
                bucket, found = row["bucket"], []
            found.append((*pairs_of(row), np.frombuffer(row["n"], np.int32)))
            if len(found) > 1 and sum(len(f[0]) for f in found[1:]) > max(BUCKET_WORDS, 2 * len(found[0][0])):
                found = [_summed(*map(np.concatenate, zip(*found)))]
        if found:
            yield state(bucket, found)

    return dealt.sortWithinPartitions("bucket").mapInArrow(run, STATE)


def _sums(state: DataFrame, buckets: int) -> tuple[DataFrame, tuple[float, float]]:
    """Sums of all restaurants, as ``SUMS`` for each bucket in the order of its contexts, and those of the parent."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            contexts = np.frombuffer(row["contexts"], np.uint64)
            context = widened(row["context"], len(row["customers"]) // 4)
            c, t = (np.bincount(context, np.frombuffer(row[x], np.int32), len(contexts)).astype(np.int64) for x in ("customers", "tables"))
            bounds = bucket_bounds(contexts, buckets)
            rows = [
                (row["bucket"], part, c[lo:hi].tobytes(), t[lo:hi].tobytes(), contexts[lo:hi].tobytes())
                for part, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:]))
                if lo < hi
            ]
            types = [pa.int32()] * 2 + [pa.binary()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), types)], ["bucket", "part", "c", "t", "contexts"])

    def returned(found: list[dict]) -> pa.RecordBatch:
        sizes = np.cumsum([len(r["c"]) // 8 for r in found])[:-1]
        contexts = np.concatenate([np.frombuffer(r["contexts"], np.uint64) for r in found])
        listed, at = np.unique(contexts, return_inverse=True)
        columns = []
        for x in ("c", "t"):
            own = np.concatenate([np.frombuffer(r[x], np.int64) for r in found])
            whole = np.bincount(at, own, len(listed)).astype(np.int64)[at]
            columns.append(pa.array([y.tobytes() for y in np.split(whole, sizes)], pa.binary()))
        ids = [pa.array([r[x] for r in found], pa.int32()) for x in ("bucket", "part")]
        return pa.RecordBatch.from_arrays([*ids, *columns], ["bucket", "part", "c", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        for row in _rows(batches):
            if found and found[0]["part"] != row["part"]:
                yield returned(found)
                found = []
            found.append(row)
        if found:
            yield returned(found)

    dealt = state.select("bucket", "contexts", "context", "customers", "tables").mapInArrow(sent, SUMS + ", contexts binary")
    sums = dealt.repartition(buckets, "part").sortWithinPartitions("part").mapInArrow(run, SUMS)
    top = state.agg(*(F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in ("seated", "topped"))).first()
    return sums, (top["seated"], top["topped"])


def _meeting(state: DataFrame, sums: DataFrame, turn: int) -> DataFrame:
    """A bucket's sums and state as rows of one table."""
    return sums.withColumn("turn", F.lit(turn)).unionByName(state.withColumn("turn", F.lit(turn)), allowMissingColumns=True)


def _restaurants(found: list[dict], top: tuple[float, float]) -> dict:
    """Customers and tables of a bucket's restaurants, the parent's last."""
    ordered = sorted(found, key=lambda r: r["part"])
    return {
        name: np.r_[np.zeros(0), *(np.frombuffer(r[x], np.int64) for r in ordered), own].astype(float)
        for name, x, own in (("customers", "c", top[0]), ("tables", "t", top[1]))
    }


def _swept(met: DataFrame, buckets: int, top_sums: tuple[float, float], discounts: tuple[float, float], vocabulary: int, turn: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[dict] = []
        for row in _rows(batches):
            if row["part"] is not None:
                sums.append(row)
                continue
            token, per, context, customers, tables, weight, top = _unpack(row)
            rng = np.random.default_rng([turn, row["bucket"]])
            word = np.repeat(np.arange(len(token)), per)
            tables, weight, top = sweep(
                word, context.astype(np.int64), customers.astype(float), tables.astype(float), weight.astype(float), top.astype(float),
                _restaurants(sums, top_sums), discounts, vocabulary, rng,
            )
            sums = []
            yield _state(row["bucket"], token, per, context, customers, tables, weight, top, np.frombuffer(row["contexts"], np.uint64))

    ordered = met.repartition(buckets, "bucket").sortWithinPartitions("bucket", F.col("part").asc_nulls_last())
    return ordered.mapInArrow(run, STATE)


def discount_of(ones: float, twos: float) -> float:
    """Usual estimate from how many things were seen once and twice."""
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5


def looked_into(row: dict, contexts: int) -> tuple:
    """What ``probabilities`` reads of a state, worked out once for all blocks: words, their counts,
    tables and parent's tables, and (word, context) as one number with its customers and tables."""
    words_, per, ctx, customers, tables, _, top = _unpack(row)
    word = np.repeat(np.arange(len(words_)), per)
    count = np.bincount(word, customers, len(words_))
    up = np.bincount(word, tables, len(words_))
    return words_, count, up, top, word.astype(np.int64) * contexts + ctx, customers, tables


def probabilities(state: tuple, token: np.ndarray, context: np.ndarray, totals: dict, discounts, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """``predictive`` on a state that was looked into."""
    words_, count, up, top, key, customers, tables = state
    uniform = 1.0 / (vocabulary + 1)
    d_low, d_top = discounts
    c, t = totals["customers"], totals["tables"]
    at = np.minimum(np.searchsorted(words_, token), max(len(words_) - 1, 0))
    known = words_[at] == token if len(words_) else np.zeros(len(token), bool)
    rest = (STRENGTH + d_top * t[-1]) * uniform
    parent = rest + np.where(known, np.maximum(up[at] - d_top * top[at], 0), 0) if len(words_) else np.full(len(token), rest)
    parent = parent / (STRENGTH + c[-1])
    own = np.zeros(len(token))
    if len(words_):
        want = at.astype(np.int64) * len(c) + context
        k = np.minimum(np.searchsorted(key, want), len(key) - 1)
        hit = known & (key[k] == want)
        own = np.where(hit, np.maximum(customers[k] - d_low * tables[k], 0), 0)
    p = (own + (STRENGTH + d_low * t[context]) * parent) / (STRENGTH + c[context])
    return p, np.where(known, count[at], 0) if len(words_) else np.zeros(len(token))


def predictive(row: dict, token: np.ndarray, context: np.ndarray, totals: dict, discounts, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each (word, context) under one sample, and training count of the word."""
    return probabilities(looked_into(row, len(totals["customers"])), token, context, totals, discounts, vocabulary)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every document."""
    rows = docs.select("doc_id", "text")
    # About six bytes a word: buckets follow the size of the corpus.
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(8, int(size) // (6 * BUCKET_WORDS))
    dealt = training_counts(rows, buckets).repartition(buckets, "bucket")
    state = stored(_counted(dealt), "state")
    words_in = (F.octet_length("word") / 8).cast("long")
    facts = state.agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(n) for x, n in ((words_in, "v"), (F.col("trained"), "n")))).first()
    vocabulary, trained = facts["v"], facts["n"]
    sums, top = _sums(state, buckets)
    discounts = _discounts(state)
    samples = []
    for turn in range(SWEEPS):
        state = stored(_swept(_meeting(state, sums, turn), buckets, top, discounts, vocabulary, turn), "state")
        sums, top = _sums(state, buckets)
        if turn >= BURN_IN:
            sums = stored(sums, "sums")
            samples.append((_meeting(state, sums, turn), top))
    return _scored(occurrences(rows, buckets), buckets, samples, discounts, vocabulary, trained)


def _discounts(state: DataFrame) -> tuple[float, float]:
    """Discounts of the contexts and of the parent, from counts over all buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                customers, per = np.frombuffer(row["customers"], np.int32), np.frombuffer(row["rows"], np.int32)
                sums = [(customers == 1).sum(), (customers == 2).sum(), (per == 1).sum(), (per == 2).sum()]
                yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in sums], ["a", "b", "c", "d"])

    r = state.mapInArrow(run, "a double, b double, c double, d double").agg(*(F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in "abcd")).first()
    return discount_of(r["a"], r["b"]), discount_of(r["c"], r["d"])


def _scored(dealt: DataFrame, buckets: int, samples: list, discounts, vocabulary: int, trained: int) -> DataFrame:
    met = dealt.withColumnRenamed("context", "pairs").withColumnRenamed("contexts", "listed")
    for state, _ in samples:
        met = met.unionByName(state.drop("weight", "trained", "seated", "topped"), allowMissingColumns=True)
    tops = [top for _, top in samples]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, sums, held, contexts = None, [], [], None
        for row in _rows(batches):
            if row["bucket"] != bucket:
                bucket, sums, held = row["bucket"], [], []
            if row["part"] is not None:
                sums.append(row)
            elif row["turn"] is not None:
                totals = _restaurants(sums, tops[len(held)])
                held.append((looked_into(row | {"weight": b""}, len(totals["customers"])), totals))
                contexts, sums = np.frombuffer(row["contexts"], np.uint64), []
            else:
                # Each distinct (word, context) is looked up once.
                token, at = pairs_of(row | {"context": row["pairs"], "contexts": row["listed"]})
                context = np.searchsorted(contexts, at)
                owner = np.frombuffer(row["owner"], np.int16).astype(np.int64)
                back = np.repeat(np.arange(len(token)), np.frombuffer(row["n"], np.int32))
                p = np.zeros(len(token))
                for state, totals in held:
                    q, c = probabilities(state, token, context, totals, discounts, vocabulary)
                    p += q / len(held)
                logs, count = np.log10(p)[back], c[back]
                base = np.log10((count + 0.5) / (trained + 0.5 * (vocabulary + 1)))
                n = row["size"]
                sums_ = (np.bincount(owner, count > 0, n).astype(np.int32), np.bincount(owner, base, n), np.bincount(owner, logs, n))
                packed = [pa.array([x.tobytes()], pa.binary()) for x in sums_]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([n], pa.int32()), pa.array([row["facts"]], pa.binary()), *packed], PARTS
                )

    # A bucket's samples come first, each with its sums before its state.
    order = [F.col(c).asc_nulls_last() for c in ("bucket", "turn", "part")]
    schema = "block long, size int, " + ", ".join(f"{c} binary" for c in PARTS[2:])
    parts = met.repartition(buckets, "bucket").sortWithinPartitions(*order).mapInArrow(run, schema).repartition("block")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        facts: dict[int, bytes] = {}
        for batch in batches:
            for row in batch.to_pylist():
                values = [np.frombuffer(row[c], t) for c, t in zip(PARTS[3:], (np.int32, np.float64, np.float64))]
                if row["facts"] is not None:
                    facts[row["block"]] = row["facts"]
                own = sums.get(row["block"])
                sums[row["block"]] = [a + b for a, b in zip(own, values)] if own else values
        for block, (known, base, logs) in sums.items():
            n, packed = len(known), facts[block]
            ids, counts = np.frombuffer(packed, np.int64, 2 * n).reshape(2, n)
            held, null = np.frombuffer(packed, bool, 2 * n, 16 * n).reshape(2, n)
            columns = [pa.array(ids, mask=null), *(pa.array(x) for x in (held, counts, known.astype(np.int64), base, logs))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    out = parts.mapInArrow(total, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(trained).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


PARTS = ["block", "size", "facts", "known", "base", "score"]
