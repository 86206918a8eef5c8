"""Alignment of two tokenizers over the same bytes, by a monoid of fragments.

A byte-level vocabulary A encodes a space and the text, a piece vocabulary B the
text (it puts the space itself). Byte offsets at which tokens of both end cut the
text into groups; an A and a B token are linked where their byte ranges overlap.

**Fragments.** A byte range of a text gives a fragment: the open prefix (tokens up
to the first common end), the closed groups (their text, their linked id pairs
with counts) and the open suffix (tokens after the last common end). ``combine``
joins two neighbours: the left suffix and the right prefix make one more closed
group. It is associative and ``Fragment()`` is neutral, so the fragments of a long
text are composed by a tree of grouped reductions, ``FAN`` at a time, over as
many Spark tasks as the text has ranges; the result does not depend on the cuts.

**Ranges.** A text below ``CHUNK`` bytes is cut at its safe spaces (below), where
both tokenizers cut: each segment is a fragment closed on both sides, made once by
a worker and composed for every text that holds it. A text beyond ``CHUNK`` bytes is dealt out by ranges of that size. A
task encodes its range from the last safe cut before it to the first one after:
a space between two printable ASCII characters. There no token of A (its words
take a space only in front) and no piece of B (``▁`` stands only in front of a
piece) crosses, so both encode as in the whole text. Without such a cut the
window grows, to the whole text if need be: results never depend on it.

**Counts.** How many texts hold a linked pair is counted over all rows. Texts are
kept in blocks with their distinct pairs, so a pair that is in every text reaches
the shuffle once a block. A block is stored as rows of a pair or a text each; the
counts are sorted in front of the block's texts, and a task holds those of one
block at a time. Nothing is broadcast and nothing is collected.

Texts that are null or empty, or whose joined token bytes of A or B differ from
the space and the text, have no tokens: zeros and an empty string. Strings of
special tokens are plain text. Rows of one id are separate texts. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from sys import getsizeof

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import stored

CHUNK = 1 << 16
FAN = 8
#: Bytes of text that are encoded at once; tokens take some hundred bytes each while encoding.
AT_ONCE = 1 << 17
#: Segments of a generation that a worker keeps, about 300 bytes each, and their bytes: segments may be long.
KNOWN, KNOWN_BYTES = 1 << 17, 1 << 26
#: Linked pairs (counted once a text) after which a block is closed.
BLOCK_PAIRS = 1 << 18
BLOCK_ROWS = 4096
_SHIFT = 32

NO_IDS = np.zeros(0, np.int64)


# ---- vocabularies ------------------------------------------------------------
def _byte_of_symbol() -> dict[str, int]:
    """Printable stand-ins of a byte-level vocabulary, by its rule: printable bytes stand for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Pair:
    """Both encoders, with the bytes and byte lengths of every id."""

    a: object
    b: object
    bytes_a: np.ndarray
    bytes_b: np.ndarray
    len_a: np.ndarray
    len_b: np.ndarray
    shown: np.ndarray  # ids as text followed by , then | then ;
    young: dict[str, Entry | tuple[()]] = field(default_factory=dict)
    old: dict[str, Entry | tuple[()]] = field(default_factory=dict)
    held: int = 0  # bytes of young


def _objects(values: list[bytes]) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


@lru_cache(maxsize=2)
def encoders(path_a: str, path_b: str) -> Pair:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    symbol = _byte_of_symbol()
    names = {i: name for name, i in a.get_vocab(with_added_tokens=True).items()}
    bytes_a = [
        bytes(symbol[c] for c in name) if all(c in symbol for c in name) else name.encode()
        for name in (names.get(i, "") for i in range(max(names) + 1))
    ]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())
    ]
    top = max(len(bytes_a), len(bytes_b))
    shown = [b"%d%s" % (i, sep) for sep in (b",", b"|", b";") for i in range(top)]
    lengths = [np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b)]
    return Pair(a, b, _objects(bytes_a), _objects(bytes_b), *lengths, _objects(shown))


# ---- the monoid --------------------------------------------------------------
@dataclass
class Tokens:
    """Ids and end offsets of both sides."""

    a: np.ndarray = field(default_factory=lambda: NO_IDS)
    ea: np.ndarray = field(default_factory=lambda: NO_IDS)
    b: np.ndarray = field(default_factory=lambda: NO_IDS)
    eb: np.ndarray = field(default_factory=lambda: NO_IDS)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.ea, self.b, self.eb

    def slice(self, a0: int, a1: int, b0: int, b1: int) -> Tokens:
        return Tokens(self.a[a0:a1], self.ea[a0:a1], self.b[b0:b1], self.eb[b0:b1])


@dataclass
class Closed:
    """Closed groups: their number, text, linked id pairs (sorted) and how often each is linked."""

    n_groups: int = 0
    text: bytes = b""
    pairs: np.ndarray = field(default_factory=lambda: NO_IDS)
    times: np.ndarray = field(default_factory=lambda: NO_IDS)

    def __add__(self, other: Closed) -> Closed:
        if not (self.n_groups and other.n_groups):
            return self if self.n_groups else other
        pairs, where = np.unique(np.concatenate([self.pairs, other.pairs]), return_inverse=True)
        times = np.bincount(where, np.concatenate([self.times, other.times]), len(pairs)).astype(np.int64)
        return Closed(self.n_groups + other.n_groups, self.text + b";" + other.text, pairs, times)


@dataclass
class Fragment:
    """Tokens that end in a byte range. ``cut``: the range holds a common end (or the start of the text)."""

    cut: bool = False
    prefix: Tokens = field(default_factory=Tokens)
    closed: Closed = field(default_factory=Closed)
    suffix: Tokens = field(default_factory=Tokens)


def common_ends(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of the tokens that end at a common offset."""
    if not len(t.ea) or not len(t.eb):
        return NO_IDS, NO_IDS
    near = np.minimum(np.searchsorted(t.eb, t.ea), len(t.eb) - 1)
    at = np.flatnonzero(t.eb[near] == t.ea)
    return at, near[at]


def in_order(t: Tokens, at_a: np.ndarray, at_b: np.ndarray, shown: np.ndarray) -> list[bytes]:
    """The ids as text, group by group, A before B, each followed by its separator."""
    top, n_a, n_b = len(shown) // 3, len(t.a), len(t.b)
    code = np.empty(n_a + n_b, np.int64)
    held_a, held_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    place_a = np.arange(n_a) + np.repeat(at_b - held_b + 1, held_a)
    place_b = np.arange(n_b) + np.repeat(at_a + 1, held_b)
    code[place_a], code[place_b] = t.a, t.b
    code[place_a[at_a]] += top
    code[place_b[at_b]] += 2 * top
    return shown[code].tolist()


def linked(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Ends and pairs of the pieces between neighbouring ends of either side: one for each link."""
    both = np.sort(np.concatenate([t.ea, t.eb]), kind="stable")
    ends = both[np.diff(both, append=-1) != 0]
    return ends, t.a[np.searchsorted(t.ea, ends)] << _SHIFT | t.b[np.searchsorted(t.eb, ends)]


def close(t: Tokens, at_a: np.ndarray, at_b: np.ndarray, shown: np.ndarray) -> Closed:
    """Groups of tokens whose last ends are common; ``at_a`` and ``at_b`` are the last tokens of the groups."""
    if not len(at_a):
        return Closed()
    pairs, times = np.unique(linked(t)[1], return_counts=True)
    return Closed(len(at_a), b"".join(in_order(t, at_a, at_b, shown))[:-1], pairs, times)


def fragment(t: Tokens, starts: bool, shown: np.ndarray) -> Fragment:
    """The fragment of a range's tokens; ``starts``: the range is the first of its text."""
    at_a, at_b = common_ends(t)
    if not starts and not len(at_a):
        return Fragment(prefix=t)
    a0, b0 = (0, 0) if starts else (at_a[0] + 1, at_b[0] + 1)
    a1, b1 = (at_a[-1] + 1, at_b[-1] + 1) if len(at_a) else (0, 0)
    skip = 0 if starts else 1
    inner = close(t.slice(a0, a1, b0, b1), at_a[skip:] - a0, at_b[skip:] - b0, shown)
    return Fragment(True, t.slice(0, a0, 0, b0), inner, t.slice(a1, len(t.a), b1, len(t.b)))


def combine(x: Fragment, y: Fragment, shown: np.ndarray) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if not x.cut:
        return Fragment(y.cut, x.prefix + y.prefix, y.closed, y.suffix)
    if not y.cut:
        return Fragment(True, x.prefix, x.closed, x.suffix + y.prefix)
    middle, one = x.suffix + y.prefix, Closed()
    if len(middle.a):
        one = close(middle, np.array([len(middle.a) - 1]), np.array([len(middle.b) - 1]), shown)
    return Fragment(True, x.prefix, x.closed + one + y.closed, y.suffix)


# ---- encoding ----------------------------------------------------------------
def windows(body: bytes, chunk: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, stop, low, high) of each range: the window to encode, and the range (low, high] of token ends."""
    data = np.frombuffer(body, np.uint8)
    shown = (data > 32) & (data < 127)
    cuts = np.flatnonzero((data[1:-1] == 32) & shown[:-2] & shown[2:]) + 1
    for low in range(0, len(body), chunk):
        high = min(low + chunk, len(body))
        before, after = np.searchsorted(cuts, low, side="right") - 1, np.searchsorted(cuts, high)
        yield (
            int(cuts[before]) if before >= 0 else 0,
            int(cuts[after]) if after < len(cuts) else len(body),
            low,
            high,
        )


#: A space that is not between printable ASCII characters, letters or digits.
_UNSAFE = re.compile(r"(?<![!-~\w]) | (?![!-~\w])")


def _safe(c: str) -> bool:
    return "!" <= c <= "~" or c == "_" or c.isalnum()


def segments(text: str) -> list[str]:
    """The text cut at its safe spaces, which are left out."""
    if not _UNSAFE.search(text):
        return text.split(" ")
    unsafe = {m.start() for m in _UNSAFE.finditer(text)}
    cuts = [-1, *(m.start() for m in re.finditer(" ", text) if m.start() not in unsafe), len(text)]
    return [text[i + 1 : j] for i, j in zip(cuts, cuts[1:])]


def encode(body: bytes, v: Pair) -> Tokens | None:
    """Tokens of a string that begins with a space; None where the bytes of a side differ."""
    text = body.decode(errors="replace")
    a = np.array(v.a.encode(text, add_special_tokens=False).ids, np.int64)
    b = np.array(v.b.encode(text[1:]), np.int64)
    same = b"".join(v.bytes_a[a].tolist()) == body and b"".join(v.bytes_b[b].tolist()) == body
    return Tokens(a, np.cumsum(v.len_a[a]), b, np.cumsum(v.len_b[b])) if same else None


#: A segment's n_a, n_b and n_groups (24 bits each in one number), text, and pairs (one for each link, as bytes).
Entry = tuple[int, bytes, bytes]
_FIELD = 24


def _entry(t: Tokens, v: Pair) -> Entry:
    at = common_ends(t)
    return _packed(len(t.a), len(t.b), len(at[0])), b"".join(in_order(t, *at, v.shown))[:-1], linked(t)[1].tobytes()


def _packed(n_a: int, n_b: int, n_groups: int) -> int:
    return n_a | n_b << _FIELD | n_groups << 2 * _FIELD


def _bytes(segment: str, entry: Entry | tuple[()]) -> int:
    """Memory of a kept segment, its place in the table included."""
    return getsizeof(segment) + getsizeof(entry) + sum(map(getsizeof, entry)) + 100


def _learn(new: list[str], v: Pair) -> None:
    """Put the closed fragments of segments into ``v.young``; empty where the bytes of a side differ.

    Segments with safe characters at both ends are encoded as one text and cut
    again at their ends, where tokens of both sides end.
    """
    plain = [x for x in new if x and _safe(x[0]) and _safe(x[-1])]
    t = encode((" " + " ".join(plain)).encode(), v) if plain else None
    if t is not None:
        ends = np.cumsum([len(x.encode()) + 1 for x in plain])
        at_a, at_b = common_ends(t)
        shown = in_order(t, at_a, at_b, v.shown)
        cell_ends, pairs = linked(t)
        data = pairs.tobytes()
        upto = (np.searchsorted(x, ends, side="right").tolist() for x in (t.ea, t.eb, t.ea[at_a], cell_ends))
        a0 = b0 = g0 = c0 = 0
        for x, a1, b1, g1, c1 in zip(plain, *upto):
            text = b"".join(shown[a0 + b0 : a1 + b1])[:-1]
            v.young[x] = _packed(a1 - a0, b1 - b0, g1 - g0), text, data[8 * c0 : 8 * c1]
            a0, b0, g0, c0 = a1, b1, g1, c1
    for x in new:
        if x not in v.young:
            one = encode((" " + x).encode(), v)
            v.young[x] = () if one is None else _entry(one, v)


def closed_texts(texts: list[str], v: Pair) -> Iterator[tuple[int, int, Closed] | None]:
    """(n_a, n_b, groups) of whole texts, composed of the closed fragments of their segments.

    Both sides cut at a safe space, so a segment's fragment is closed on both
    sides and is made once. Two generations of about ``KNOWN`` segments or
    ``KNOWN_BYTES`` are kept: when the young one is full it becomes the old one, and
    only what is used again returns from there.
    """
    cut = [segments(x) for x in texts]
    if len(v.young) > KNOWN or v.held > KNOWN_BYTES:
        v.old, v.young, v.held = v.young, {}, 0
    young, old = v.young, v.old
    parts = [list(map(young.get, t)) for t in cut]
    missing = {x for t, held in zip(cut, parts) if None in held for x, p in zip(t, held) if p is None}
    young |= {x: old[x] for x in missing if x in old}
    new = [x for x in missing if x not in old]
    if new:
        _learn(new, v)
    v.held += sum(_bytes(x, young[x]) for x in missing)
    for t, held in zip(cut, parts):
        held = [young[x] if p is None else p for x, p in zip(t, held)]
        if not all(held):
            yield None
            continue
        numbers, shown, links = zip(*held)
        total, mask = sum(numbers), (1 << _FIELD) - 1
        pairs, times = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
        closed = Closed(total >> 2 * _FIELD, b";".join(shown), pairs, times)
        yield total & mask, total >> _FIELD & mask, closed


def inside(t: Tokens, start: int, low: int, high: int) -> Tokens:
    """Tokens that end in (low, high], with offsets in the whole text."""
    ea, eb = t.ea + start, t.eb + start
    (a0, a1), (b0, b1) = np.searchsorted(ea, [low, high], "right"), np.searchsorted(eb, [low, high], "right")
    return Tokens(t.a[a0:a1], ea[a0:a1], t.b[b0:b1], eb[b0:b1])


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string,"
    " pairs array<long>, times array<int>"
)
FRAGMENT = (
    "uid long, doc_id long, k long, valid boolean, n_a long, n_b long, cut boolean, n_groups long, text binary,"
    " pairs array<long>, times array<long>,"
    + ",".join(f"{side}_{c} array<long>" for side in ("prefix", "suffix") for c in ("a", "ea", "b", "eb"))
)
_SIDES = ("a", "ea", "b", "eb")


def _aligned_row(doc_id, valid: bool, n_a: int, n_b: int, c: Closed, texts: bool) -> dict:
    if not valid or not n_a:
        n_a, n_b, c = 0, 0, Closed()
    return {
        "doc_id": doc_id,
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": c.n_groups,
        "n_links": int(c.times.sum()),
        "groups_sha256": hashlib.sha256(c.text).hexdigest() if n_a else "",
        "groups": c.text.decode() if texts else None,
        "pairs": c.pairs,
        "times": c.times,
    }


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}

    def kind(name: str) -> pa.DataType:
        return pa.list_(kinds[name[6:-1]]) if name.startswith("array<") else kinds[name]

    return pa.schema([(n, kind(k)) for n, k in (part.split() for part in ddl.split(","))])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to rows that fit into memory while they are encoded."""
    for batch in batches:
        at = 0
        sizes = np.cumsum(np.fromiter((len(x.as_buffer()) if x.is_valid else 0 for x in batch.column("body")), np.int64, len(batch)))
        while at < len(batch):
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + AT_ONCE, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _short(path_a: str, path_b: str, texts: bool):
    """Texts of one range each: whole and closed from the start."""

    def run(batches):
        v, schema = encoders(path_a, path_b), _schema(ALIGNED)
        for batch in _pieces(batches):
            ids, bodies = batch.column("doc_id").to_pylist(), batch.column("body").to_pylist()
            found = closed_texts([(x or b"").decode(errors="replace") for x in bodies], v)
            rows = []
            for doc_id, body, one in zip(ids, bodies, found):
                n_a, n_b, closed = one if one is not None and body else (0, 0, Closed())
                rows.append(_aligned_row(doc_id, n_a > 0, n_a, n_b, closed, texts))
            yield _batch(rows, schema)

    return run


RANGE = "uid long, doc_id long, k long, start long, low long, high long, body binary"


def _ranges(chunk: int):
    """Long texts dealt out by byte ranges, each with the window it is encoded in."""

    def run(batches):
        schema = _schema(RANGE)
        for batch in batches:
            for uid, doc_id, body in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "body"))):
                body = b" " + body
                for k, (start, stop, low, high) in enumerate(windows(body, chunk)):
                    row = dict(uid=uid, doc_id=doc_id, k=k, start=start, low=low, high=high, body=body[start:stop])
                    yield _batch([row], schema)

    return run


def _as_row(uid, doc_id, k, valid, n_a, n_b, part: Fragment) -> dict:
    row = dict(uid=uid, doc_id=doc_id, k=k, valid=valid, n_a=n_a, n_b=n_b, cut=part.cut, n_groups=part.closed.n_groups)
    row |= dict(text=part.closed.text, pairs=part.closed.pairs, times=part.closed.times)
    for side, t in (("prefix", part.prefix), ("suffix", part.suffix)):
        row |= {f"{side}_{c}": x for c, x in zip(_SIDES, t.parts())}
    return row


def _of_row(row: dict) -> Fragment:
    sides = [Tokens(*(np.array(row[f"{side}_{c}"], np.int64) for c in _SIDES)) for side in ("prefix", "suffix")]
    closed = Closed(row["n_groups"], bytes(row["text"]), np.array(row["pairs"], np.int64), np.array(row["times"], np.int64))
    return Fragment(bool(row["cut"]), sides[0], closed, sides[1])


def _fragments(path_a: str, path_b: str):
    """One fragment for each byte range."""

    def run(batches):
        v, schema = encoders(path_a, path_b), _schema(FRAGMENT)
        for batch in _pieces(batches):
            rows = batch.to_pylist()
            out = []
            for r in rows:
                t = encode(r["body"], v)
                held = inside(t, r["start"], r["low"], r["high"]) if t is not None else Tokens()
                part = fragment(held, r["k"] == 0, v.shown)
                out.append(_as_row(r["uid"], r["doc_id"], r["k"], t is not None, len(held.a), len(held.b), part))
            yield _batch(out, schema)

    return run


def _reduced(path_a: str, path_b: str):
    """Neighbouring fragments of one text composed to one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shown = encoders(path_a, path_b).shown
        parts = rows.sort_values("k").to_dict("records")
        whole = reduce(lambda x, y: combine(x, y, shown), map(_of_row, parts))
        first = parts[0]
        row = _as_row(
            first["uid"], first["doc_id"], first["k"] // FAN, all(p["valid"] for p in parts),
            sum(p["n_a"] for p in parts), sum(p["n_b"] for p in parts), whole,
        )
        return pd.DataFrame([row]).astype({"doc_id": "Int64"})

    return run


def _finished(texts: bool):
    def run(batches):
        schema = _schema(ALIGNED)
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch([_aligned_row(r["doc_id"], r["valid"], r["n_a"], r["n_b"], _of_row(r).closed, texts)], schema)

    return run


def _sides(docs: DataFrame, path_a: str, path_b: str, doc_id: str, text: str, chunk: int, texts: bool) -> list[tuple]:
    """(rows, function to ``ALIGNED``) of the short and, if there are any, of the long texts."""
    bodies = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    is_long = F.coalesce(F.octet_length("body") >= chunk, F.lit(False))
    short = bodies.where(~is_long), _short(path_a, path_b, texts)
    # Written, because ids made while reading must not change when a task is run again.
    ranges = stored(
        bodies.where(is_long).withColumn("uid", F.monotonically_increasing_id()).mapInArrow(_ranges(chunk), RANGE), "ranges"
    )
    most = ranges.agg(F.max("k")).first()[0]
    if most is None:
        return [short]
    parts = ranges.repartition("uid", "k").mapInArrow(_fragments(path_a, path_b), FRAGMENT)
    while most > 0:
        above = F.expr(f"k div {FAN}").alias("above")
        parts = parts.groupBy("uid", above).applyInPandas(_reduced(path_a, path_b), FRAGMENT)
        most //= FAN
    return [short, (parts, _finished(texts))]


def align(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK, texts: bool = True
) -> DataFrame:
    """One row a text: token, group and link counts, the groups, and its distinct linked pairs with how often each is linked.

    A pair is ``A id << 32 | B id``. Without ``texts`` the column ``groups`` is null.
    """
    sides = _sides(docs, path_a, path_b, doc_id, text, chunk, texts)
    return reduce(DataFrame.unionByName, (rows.mapInArrow(run, ALIGNED) for rows, run in sides))


# ---- counts over all texts ---------------------------------------------------
MEMBER = "doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,at:array<int>,times:array<int>"
#: A row is a distinct pair of a block, or, after its pairs, one of its texts.
BLOCK = f"block long, at int, pair long, holders int, member struct<{MEMBER}>"
_PLAIN = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row lengths of a list column."""
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _list_of(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _blocks(batches):
    """Rows gathered into blocks that name each distinct pair once, as rows of a pair or a text each."""
    number = TaskContext.get().partitionId() << _SHIFT

    def rows_of(n: int, at: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
        columns |= {"block": pa.array(np.full(n, number)), "at": pa.array(at, pa.int32())}
        kinds = {"pair": pa.int64(), "holders": pa.int32(), "member": members_type}
        names = ["block", "at", *kinds]
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, kinds[c]) for c in names], names)

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        column = {c: rows.column(c).chunk(0) for c in rows.column_names}
        values, lengths = _flat(column["pairs"])
        pairs, at, holders = np.unique(values, return_inverse=True, return_counts=True)
        lists = [_list_of(pa.array(at, pa.int32()), lengths), _list_of(column["times"].flatten(), lengths)]
        members = pa.StructArray.from_arrays([*(column[c] for c in _PLAIN), *lists], [*_PLAIN, "at", "times"])
        n, m = len(pairs), len(members)
        if n:
            yield rows_of(n, np.arange(n), pair=pa.array(pairs, pa.int64()), holders=pa.array(holders, pa.int32()))
        yield rows_of(m, np.arange(n, n + m), member=members)

    plain = [pa.int64()] * 5 + [pa.string()] + [pa.list_(pa.int32())] * 2
    members_type = pa.struct(list(zip([*_PLAIN, "at", "times"], plain)))
    held, pairs, n = [], 0, 0
    for batch in batches:
        sizes = batch.column("pairs").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at = 0
        for k in range(len(batch)):
            pairs, n = pairs + int(sizes[k]), n + 1
            if pairs >= BLOCK_PAIRS or n >= BLOCK_ROWS:
                yield from block(pa.Table.from_batches([*held, batch.slice(at, k + 1 - at)]))
                number, held, pairs, n, at = number + 1, [], 0, 0, k + 1
        if at < len(batch):
            held.append(batch.slice(at))
    if held:
        yield from block(pa.Table.from_batches(held))


WEIGHED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _weighed(batches):
    """Texts of the blocks with their links weighed by the counts of the block's pairs, which come before them."""
    names = [part.split()[0] for part in WEIGHED.split(", ")]
    open_block, counts = None, []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = (np.flatnonzero(np.diff(blocks)) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, len(batch)]):
            if low == high:
                continue
            if blocks[low] != open_block:
                open_block, counts = blocks[low], []
            rows = batch.slice(low, high - low)
            of_pairs = rows.column("member").null_count
            if of_pairs:
                weights = (rows.column(c).slice(0, of_pairs).cast(pa.int64()) for c in ("best", "n"))
                counts.append(np.stack([w.to_numpy(zero_copy_only=False) for w in weights]))
            if of_pairs == len(rows):
                continue
            counts = [np.concatenate(counts, axis=1)] if counts else [np.zeros((2, 0), np.int64)]
            members = rows.column("member").slice(of_pairs)
            fields = dict(zip([f.name for f in members.type], members.flatten()))
            at, lengths = _flat(fields["at"])
            times = fields["times"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            for name, weight in zip(("n_best", "count_sum"), counts[0]):
                upto = np.concatenate([[0], np.cumsum(weight[at] * times)])
                fields[name] = pa.array(upto[ends] - upto[ends - lengths], pa.int64())
            yield pa.RecordBatch.from_arrays([fields[c] for c in names], names)


def weigh(blocked: DataFrame) -> DataFrame:
    """Texts of ``_blocks`` with ``n_best`` and ``count_sum`` over the counts of all texts.

    ``n_best``: links whose pair is held by the most texts among the pairs of its
    A id, ties included. ``count_sum``: the pair's count, summed over links.
    """
    blocks = stored(blocked, "blocks")
    named = blocks.where(F.col("pair").isNotNull()).select("block", "at", "pair", "holders")
    counts = stored(named.groupBy("pair").agg(F.sum("holders").alias("n")), "pairs")
    a_id = F.shiftright("pair", _SHIFT)
    tops = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("top"))
    weights = counts.withColumn("a", a_id).join(tops, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    known = named.join(weights, "pair").select("block", "at", "n", F.col("best").cast("int"), none("member", f"struct<{MEMBER}>"))
    texts = blocks.where(F.col("member").isNotNull()).select("block", "at", none("n", "long"), none("best", "int"), "member")
    ordered = known.unionByName(texts).repartition("block").sortWithinPartitions("block", "at")
    return ordered.mapInArrow(_weighed, WEIGHED)


def alignment(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Counts of every text against the counts of all texts.

    Texts are aligned and gathered into blocks by one worker, so that one holds the encoders, not two.
    """

    def in_blocks(run):
        return lambda batches: _blocks(run(batches))

    sides = _sides(docs, path_a, path_b, doc_id, text, chunk, texts=False)
    return weigh(reduce(DataFrame.unionByName, (rows.mapInArrow(in_blocks(run), BLOCK) for rows, run in sides)))
