"""Alignment of two tokenizers against a plain two-pointer version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stintframe.llm import alignment as al
from stintframe.llm.queries import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def by_force(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha) of every row."""
    v, held = al.encoders(A, B), []
    for doc_id, text in rows:
        body = (" " + (text or "")).encode()
        a = v.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = v.b.encode(text or "")
        sides = [[table[i] for i in ids] for table, ids in ((v.bytes_a, a), (v.bytes_b, b))]
        if not text or any(b"".join(s) != body for s in sides):
            held.append((doc_id, 0, 0, 0, [], ""))
            continue
        spans = []
        for side in sides:
            ends = np.cumsum([len(x) for x in side]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links = [(a[i], b[j]) for i, (p, q) in enumerate(spans[0]) for j, (r, s) in enumerate(spans[1]) if p < s and r < q]
        groups, start = [], 0
        for end in sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]}):
            parts = [[str(i) for i, s in zip(ids, sp) if start < s[1] <= end] for ids, sp in ((a, spans[0]), (b, spans[1]))]
            groups.append("|".join(map(",".join, parts)))
            start = end
        held.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(p for h in held for p in set(h[4]))
    top = defaultdict(int)
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    return [
        (*h[:4], len(h[4]), sum(counts[p] == top[p[0]] for p in h[4]), sum(counts[p] for p in h[4]), h[5]) for h in held
    ]


ODD = [
    None, "", " ", "  lead", "trail  \n", "a", "<s> and </s> and <|endoftext|>", "▁ literal", "naïve café ﬁ é 日本語のテキスト 🙂🙃",
    "tab\tand\x0bvertical\r\n", "x" * 900, "don't  stop   now", " nbsp em", "the\x00nul", "the the the the",
]


def texts(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = "alpha beta gamma straße Ünïcode 12,345.67 l'été re-use http://x.y/z?q=1 العربية".split()
    out = [" ".join(rng.choice(words) + rng.choice(["", ".", "\n", "  "]) for _ in range(rng.randrange(1, 120))) for _ in range(n)]
    out += ODD + ["hot text of many rows"] * n + ["one " * 700, "日本" * 500]
    return list(enumerate(out)) + [(3, "repeated id"), (None, "no id"), (None, None)]


def found(spark, rows, chunk, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    out = al.alignment(docs, A, B, chunk=chunk)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(repr, (tuple(r[c] for c in names) for r in out.collect())))


@pytest.mark.parametrize("chunk, parts", [(1 << 16, 3), (64, 5), (7, 2)])
def test_alignment_equals_brute_force_for_every_range_size(spark, monkeypatch, chunk, parts):
    monkeypatch.setattr(al, "BLOCK_ROWS", 9)
    monkeypatch.setattr(al, "KNOWN", 20)
    rows = texts(12, chunk)
    assert found(spark, rows, chunk, parts) == sorted(map(repr, by_force(rows)))


def flat(f: al.Fragment) -> tuple:
    closed = f.closed
    sides = [x.tolist() for t in (f.prefix, f.suffix) for x in t.parts()]
    return f.cut, closed.n_groups, closed.text, closed.pairs.tolist(), closed.times.tolist(), sides


def test_fragments_are_a_monoid():
    v, rng = al.encoders(A, B), random.Random(4)
    for seed in range(30):
        text = " " + " ".join(rng.choice(["unbelievable", "日本語", "tokenization", "x9", "é"]) for _ in range(12))
        t = al.encode(text.encode(), v)
        size = len(text.encode())
        cuts = [0, *sorted(rng.sample(range(1, size), 6)), size]
        parts = [al.fragment(al.inside(t, 0, lo, hi), lo == 0, v.shown) for lo, hi in zip(cuts, cuts[1:])]
        join = lambda x, y: al.combine(x, y, v.shown)
        left = parts[0]
        for p in parts[1:]:
            left = join(left, p)
        right = parts[-1]
        for p in parts[-2::-1]:
            right = join(p, right)
        middle = join(join(parts[0], join(parts[1], parts[2])), join(join(parts[3], parts[4]), join(parts[5], parts[6])))
        whole = al.fragment(t, True, v.shown)
        assert flat(left) == flat(right) == flat(middle) == flat(whole), seed
        none = al.Fragment()
        for p in parts:
            assert flat(join(none, p)) == flat(p) == flat(join(p, none))


def test_safe_cuts_hold_for_the_vocabulary_and_encode_alike():
    v = al.encoders(A, B)
    assert not [i for i in range(v.b.get_piece_size()) if "▁" in v.b.id_to_piece(i).lstrip("▁")]
    body = (" " + " ".join(f"word{k}, l'été 日本 (x)  y" for k in range(60))).encode()
    whole = al.encode(body, v)
    assert len(al.segments(body.decode()[1:])) > 100
    for start, stop, low, high in al.windows(body, 50):
        assert start <= low < high <= stop and body[start : start + 1] == b" "
        part = al.encode(body[start:stop], v)
        got, want = al.inside(part, start, low, high), al.inside(whole, 0, low, high)
        assert [x.tolist() for x in got.parts()] == [x.tolist() for x in want.parts()]


def test_groups_are_returned_and_other_columns_ignored(spark):
    docs = spark.createDataFrame([(1, "hello world", 5, "x")], "doc_id long, text string, pairs long, block string")
    (r,) = al.align(docs, A, B).collect()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 and r.groups.count(";") == r.n_groups - 1
    assert al.alignment(docs, A, B).first().n_links == r.n_links == sum(r.times)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert al.alignment(docs, A, B).collect() == [] and al.align(docs, A, B).collect() == []


def test_kept_segments_give_what_the_whole_text_gives(monkeypatch):
    monkeypatch.setattr(al, "KNOWN", 10)
    v = al.encoders(A, B)
    for _, text in texts(20, 3):
        text = text or ""
        (got,) = al.closed_texts([text], v)
        whole = al.encode((" " + text).encode(), v) if text else None
        if whole is None:
            assert got is None or not text
            continue
        want = al.fragment(whole, True, v.shown)
        assert got[:2] == (len(whole.a), len(whole.b)) and flat(al.Fragment(True, closed=got[2])) == flat(want)


def test_a_block_is_stored_as_rows_of_one_pair_or_one_text(spark, monkeypatch):
    """No row, and no list of a grouping, holds a whole block: its memory would grow with the blocks of a task."""
    monkeypatch.setattr(al, "BLOCK_PAIRS", 40)
    docs = spark.createDataFrame(texts(12, 1), "doc_id long, text string").repartition(2)
    blocked = al.align(docs, A, B, texts=False).mapInArrow(al._blocks, al.BLOCK)
    stored = blocked.collect()
    assert all((r.pair is None) != (r.member is None) for r in stored)
    assert sum(r.member is not None for r in stored) == docs.count() and len({r.block for r in stored}) > 8
    assert len({(r.block, r.at) for r in stored}) == len(stored)
    assert "collect_list" not in al.weigh(blocked)._jdf.queryExecution().executedPlan().toString()


def test_kept_segments_are_bounded_by_their_bytes(monkeypatch):
    monkeypatch.setattr(al, "KNOWN_BYTES", 1 << 18, raising=False)
    v, rng = al.encoders(A, B), random.Random(8)
    monkeypatch.setattr(v, "young", {})
    monkeypatch.setattr(v, "old", {})
    size = lambda held: sum(len(x) + sum(map(len, e[1:])) for x, e in held.items())
    for _ in range(60):
        text = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(2000))
        (got,) = al.closed_texts([text], v)
        assert got[:2] == tuple(len(x) for x in (lambda t: (t.a, t.b))(al.encode((" " + text).encode(), v)))
        assert size(v.young) + size(v.old) < 1 << 20
