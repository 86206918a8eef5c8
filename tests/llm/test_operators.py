"""Operators against brute force, and the edge cases of their docstrings."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from stintframe.llm import (
    fingerprints,
    hashing,
    html_text,
    jaccard,
    packing,
    passages,
    pieces,
    pitman_yor,
    quality,
    secret_scan,
    urls,
)
from stintframe.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta omega kappa sigma lambda theta zeta eta iota rho tau phi chi psi mu nu xi".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def near(text: str, seed: int, edits: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def corpus() -> list[tuple]:
    a, b = prose(1, 200), prose(2, 300)
    shared = prose(3, 60)
    texts = [a, near(a, 5, 2), a, b, near(b, 6, 4), None, "", "one two", "ONE  two", "   ", prose(4, 2500)]
    texts += [prose(10, 80) + " " + shared + " " + prose(11, 80), prose(12, 50) + " " + shared + " " + prose(13, 20)]
    texts += ["token = abcdefgh1234 and AKIA" + "Q7" * 8 + " é password: short " + "0123456789abcdef" * 2, "%%% ### &&& " * 40]
    texts += [prose(20 + k, 60) for k in range(12)]
    return [(k, t, None if k == 3 else "en", None if k == 4 else "s", len(t or "")) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_hashes_follow_words():
    texts = ["a B\tc\n", "", None, "  x", "Àé b", "B"]
    found = hashing.words(pa.array(texts))
    assert np.diff(found.first).tolist() == [3, 0, 0, 1, 2, 1]
    assert found.of(0)[1] == found.of(4)[1] == found.of(5)[0]
    assert len({int(h) for h in found.hashes}) == 5


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_jaccard_components_are_exact(docs, empty):
    rows = {r[0]: shingle_set(r[1], 4) for r in corpus()}
    root = {i: i for i in rows}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in rows:
        for j in rows:
            common = len(rows[i] & rows[j])
            if i < j and common and 100 * common >= 85 * len(rows[i] | rows[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = {r[0]: (r[1], r[2]) for r in jaccard.link_components(docs).collect()}
    assert got == {i: (len(s), find(i)) for i, s in rows.items()}
    assert got[1][1] == 0 and got[8][1] == 7 and got[5] == (0, 5)
    assert jaccard.link_components(empty).collect() == []


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for n, m, both in ((50, 60, 40), (3000, 2600, 2500), (10, 900, 9)):
        pool = rng.integers(0, 2**63, n + m, dtype=np.uint64)
        x, y = np.unique(pool[:n]), np.unique(np.r_[pool[:both], pool[n : n + m - both]])
        most = jaccard.most_common(len(x), len(y), *(np.frombuffer(jaccard.bitmap(v), np.uint64) for v in (x, y)))
        assert most >= len(np.intersect1d(x, y))


def test_tiles_in_cells_compare_the_same_pairs(spark):
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 2**63, 120, dtype=np.uint64)
    rows = []
    for sid in range(90):
        size = int(rng.choice([1, 9, 20, 22, 25, 60, 66, 100, 118]))
        tokens = np.unique(rng.choice(pool[:size], size - size // 15 * int(rng.integers(0, 3)), replace=False))
        rows.append((sid % 2 if sid < 80 else 2, sid, len(tokens), sid % 80, jaccard.bitmap(tokens)))
    whole = spark.createDataFrame(rows, "tile long, sid long, n long, root long, bits binary").repartition(5)
    tiled, marks = whole.drop("bits"), whole.select("sid", "n", "bits")
    want = set()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[1] < y[1] and x[3] != y[3] and 100 * min(x[2], y[2]) >= 85 * max(x[2], y[2]):
                most = int(jaccard.most_common(x[2], y[2], *(np.frombuffer(v[4], np.uint64) for v in (x, y))))
                if 100 * most >= 85 * (x[2] + y[2] - most):
                    want.add((x[1], y[1]))
    assert want
    for size in (1, 3, 20, jaccard.CELL_ROWS):
        assert {tuple(r) for r in jaccard.banded_pairs(tiled, marks, 85, size).collect()} == want, size
    assert jaccard.banded_pairs(tiled.limit(0), marks, 85).collect() == []


def test_open_cells_are_held_over_batches():
    cells = [5, 5, 5, 5, 5, 7, 8, 8, 8, 9]
    for size in (1, 2, 3, 10):
        batches = [pa.RecordBatch.from_arrays([pa.array(cells[k : k + size])], ["cell"]) for k in range(0, 10, size)]
        found = [t.column("cell").to_pylist() for t in jaccard.whole_cells(iter(batches))]
        assert sum(found, []) == cells
        assert all(x[-1] != y[0] for x, y in zip(found, found[1:]))
    assert list(jaccard.whole_cells(iter([]))) == []


def test_passages_find_the_planted_one(docs, empty):
    found = {(r.doc_id, r.source_id): r for r in passages.passages(docs).collect()}
    assert {(12, 11), (1, 0), (2, 0), (4, 3)} <= set(found)
    assert {d for d, _ in found} == {1, 2, 4, 12}
    span = found[12, 11]
    text = corpus()[12][1]
    assert text[span.start : span.end] == prose(3, 60) and span.n_words == span.n_equal == 60
    cut = {r.doc_id: r for r in passages.without_repeats(docs).collect()}
    assert len(cut) == len(corpus()) and cut[11].text == corpus()[11][1]
    assert cut[12].text == text.replace(prose(3, 60), "") and cut[12].n_chars == len(cut[12].text)
    assert passages.passages(empty).collect() == []


def test_fenwick_chain_is_the_best_one():
    rng = random.Random(4)
    for _ in range(50):
        points = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(12)})
        best = {}
        for i, (x, y) in enumerate(points):
            before = [best[j] - passages.GAP * (x - p + y - q) for j, (p, q) in enumerate(points[:i]) if p < x and q < y]
            best[i] = 8 + max([0.0, *before])
        top = max(best.values())
        x0, x1, y0, y1 = passages.chains_of([p[0] for p in points], [p[1] for p in points])[0]
        ends = [i for i in best if abs(best[i] - top) < 1e-9]
        assert (x1 - 8, y1 - 8) in [points[i] for i in ends] and x0 < x1 and y0 < y1


def test_secret_spans_and_redaction(docs, empty):
    row = {r.doc_id: r for r in secret_scan.digests(docs).collect()}
    text = corpus()[13][1]
    access = text.index("AKIA")
    hexes = text.index("0123456789abcdef")
    base = f"assign:0:20,access:{access}:{access + 20},hex:{hexes}:{hexes + 32}"
    assert (row[13].n_assign, row[13].n_access, row[13].n_hex) == (1, 1, 1)
    assert row[13].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and row[13].spans == base
    assert row[5].spans == row[6].spans == "" and row[5].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert clean[13] == "[SECRET] and [SECRET] é password: short [SECRET]" and clean[5] is None and clean[0] == corpus()[0][1]
    assert secret_scan.digests(empty).collect() == []


def test_window_entropy_equals_brute_force(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    names = ["".join(rng.choice(secret_scan.ALPHABET) for _ in range(rng.randrange(20, 60))) for _ in range(30)]
    weights = secret_scan.window_weights()

    def peak(s):
        windows = (s[i : i + 20] for i in range(len(s) - 19))
        least = min(sum(weights[c] for c in collections.Counter(w).values()) for w in windows)
        return round(1000 * math.log2(20)) - least // 20

    rows = spark.createDataFrame([(n,) for n in names], "s string").select("s", secret_scan.peak_entropy(F.col("s")).alias("p"))
    assert {r.s: r.p for r in rows.collect()} == {n: peak(n) for n in names}
    random_key = "f9Kq2LxZ8vTn4RbW7yHs"
    assert secret_scan.LEAST["alnum"] <= peak(random_key)


def test_quality_counts_and_fences(docs, empty):
    row = {r.doc_id: r for r in quality.verdicts(docs).collect()}
    assert row[5].n_words == 0 and row[5].base_failed and not row[14].kept
    assert all(row[k].kept for k in (0, 1, 11, 12, *range(15, 27)))
    for i, text, *_ in corpus():
        w = (text or "").split()
        grams = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {p for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        assert (row[i].n_words, row[i].n_repeat_words, row[i].word_chars) == (len(w), len(covered), sum(map(len, w)))
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in row.values())
    assert quality.verdicts(empty).collect() == []


def test_quantile_buckets_are_close(spark):
    from pyspark.sql import functions as F

    values = spark.range(0, 5000, 7).select("id", quality.bucket_floor(quality.bucket(F.col("id"))).alias("low"))
    assert all(r.low <= r.id and r.id - r.low <= r.id / 32 for r in values.collect())


def spark_sketch(text):
    w = (text or "").split()
    if not w:
        return []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    out = set()
    for i in range(max(1, len(w) - 4)):
        seed = 42
        for x in h[i : i + 5]:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed)
        out.add(seed - (1 << 64) if seed >> 63 else seed)
    return sorted(out)[: fingerprints.SIZE]


def test_fingerprints_equal_brute_force(docs, empty):
    texts = [t or "" for _, t, *_ in corpus()]
    for r in fingerprints.fingerprint_edits(docs).collect():
        a, b = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(a)
        x, y, z = spark_sketch(a), spark_sketch(edited), spark_sketch(b)
        assert r.fingerprint == ",".join(f"{v & (2**64 - 1):016x}" for v in x)
        for got, other in ((r.near_edited, y), (r.near_next, z)):
            both = sorted(set(x) | set(other))[: fingerprints.SIZE]
            want = len(set(both) & set(x) & set(other)) / len(both) if both else 1.0
            assert got == pytest.approx(want)
    assert fingerprints.fingerprint_edits(empty).collect() == []


def test_next_document_across_blocks(spark):
    ids = [0, 1, 255, 256, 70_000, 2**40, 2**40 + 1, 2**55]
    rows = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(rows).collect()}
    assert got == {i: f"t{n}" for i, n in zip(ids, ids[1:] + ids[:1])}


def test_packing_is_gapless_and_tight(docs, empty):
    from tokenizers import Tokenizer

    files = vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")
    rows = packing.pack(docs, *files).collect()
    bpe = Tokenizer.from_file(files[0])
    for i, text, *_ in corpus():
        ids = np.array(bpe.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids) and all(r.length == 2048 for r in own[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len({r.sequence_id for r in rows}) <= 1 + -(-sum(r.length for r in rows) // 2048)
    assert packing.pack(empty, *files).collect() == []


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    files = vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")
    bpe, own = Tokenizer.from_file(files[0]), packing.Encoder(*files)
    rng = random.Random(3)
    parts = ["a", "Wort", " ", "  ", "\n", "\t", "'s", "é", "12", "<|endoftext|>", "!?", " ", "日本", "_x", "\r\n"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert own.encode(text) == np.array(bpe.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_crossover_keeps_every_item():
    rng = random.Random(7)
    lengths = [rng.randrange(1, 900) for _ in range(300)]
    people = packing._founders(lengths, 2048, rng)
    best = packing.evolve(people, lengths, 2048, rng)[0]
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in best)
    assert len(best) <= min(len(p) for p in people)


def test_language_model(docs, empty):
    rows = corpus()
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for r in pitman_yor.score(docs).collect():
        ws = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(ws), n, held[r.doc_id])
        assert r.n_known == sum(counts[w] > 0 for w in ws) and r.base_score == pytest.approx(base)
        assert r.score < 0
    assert pitman_yor.score(empty).collect() == []


def test_passages_whose_parts_have_other_first_holders(spark, empty):
    """Documents 1 and 2 hold half of a passage each, too short to count; 3 and 4 hold all of it."""
    shared = prose(700, 90).split(" ")
    texts = {1: shared[:45], 2: shared[45:], 3: shared, 4: shared}
    rows = [(i, " ".join([prose(710 + i, 40), *part, prose(720 + i, 40)])) for i, part in texts.items()]
    found = passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.source_id, r.n_words, r.n_equal) for r in found] == [(4, 3, 90, 90)]
    begin, end = (len(prose(714, 40)) + 1, len(prose(714, 40)) + 1 + len(" ".join(shared)))
    assert (found[0].start, found[0].end) == (begin, end)


def test_matches_of_repeated_seeds_against_brute_force(spark):
    rng = random.Random(5)
    rows = sorted({(rng.randrange(6), rng.randrange(5), rng.randrange(40)) for _ in range(150)})
    want = set()
    for seed, doc, pos in rows:
        holders = {d: sorted(p for s, e, p in rows if (s, e) == (seed, d)) for d in {e for s, e, _ in rows if s == seed}}
        first = min(holders)
        if doc > first:
            k = holders[doc].index(pos)
            prior = max(d for d in holders if d < doc)
            want |= {(doc, pos, first, holders[first][0]), (doc, pos, first, holders[first][k % len(holders[first])])}
            want.add((doc, pos, prior, holders[prior][0]))
    # Rows of unlike seeds at one place may coincide, so they are compared as sets and counted per seed.
    table = spark.createDataFrame(rows, "seed long, doc_id long, pos int")
    assert {tuple(r) for r in passages.matches(table).collect()} == want


def test_every_preceding_word_has_a_restaurant(spark):
    """Each of 1500 words is followed by its own word in half of the texts; none of them shares a restaurant."""
    pairs = [(k, v) for k in range(1500) for v in (f"next{k}", f"other{k % 7}")]
    rows = [(i, " ".join(f"word{k} {v}" for k, v in pairs[j : j + 3]) + " fin") for i, j in enumerate(range(0, 3000, 3))]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1}
    # One held-out text per word: only the word's own restaurant tells its follower from another word's.
    out = next(i for i in range(5000, 9000) if zlib.crc32(str(i).encode()) % 5 == 1)
    ids = [i for i in range(out, 90000) if zlib.crc32(str(i).encode()) % 5 == 1]
    trained = [k for k, (w, v) in enumerate(pairs) if k // 3 not in held and v.startswith("next")]
    asked = [pairs[k][0] for k in trained]
    right = [(i, f"word{k} next{k}") for i, k in zip(ids, asked)]
    wrong = [(i, f"word{k} next{m}") for i, k, m in zip(ids[len(asked) :], asked, asked[1:] + asked[:1])]
    table = spark.createDataFrame(rows + right + wrong, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in pitman_yor.score(table).collect()}
    gains = [got[a] - got[b] for (a, _), (b, _) in zip(right, wrong)]
    assert len(gains) > 1100 and min(gains) > 0.5


def test_pair_counts_are_summed_and_packed():
    """Counts of one word and context meet; held-out pairs stay without customers; numbers keep their value in two or four bytes."""
    token, context = np.array([5, 5, 9], np.uint64) << np.uint64(10), np.array([0, 7, 7], np.uint64) << np.uint64(10)
    a = pitman_yor._summed(np.r_[token, token], np.r_[context, context], np.array([1, 2, 0, 1, 0, 4]))
    assert [x.tolist() for x in a] == [(token).tolist(), context.tolist(), [2, 2, 4]]
    for top in (3, 40000):
        numbers = np.array([0, top, 1])
        assert pitman_yor.widened(pitman_yor.narrow(numbers), 3).tolist() == numbers.tolist()


def test_predictive_probabilities_sum_to_one():
    token = np.array([1024, 2048, 3072], np.uint64)
    row = dict(zip(pitman_yor.STATE_COLUMNS, (
        token.tobytes(), np.array([2, 1, 1], np.int32).tobytes(), np.array([0, 1, 1, 0], np.int16).tobytes(),
        np.array([5, 2, 3, 1], np.int32).tobytes(), np.array([2, 1, 2, 1], np.int32).tobytes(),
        np.zeros(4, np.float32).tobytes(), np.array([2, 1, 1], np.int32).tobytes())))
    totals = {"customers": np.array([6.0, 5.0, 6.0]), "tables": np.array([3.0, 3.0, 4.0])}
    for context in (0, 1):
        every = np.array([1024, 2048, 3072, 9216], np.uint64)
        p, c = pitman_yor.predictive(row, every, np.full(4, context), totals, (0.5, 0.4), 3)
        assert p.sum() == pytest.approx(1.0) and c.tolist() == [7, 3, 1, 0]


def test_url_rules_and_segments(spark):
    lines = [
        (1, "http://a.example.net/en/x"), (2, "http://b.net/de/"), (3, "HTTP://WWW.Example.com/de/1?x#y"), (4, "http://x.org/fr/1"),
        (5, "http://x.org"), (6, None), (7, "no scheme"), (8, "http://casino.example.com/en/2"), (9, "http://notnet/"), (10, "ftp://net/"),
        (11, "http://net"),
    ]
    text = "<p>" + "cheap spam farm news daily " * 30 + "</p>"
    pages = spark.createDataFrame([(i, u, text) for i, u in lines], "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.verdicts(pages).collect()}
    rule = {i: r.rule for i, r in got.items()}
    assert rule == {1: "example.net/en/", 2: "net/", 3: "example.com/de/", 4: "org/fr/", 5: None, 6: None, 7: None, 8: None, 9: None, 10: "net/", 11: None}
    assert [got[k].verdict for k in (1, 2, 3, 4, 8)] == ["allow", "block", "block", "allow", "block"]
    assert (got[3].host, got[3].path, got[6].host, got[5].path) == ("www.example.com", "/de/1", "", "")
    weights = {w: math.log10(9 / 100) for w in ("cheap", "spam", "news", "new")}
    assert urls.split_name("cheapspamnews", weights, 100) == ["cheap", "spam", "news"]
    assert urls.verdicts(pages.limit(0)).collect() == []


def test_main_text_of_pages(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><header>Top</header><nav><ul><li><a href=x>Menu</a>"
        "</ul></nav><div class='ad'>Buy</div><div class='content'><article><h1>Head &amp; tail</h1><p>First,  one\nand &lt;two&gt;, <b>three.<br>"
        "<p>Second &eacute; " + "text " * 30 + "</article><div id='comments'><p>" + "reader words, many, " * 20 + "</div></div>"
        "<aside><p>Side</p></aside><form><p>Form</p></form><footer>&copy; x</footer><script>unclosed"
    )
    want = "Head & tail\n\nFirst, one and <two>, three.\n\nSecond é " + ("text " * 30).strip()
    assert html_text.main_text(page) == want
    rows = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p>cut <b")], "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(rows).collect()}
    assert got == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("cut", 3)}


def test_pieces_equal_brute_force_and_round_trip(spark):
    model = vocabulary("piece_bpe_32k.model")
    table = pieces.piece_table(spark, model).collect()
    scores = {r.piece: (r.score, r.id) for r in table if r.byte is None}
    byte_ids = {r.byte: r.id for r in table if r.byte is not None}

    def viterbi(word):
        best = [(0.0, [])]
        for e in range(1, len(word) + 1):
            options = [(best[e - 1][0] + pieces.UNKNOWN, -(e - 1), best[e - 1][1] + [byte_ids[b] for b in word[e - 1].encode()])]
            for s in range(max(0, e - 16), e):
                if word[s:e] in scores:
                    score, i = scores[word[s:e]]
                    options.append((best[s][0] + score, -s, best[s][1] + [i]))
            top = max(options, key=lambda x: x[:2])
            best.append((top[0], top[2]))
        return best[-1][1]

    texts = ["hello world", " two  spaces ", "line\n\tbreak", "日本語 🙂 é", "", None, "x" * 450 + "y z", "the The"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    encoded = pieces.encode(rows, model, ["k"])
    for r in pieces.decode(encoded, model, ["k"]).collect():
        text = texts[r.k] or ""
        marked = ("▁" + text.replace(" ", "▁")) if text else ""
        words = ["▁" + w for w in marked.split("▁")[1:]]
        assert r.ids == [i for w in words for i in viterbi(w)] and r.decoded == text
    assert pieces.encode(rows.limit(0), model, ["k"]).collect() == []


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, "")
        assert step.columns == docs.columns, name
    kept = {r.doc_id: r.text for r in step.collect()}
    assert {0, 3, 11, 12, 15} <= set(kept) and not {1, 2, 5, 6, 14} & set(kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, step, "")
    assert {r.doc_id for r in packed.collect()} == set(kept)


def clashing(docs):
    """Columns named like those the operators work with, and a row without an id."""
    from pyspark.sql import functions as F

    wide = docs.selectExpr("*", "-doc_id as n_words", "'b' as base", "'s' as spans", "'k' as kept", "'l' as __lang", "'m' as m_symbols", "7L as start", "9L as n")
    return wide.withColumn("doc_id", F.when(F.col("doc_id") != 26, F.col("doc_id")))


@pytest.mark.parametrize(
    "stage", [quality.kept_documents, secret_scan.redact, jaccard.first_of_groups, passages.without_repeats]
)
def test_stages_keep_columns_of_any_name(docs, stage):
    wide = clashing(docs)
    plain = {r.doc_id: r.text for r in stage(docs).collect()}
    got = stage(wide)
    assert got.columns == wide.columns and dict(got.dtypes) == dict(wide.dtypes)
    rows = got.collect()
    assert {26 if r.doc_id is None else r.doc_id: r.text for r in rows} == plain and len(rows) == len(plain)
    assert all((r.base, r.spans, r.kept, r["__lang"], r.m_symbols, r.start, r.n) == ("b", "s", "k", "l", "m", 7, 9) for r in rows)
    assert all(r.n_words == (-26 if r.doc_id is None else -r.doc_id) for r in rows)


def test_stages_leave_no_copies_of_the_texts(docs, spark):
    """The shared folder holds no texts of the documents after a stage."""
    import glob

    from stintframe.session import scratch_root

    root = scratch_root(spark).removeprefix("file:")
    for stage in (quality.kept_documents, jaccard.first_of_groups):
        before = set(glob.glob(f"{root}/stintframe-*"))
        assert stage(docs).count()
        for path in set(glob.glob(f"{root}/stintframe-*")) - before:
            assert not {"text", "__row"} & set(spark.read.parquet(path).columns), path


def test_cut_texts_join_stored_spans(docs):
    """Seeds and chains are not part of the job that cuts the texts."""
    plan = passages.without_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "BroadcastHashJoin" in plan


def test_rows_of_one_id_keep_their_texts(docs, spark):
    shared = prose(3, 60)
    extra = [(12, prose(60, 30), "en", "s", 0), (None, shared, "en", "s", 0)]
    got = passages.without_repeats(docs.unionByName(spark.createDataFrame(extra, SCHEMA))).collect()
    assert sorted(r.text for r in got if r.doc_id == 12) == sorted([corpus()[12][1], prose(60, 30)])
    assert [r.text for r in got if r.doc_id is None] == [shared]
    assert {r.doc_id: r.text for r in got}[1] != corpus()[1][1]


def test_rows_of_one_id_or_none_are_grouped_by_their_texts(spark):
    a, b, c, d = (prose(800 + i, 90) for i in range(4))
    rows = [(1, a), (1, a), (None, a), (None, near(a, 9, 1)), (None, b), (None, b), (2, c), (2, d), (4, near(d, 3, 1))]
    rows += [(3, ""), (None, ""), (None, None), (None, None)]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    got = sorted(((r.doc_id, r.text) for r in jaccard.first_of_groups(table).collect()), key=repr)
    stay = [(1, a), (None, b), (2, c), (2, d), (3, ""), (None, ""), (None, None), (None, None)]
    assert got == sorted(stay, key=repr)


def test_quality_sketches_of_parts_merge(docs):
    """Sketches of any split of the rows add up to the sketch of all."""
    from pyspark.sql import functions as F

    measured = quality.measure(docs.withColumns({"__lang": F.col("lang"), "__source": F.col("source")}))
    keys = ["__lang", "__source", "rule", "bucket"]
    parts = quality.sketches(measured.where("doc_id % 3 = 0")).unionByName(quality.sketches(measured.where("doc_id % 3 > 0")))
    merged = parts.groupBy(*keys).agg(F.sum("n").alias("n"))
    as_set = lambda df: {tuple(r) for r in df.select(*keys, "n").collect()}
    assert as_set(merged) == as_set(quality.sketches(measured))
