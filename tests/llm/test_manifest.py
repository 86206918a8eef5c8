"""Exact dedup and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from stintframe.llm import exact_dedup, merkle
from stintframe.llm.columns import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def corpus(n: int, seed: int) -> list[tuple]:
    """Copies with other white space, a group of a third of all rows, nulls, repeats, ties and a very long text."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        kind = rng.randrange(6)
        if kind < 2:
            text = "hot  group" if rng.random() < 0.5 else "hot\tgroup"
        elif kind == 2:
            text = rng.choice([None, "", " \n\t", "\x0b\x0c\r"])
        elif kind == 3:
            text = " " * rng.randrange(3) + f"copy {rng.randrange(n // 8)}"
        else:
            text = f"own text {k} é{'x' * rng.randrange(40)}"
        out.append((None if k % 37 == 0 else k, text, rng.choice([None, "en", "de", "é"]), rng.choice([None, "s"]), rng.choice([None, k])))
    out += [out[5], out[5], out[40]]
    out.append((n, "long " * 200_000, "en", "s", 10**6))
    return out


def groups_by_force(rows):
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(k)
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0))
        tied = [k for k in members if (rows[k][0], len(rows[k][1] or "")) == (rows[best][0], len(rows[best][1] or ""))]
        for k in members:
            out.append((rows[k][0], rows[best][0], len(members), k == tied[0], sha(body)))
    return out


@pytest.mark.parametrize("per_filter", [1 << 25, 100])
def test_verdicts_equal_brute_force_in_one_round_and_in_many(spark, per_filter):
    rows = corpus(600, 1)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = rows_of(exact_dedup.verdicts(docs, rows_per_filter=per_filter))
    assert sorted(map(repr, got)) == sorted(map(repr, groups_by_force(rows)))


def test_filter_misses_no_repeat_and_passes_most_single_rows(spark):
    texts = [f"text {k}" for k in range(4000)] + [f"text {k}" for k in range(0, 4000, 10)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    narrow = exact_dedup.digests(docs)
    cells = exact_dedup.CELLS_A_ROW * len(texts)
    marked = exact_dedup.with_possible(narrow, exact_dedup.repeated_cells(narrow, cells), cells)
    flags = dict(marked.select("row", "possible").collect())
    by_sha = defaultdict(list)
    for r in narrow.collect():
        by_sha[r.sha].append(flags[r.row])
    assert all(all(f) for f in by_sha.values() if len(f) > 1)
    assert sum(f[0] for f in by_sha.values() if len(f) == 1) < 0.04 * len(by_sha)


def test_repeated_digests_alone_reach_the_comparison(spark):
    plan = exact_dedup._verdicts_of(exact_dedup.digests(spark.range(50).selectExpr("id AS doc_id", "string(id) AS text")), 50)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in text and "ArrowEvalPython" not in text and "Cartesian" not in text


def test_documents_that_stay_keep_their_columns(spark):
    rows = [(*r, k, f"v{r[0]}") for k, r in enumerate(corpus(300, 2))]
    docs = spark.createDataFrame(rows, SCHEMA + ", kept long, group_size string").repartition(4)
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    got = rows_of(out)
    want = groups_by_force(rows)
    assert sorted(str(r[0]) for r in got) == sorted(str(w[0]) for w in want if w[3])
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in got]
    assert len(set(bodies)) == len(bodies) == len({w[4] for w in want})


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert rows_of(exact_dedup.verdicts(docs)) == [] and rows_of(exact_dedup.without_copies(docs)) == []
    assert rows_of(merkle.audit(docs)) == []


def leaf(row, change=0):
    doc_id, text, lang, source, n = row
    n = None if n is None else n + change
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)]
    return sha("".join(fields))


def tree(nodes):
    """All levels from the leaves up to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def audit_by_force(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        parts[lang] = own, tree([leaf(r) for r in own])
    top = tree([parts[lang][1][-1][0] for lang in langs])
    out = []
    for g, lang in enumerate(langs):
        own, levels = parts[lang]
        for pos, r in enumerate(own):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, proof = leaf(r, int(hit)), ""
            for place, lv in ((pos, levels), (g, top)):
                for level in lv[:-1]:
                    beside = level[place ^ 1] if (place ^ 1) < len(level) else ""
                    proof += beside
                    node = sha(beside + node if place % 2 else node + beside)
                    place //= 2
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("bits, n", [(1, 5), (2, 90), (3, 200), (10, 130)])
def test_manifest_equals_brute_force_over_many_tiers(spark, monkeypatch, bits, n):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    rows = corpus(max(n, 45), n)[:n] if n < 45 else corpus(n, n)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(repr, rows_of(merkle.audit(docs)))) == sorted(map(repr, audit_by_force(rows)))


def test_lone_leaf_is_its_own_root_with_an_empty_proof(spark):
    row = (3, "one", "en", "s", 3)
    (got,) = rows_of(merkle.audit(spark.createDataFrame([row], SCHEMA)))
    assert got == (3, leaf(row), leaf(row), leaf(row), sha(""), leaf(row), True)


def test_every_single_changed_field_is_noticed(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(k, f"t{k}", "en", "s", k) for k in range(40)], SCHEMA)
    docs = docs.withColumns({"leaf": F.lit(1), "pos": F.lit(2), "root": F.lit(3), "name": F.lit("x"), "grp": F.lit("y")})
    for field in merkle.FIELDS:
        changed = [F.concat(F.col(f).cast("string"), F.lit("1")) if f == field else F.col(f) for f in merkle.FIELDS]
        out = merkle.manifest(docs, changed)
        assert out.where("verified").isEmpty() and out.count() == 40


def test_stored_tables_give_the_same_manifest_after_repartition(spark):
    docs = spark.createDataFrame(corpus(120, 9), SCHEMA)
    again = stored(docs.repartition(7), "again")
    assert sorted(map(repr, rows_of(merkle.audit(docs)))) == sorted(map(repr, rows_of(merkle.audit(again))))
