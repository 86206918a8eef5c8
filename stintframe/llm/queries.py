"""Registered queries of the operators, with their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    exact_dedup,
    fingerprints,
    html_text,
    jaccard,
    merkle,
    packing,
    passages,
    pieces,
    pitman_yor,
    quality,
    secret_scan,
    urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


WORD = r"[^\x20\x09-\x0D]+"


@register("op1_pitman_yor_scores")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


_ENTROPY = ", ".join(map(str, secret_scan.window_weights()))


def _sql_located(name: str, pattern: str, group: int, kind: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
{name}_parts AS (
  SELECT doc_id, list_transform(string_split_regex(body, '{quoted}'), lambda x: length(x)) AS gaps,
         list_transform(regexp_extract_all(body, '{quoted}'), lambda x: length(x)) AS lens,
         regexp_extract_all(body, '{quoted}', {group}) AS vals
  FROM d),
{name} AS (
  SELECT doc_id, {kind} AS kind, start, start + len AS stop, val
  FROM (SELECT doc_id, lens[i] AS len, vals[i] AS val,
               list_sum(gaps[1:i]) + coalesce(list_sum(lens[1:i - 1]), 0) AS start
        FROM (SELECT *, unnest(range(1, len(lens) + 1)) AS i FROM {name}_parts)))"""


OP2_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
{_sql_located("assign", secret_scan.ASSIGN, 2, 0)},
{_sql_located("access", secret_scan.ACCESS, 0, 1)},
{_sql_located("hexes", secret_scan.HEX, 0, 2)},
{_sql_located("candidate", secret_scan.CANDIDATE, 0, 3)},
base AS (
  SELECT doc_id, kind, start, stop FROM assign WHERE length(val) >= {secret_scan.MIN_VALUE}
  UNION ALL SELECT doc_id, kind, start, stop FROM access UNION ALL SELECT doc_id, kind, start, stop FROM hexes),
suspect AS (
  SELECT * FROM candidate
  WHERE regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]')
    AND NOT regexp_full_match(val, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}')
    AND NOT regexp_full_match(val, '[A-Za-z]+([-_/=+][A-Za-z]+)*[-_/=+]?[0-9]{{1,8}}')
    AND NOT regexp_matches(val, '{"|".join(secret_scan.DUMMIES)}')),
windows AS (
  SELECT doc_id, start, stop, val, i, substr(val, i::bigint, {secret_scan.WIDTH}) AS win
  FROM (SELECT *, unnest(range(1, length(val) - {secret_scan.WIDTH} + 2)) AS i FROM suspect)),
sums AS (
  SELECT doc_id, start, stop, val, i, sum([{_ENTROPY}][c + 1]) AS s
  FROM (SELECT doc_id, start, stop, val, i, ch, count(*) AS c
        FROM (SELECT doc_id, start, stop, val, i, unnest(string_split(win, '')) AS ch FROM windows)
        GROUP BY ALL) GROUP BY ALL),
entropy AS (
  SELECT doc_id, 3 AS kind, start, stop FROM sums
  GROUP BY doc_id, start, stop, val
  HAVING round(1000 * log2({secret_scan.WIDTH})) - floor(min(s) / {secret_scan.WIDTH}) >=
    CASE WHEN regexp_full_match(val, '[0-9a-f]+') THEN {secret_scan.LEAST["hex"]}
         WHEN regexp_full_match(val, '[0-9A-Za-z]+') THEN {secret_scan.LEAST["alnum"]} ELSE {secret_scan.LEAST["base64"]} END),
added AS (
  SELECT * FROM entropy e
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND b.start < e.stop AND e.start < b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM added),
named AS (
  SELECT doc_id, kind, start,
         ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start::bigint || ':' || stop::bigint AS t FROM every)
SELECT d.doc_id,
       count(*) FILTER (n.kind = 0) AS n_assign, count(*) FILTER (n.kind = 1) AS n_access,
       count(*) FILTER (n.kind = 2) AS n_hex,
       sha256(coalesce(string_agg(t, ',' ORDER BY start, kind) FILTER (n.kind < 3), '')) AS base_sha256,
       coalesce(string_agg(t, ',' ORDER BY start, kind), '') AS spans
FROM d LEFT JOIN named n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


@register("op2_secret_spans", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


@register("op3_url_verdicts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"))


@register("op4_main_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@register("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")
    )


@register("op6_piece_lattice")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations encoded, and decoded again from its ids."""
    model, keys = vocabulary("piece_bpe_32k.model"), ["conv_id", "turn"]
    both = pieces.decode(pieces.encode(table(spark, sf_dir, "conversations"), model, keys), model, keys)
    return both.select(
        *keys, F.size("ids").cast("long").alias("n_pieces"), "ids", (F.col("decoded") == F.col("text")).alias("round_trip")
    )


@register("op7_repeated_passages")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


OP8_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
  WHERE 100 * c.c >= 85 * (x.n + y.n - c.c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach r ON r.a = w.doc_id GROUP BY w.doc_id
"""


@register("op8_jaccard_links", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"))


@register("op9_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


_RULES = quality.RULES
OP10_SQL = rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5))),
repeats AS (
  SELECT doc_id, sum(step) AS n_repeat_words
  FROM (SELECT doc_id, least(5, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 5)) AS step FROM grams WHERE c >= 2)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(body, '\p{{Lu}}')) AS caps,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
  FROM w LEFT JOIN repeats USING (doc_id)),
b AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM m),
v AS (
  SELECT *, n_symbols * 1000 // greatest(n_words, 1) AS m_symbols, caps * 1000 // greatest(word_chars, 1) AS m_capitals,
         n_dup_lines * 1000 // greatest(len(lines), 1) AS m_dup_lines, word_chars * 100 // greatest(n_words, 1) AS m_word_length
  FROM b),
long AS (
  {" UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, m_{r} AS value, {least} AS least FROM v" for r, (least, _) in _RULES.items())}),
coded AS (
  SELECT lang, source, rule, least, (s * 64 + (value >> s)) AS bucket, count(*) AS n
  FROM (SELECT *, greatest(length(bin(value)) - 6, 0)::bigint AS s FROM long) GROUP BY ALL),
summed AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, rule) AS total
  FROM coded),
quart AS (
  SELECT lang, source, rule, least,
         min(bucket) FILTER (100 * upto >= 25 * total) AS b1, min(bucket) FILTER (100 * upto >= 75 * total) AS b3
  FROM summed GROUP BY ALL),
lims AS (
  SELECT lang, source, rule, q1 - {quality.REACH} * greatest(q3 - q1, least) AS low, q3 + {quality.REACH} * greatest(q3 - q1, least) AS high
  FROM (SELECT *, (b1 % 64) << (b1 // 64) AS q1, (b3 % 64) << (b3 // 64) AS q3 FROM quart)),
odd AS (
  {" UNION ALL ".join(f"SELECT v.doc_id FROM v JOIN lims f ON f.lang IS NOT DISTINCT FROM v.lang AND f.source IS NOT DISTINCT FROM v.source AND f.rule = '{r}' WHERE v.m_{r} > f.high" + (f" OR v.m_{r} < f.low" if both else "") for r, (_, both) in _RULES.items())})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::bigint AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM odd) AS kept
FROM v
"""


@register("op10_quality_verdicts", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER best = 1 AS kept, sha AS text_sha256
FROM d WINDOW best AS (PARTITION BY sha ORDER BY n DESC, doc_id NULLS LAST)
"""


@register("op11_exact_copies", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.verdicts(table(spark, sf_dir, "documents"))


@register("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )


def _sql_framed(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_framed(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_SQL_TREE = """
{name} AS (
  SELECT 0 AS lvl, grp, pos, n, h FROM {base}
  UNION ALL
  SELECT lvl + 1, grp, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY lvl, grp, pos // 2)"""

OP13_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id AS id, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
d AS (
  SELECT doc_id, lang, {_sql_leaf("n_chars")} AS h,
         {_sql_leaf("(n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END)")} AS other
  FROM documents LEFT JOIN crc ON id = doc_id),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp FROM (SELECT DISTINCT lang FROM d)),
leaves AS (
  SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
         count(*) OVER (PARTITION BY grp) AS n, doc_id, h, other
  FROM d JOIN langs ON langs.lang IS NOT DISTINCT FROM d.lang),
{_SQL_TREE.format(name="lower_tree", base="leaves")},
subroots AS (SELECT 0 AS grp, grp AS pos, count(*) OVER () AS n, h FROM lower_tree WHERE n = 1),
{_SQL_TREE.format(name="upper_tree", base="subroots")},
path AS (
  SELECT l.grp, l.pos, t.lvl, xor(l.pos >> t.lvl, 1) AS beside, l.grp AS tree, 0 AS upper
  FROM leaves l JOIN (SELECT DISTINCT grp, lvl FROM lower_tree WHERE n > 1) t ON t.grp = l.grp
  UNION ALL
  SELECT l.grp, l.pos, t.lvl, xor(l.grp >> t.lvl, 1), 0, 1
  FROM leaves l, (SELECT DISTINCT lvl FROM upper_tree WHERE n > 1) t),
steps AS (
  SELECT p.grp, p.pos, p.beside % 2 = 0 AS on_left, coalesce(a.h, b.h, '') AS digest,
         row_number() OVER (PARTITION BY p.grp, p.pos ORDER BY p.upper, p.lvl) AS k
  FROM path p
  LEFT JOIN lower_tree a ON p.upper = 0 AND a.grp = p.tree AND a.lvl = p.lvl AND a.pos = p.beside
  LEFT JOIN upper_tree b ON p.upper = 1 AND b.lvl = p.lvl AND b.pos = p.beside),
proof AS (SELECT grp, pos, sha256(string_agg(digest, '' ORDER BY k)) AS proof_sha256 FROM steps GROUP BY grp, pos),
fold AS (
  SELECT grp, pos, 1 AS k, other AS h FROM leaves
  UNION ALL
  SELECT f.grp, f.pos, f.k + 1, sha256(CASE WHEN s.on_left THEN s.digest || f.h ELSE f.h || s.digest END)
  FROM fold f JOIN steps s ON s.grp = f.grp AND s.pos = f.pos AND s.k = f.k),
folded AS (SELECT grp, pos, arg_max(h, k) AS folded_root FROM fold GROUP BY grp, pos),
root AS (SELECT h AS root FROM upper_tree WHERE n = 1)
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM leaves l JOIN subroots s ON s.pos = l.grp JOIN folded f ON f.grp = l.grp AND f.pos = l.pos
LEFT JOIN proof p ON p.grp = l.grp AND p.pos = l.pos, root
"""


@register("op13_merkle_manifest", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))
