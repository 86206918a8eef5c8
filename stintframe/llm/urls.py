"""URL filter: rules first, then naive Bayes over segmented names.

Hosts glue words together, so every host label is split by a unigram Viterbi:
substrings of bounded length are joined with the word counts of the pages' own
texts, and the best split under these counts is taken. Host words and path tokens
go to a multinomial naive Bayes. It learns from all urls that a rule decides
(their verdict is the label) and from a short list of words of unwanted sites.

All tables are joined on words, so nothing that grows with the data is broadcast.

A null url, or one without ``://``, has an empty host and path; the method then
goes by the prior alone. Empty tables give no rows. Repeated rows are judged one
by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import stored

# Rules as (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Words of unwanted sites, learned as blocked.
UNWANTED = "spam casino porn xxx sex adult viagra pills pharmacy betting gambling poker warez torrent crack hacked farm".split()
MAX_WORD = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for said, name, start in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, said).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): words of a-z in the texts of all pages, markup aside, at most MAX_WORD long."""
    markup = re.compile(r"<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&[#\w]*;?", re.S | re.I)
    letters = re.compile(r"[a-z]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for page in batch.column(0):
                counts.update(letters.findall(markup.sub(" ", page.as_py() or "").lower()))
            kept = [(w, n) for w, n in counts.items() if len(w) <= MAX_WORD]
            words, numbers = zip(*kept) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])

    return pages.select("html").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def split_name(name: str, weights: dict[str, float], total: int) -> list[str]:
    """Best split of a name: sum of log10(n / total); unknown stretches cost more the longer they are."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            word = name[start:end]
            known = weights.get(word)
            cost = known if known is not None else 1 - math.log10(max(total, 10)) - 1.2 * len(word)
            options.append((best[start][0] + cost, -start))
        score, back = max(options)
        best.append((score, -back))
    out, at = [], len(name)
    while at:
        out.append(name[best[at][1] : at])
        at = best[at][1]
    return out[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words): every distinct host label with its split.

    Substrings that are words come by an equi-join; a label has at most
    MAX_WORD times its length of them.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.length("label"), F.lit(1)))).alias("start")
    parts = (
        labels.select("label", starts)
        .select("label", "start", F.explode(F.sequence(F.lit(1), F.lit(MAX_WORD))).alias("size"))
        .where(F.col("start") + F.col("size") <= F.length("label") + 1)
        .select("label", F.substring("label", F.col("start"), F.col("size")).alias("word"))
        .distinct()
    )
    edges = parts.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("edges"))
    every = labels.join(edges, "label", "left").select("label", "edges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, edges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Single letters are no words but for "a" and "i".
                weights = {
                    e["word"]: math.log10(e["n"] / total) for e in edges or [] if len(e["word"]) > 1 or e["word"] in "ai"
                }
                out.append(split_name(label, weights, total))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["label", "words"])

    return every.mapInArrow(run, "label string, words array<string>")


def _parts(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), "[^a-z0-9]+"), lambda x: x != "")


def verdicts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, tokens, log_odds) of every page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    rule, said = ruled(F.col("host"), F.col("path"))
    rows = stored(rows.withColumn("rule", rule).withColumn("said", said), "urls")
    # Tokens are worked out once for every distinct host and for every distinct path.
    host_parts = rows.select("host").distinct().select("host", F.explode(_parts(F.col("host"))).alias("label"))
    names = segmented(host_parts.select("label").distinct(), word_counts(pages))
    host_tokens = host_parts.join(names, "label").select("host", F.explode("words").alias("word")).select(
        "host", F.concat(F.lit("h:"), "word").alias("token")
    )
    by_host = host_tokens.groupBy("host").agg(F.sort_array(F.collect_list("token")).alias("host_tokens"))
    path_tokens = F.transform(
        _parts(F.col("path")), lambda x: F.concat(F.lit("p:"), F.when(F.regexp_like(x, F.lit("^[0-9]+$")), "0").otherwise(x))
    )
    tokens = F.concat(F.coalesce("host_tokens", F.array().cast("array<string>")), path_tokens)
    told = stored(rows.join(by_host, "host", "left").withColumn("tokens", tokens).drop("host_tokens"), "tokens")
    # Unwanted words count as if every url with a label were a blocked one that has them.
    labelled = max(20, told.where("said is not null").count())
    blocked = F.when(F.col("said") == "block", 1).otherwise(0)
    seen = told.where("said is not null").select(F.explode("tokens").alias("token"), blocked.alias("b"))
    counted = seen.groupBy("token").agg(F.sum("b").alias("b"), F.sum(1 - F.col("b")).alias("a"))
    prior_words = pages.sparkSession.createDataFrame(
        [(s + w, 0, 0, labelled) for w in UNWANTED for s in ("h:", "p:")], "token string, b long, a long, told long"
    )
    counted = stored(
        counted.withColumn("told", F.lit(0).cast("long"))
        .unionByName(prior_words)
        .groupBy("token")
        .agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.sum("told").alias("told")),
        "counts",
    )
    # The list's counts are no part of the class totals, or they would make all other words look allowed.
    sums = counted.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count("*").alias("v")).first()
    classes = told.agg(
        F.sum(F.when(F.col("said") == "block", 1).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("said") == "allow", 1).otherwise(0)).alias("a"),
    ).first()
    prior = math.log(((classes["b"] or 0) + 1) / ((classes["a"] or 0) + 1))
    odds = F.log((F.col("b") + F.col("told") + 1) / float(sums["b"] + sums["v"])) - F.log((F.col("a") + 1) / float(sums["a"] + sums["v"]))
    weights = counted.select("token", odds.alias("odds"))
    scores = (
        told.where("said is null")
        .select("row", F.explode("tokens").alias("token"))
        .join(weights, "token")
        .groupBy("row")
        .agg(F.sum("odds").alias("odds"))
    )
    judged = told.join(scores, "row", "left")
    log_odds = F.coalesce("odds", F.lit(0.0)) + prior
    verdict = F.coalesce("said", F.when(log_odds > 0, "block").otherwise("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "tokens", F.when(F.col("said").isNull(), log_odds).alias("log_odds")
    )
