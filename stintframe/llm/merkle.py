"""Merkle manifest of a dataset, by concatenated-level strings (built-in column functions only).

Every row is a leaf: the SHA-256 of its fields, each written as byte count, colon
and value (``-`` for null). Inside a group the leaves stand by ascending id. A
level of the tree is kept per aligned block of ``2 ** BLOCK_BITS`` nodes as one
string of hex digests: fixed-width substrings of two digests hash to the level
above, and the substrings beside a leaf's path are its sibling segment (a
substring beyond the end is empty: no sibling, the node is hashed alone). The
tops of the blocks are the nodes of the next tier, until each group has one
block; the group roots, in order of their names, are the leaves of the last tree.

Strings are held as bytes, so a substring is a plain slice. Nothing grows with a
group: places come from range-partitioned rows and per-partition counts, blocks
have a fixed number of nodes, and a tier has 1/1024 of the nodes of the one
below. The texts are read once, to hash them; only leaves shuffle.

Null ids stand first. Rows of one id are ordered by their leaf, so equal rows may
trade places without any effect. Null fields are ``-``; the null group is a group
of its own and comes first. An empty table gives an empty result. Columns other
than the listed fields do not enter the leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import let, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 10
DIGEST = 64


def framed(value: Column) -> Column:
    """A field with its byte count; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(framed(f) for f in fields)), 256)


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``pos`` (0-based place in the group) and ``n`` (size of the group).

    Rows are range-partitioned by Spark and numbered as they are written; the
    numbers are shifted by the counts of earlier partitions. The window sees one
    row per partition and group. A last, arbitrary sort key spreads equal rows.
    """
    spread = rows.withColumn("__spread", F.xxhash64(F.monotonically_increasing_id()))
    keys = [group, *order, "__spread"]
    numbered = (
        spread.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("__spread")
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__id", 33))
    )
    numbered = stored(numbered, "placed")
    runs = numbered.groupBy(group, "__part").agg(F.min("__id").alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        runs.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .withColumn("n", F.sum("__rows").over(whole))
        .drop("__rows")
    )
    pos = F.col("__id") - F.col("__first") + F.col("__before")
    return numbered.join(runs, [group, "__part"]).withColumn("pos", pos).drop("__id", "__part", "__first", "__before")


def _node(level: Column, number: Column, count: int = 1) -> Column:
    """The digests from node ``number`` on, as bytes of hex text; empty beyond the end."""
    return F.substring(level, (number * DIGEST + 1).cast("int"), F.lit(count * DIGEST))


def parents(level: Column) -> Column:
    """The level above: every two digests hash to one, a single last digest alone."""
    pairs = F.ceil(F.octet_length(level) / (2 * DIGEST)).cast("int")
    digests = F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.sha2(_node(level, 2 * i, 2), 256))
    return F.array_join(digests, "").cast("binary")


def levels(bottom: Column, depth: Column) -> Column:
    """The level strings of a block, ``depth`` levels above the bottom."""
    steps = F.slice(F.sequence(F.lit(1), F.lit(BLOCK_BITS)), F.lit(1), depth)
    return F.aggregate(
        steps, F.array(bottom), lambda done, _: F.concat(done, F.array(let(F.element_at(done, -1), parents)))
    )


def siblings(block: Column, pos: Column) -> Column:
    """Per level up to the block's top: the sibling's digest (empty without one) and whether it stands left."""
    inside = F.slice(block, F.lit(1), F.size(block) - 1)

    def beside(level: Column, height: Column) -> Column:
        number = F.call_function("shiftright", F.pmod(pos, F.lit(1 << BLOCK_BITS)), height)
        left = number.bitwiseAND(1) == 1
        return F.struct(
            _node(level, number + F.when(left, -1).otherwise(1)).cast("string").alias("digest"), left.alias("left")
        )

    return F.transform(inside, beside)


def folded(leaf: Column, proof: Column) -> Column:
    """Root that follows from a leaf and its siblings."""

    def up(node: Column, s: Column) -> Column:
        return F.sha2(
            F.when(s["left"], F.concat(s["digest"], node)).otherwise(F.concat(node, s["digest"])), 256
        )

    return F.aggregate(proof, leaf, up)


def tier(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Blocks of the nodes (grp, pos, n, digest): (grp, block, n, nodes, levels), stored."""
    members = F.array_sort(F.collect_list(F.struct("pos", "digest", *payload)))
    blocks = nodes.groupBy("grp", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(
        F.first("n").alias("n"), members.alias("nodes")
    )
    depth = F.when(F.col("n") > 1 << BLOCK_BITS, BLOCK_BITS).otherwise(F.length(F.bin(F.col("n") - 1)))
    depth = F.when(F.col("n") == 1, 0).otherwise(depth).cast("int")
    bottom = F.array_join(F.transform("nodes", lambda x: x["digest"]), "").cast("binary")
    return stored(blocks.withColumn("levels", levels(bottom, depth)), "tier")


def forest(nodes: DataFrame, payload: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """All tiers of the trees over (grp, pos, n, digest), and (grp, root)."""
    tiers = [tier(nodes, payload)]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1 << BLOCK_BITS:
        above = tiers[-1].where(F.col("n") > 1 << BLOCK_BITS).select(
            "grp",
            F.col("block").alias("pos"),
            F.ceil(F.col("n") / (1 << BLOCK_BITS)).alias("n"),
            F.element_at("levels", -1).cast("string").alias("digest"),
        )
        tiers.append(tier(above))
        most = -(-most // (1 << BLOCK_BITS))
    roots = [
        t.where(F.col("n") <= 1 << BLOCK_BITS).select("grp", F.element_at("levels", -1).cast("string").alias("root"))
        for t in tiers
    ]
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return tiers, out


PROOF = "array<struct<digest:string,left:boolean>>"


def _with_proof(names: list[str], proof: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: F.struct(*(x[c].alias(c) for c in names), proof(x))


def proofs(tiers: list[DataFrame], payload: Sequence[str] = ()) -> DataFrame:
    """(grp, pos, digest, payload, proof): every bottom node with its siblings up to the group's root."""
    tails, none = None, F.array().cast(PROOF)
    for t, blocks in reversed(list(enumerate(tiers))):
        if tails is None:
            blocks = blocks.withColumn("tail", none)
        else:
            blocks = blocks.join(tails, ["grp", "block"], "left").withColumn("tail", F.coalesce("tail", none))
        names = ["pos", "digest", *(payload if t == 0 else [])]
        proof = lambda x: F.concat(siblings(F.col("levels"), x["pos"]), F.col("tail")).alias("proof")
        members = F.transform("nodes", _with_proof(names, proof))
        nodes = blocks.select("grp", F.explode(members).alias("x")).select("grp", "x.*")
        tails = nodes.select("grp", F.col("pos").alias("block"), F.col("proof").alias("tail"))
    return nodes


def manifest(
    docs: DataFrame, tampered: Sequence[Column], doc_id: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS
) -> DataFrame:
    """Leaves, roots and proofs of all rows, and the root that each proof gives for the leaf of ``tampered``.

    Returns (doc_id, group name, leaf, subroot, root, proof, proof_sha256,
    folded_root, verified). ``tampered`` has one expression per field.
    """
    named = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = docs.select(
        F.col(doc_id).alias("doc_id"),
        named.alias("grp"),
        leaf_of([F.col(f) for f in fields]).alias("digest"),
        leaf_of(tampered).alias("other"),
    )
    leaves = placed(leaves, "grp", ["doc_id", "digest"])
    tiers, subroots = forest(leaves, ["doc_id", "other"])
    names = placed(subroots.select(F.lit(0).alias("all"), F.col("grp").alias("name"), "root"), "all", ["name"])
    tops, roots = forest(names.select(F.col("all").alias("grp"), "pos", "n", F.col("root").alias("digest"), "name"), ["name"])
    upper = proofs(tops, ["name"]).join(roots, "grp").select(
        F.col("name").alias("grp"), F.col("digest").alias("subroot"), F.col("proof").alias("upper"), "root"
    )
    out = proofs(tiers, ["doc_id", "other"]).join(upper, "grp").withColumn("proof", F.concat("proof", "upper"))
    joined = F.array_join(F.transform("proof", lambda s: s["digest"]), "")
    return (
        out.withColumn("folded_root", folded(F.col("other"), F.col("proof")))
        .withColumn("proof_sha256", F.sha2(joined, 256))
        .select(
            "doc_id",
            F.when(F.col("grp") != "", F.substring("grp", 2, 2**31 - 1)).alias(group),
            F.col("digest").alias("leaf"),
            "subroot",
            "root",
            "proof",
            "proof_sha256",
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def audit(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` when every row whose id has a CRC-32 divisible by 7 had ``n_chars`` raised by one."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.col("n_chars") + F.when(hit, 1).otherwise(0)
    tampered = [changed if f == "n_chars" else F.col(f) for f in FIELDS]
    return manifest(docs, tampered).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
