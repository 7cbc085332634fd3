"""Merkle manifest of a dataset: a tree of digests over its rows, with a proof for each row.

Rows are the leaves of one tree per group, in the order of an id; the roots of the trees
are the leaves of one more tree, whose root stands for the whole dataset. H is the lower-case
hex SHA-256 of its inputs, concatenated; digests go in as hex text. While a tree has several
nodes, every ``fanout`` consecutive ones (the last run may have fewer) become their H.

Slot pivot: a node's slot is its place among its parent's children. Conditional aggregates
over the parent, one per slot, put its children into ``fanout`` columns. These concatenated
and hashed are the parent's digest; without the column of the own slot they are the siblings,
which the proof holds as the text before and after the own digest.

The leaves are dealt once, in blocks of about a thousand neighbours, and climb all levels
within their block without another shuffle: a parent never lies in two blocks. The blocks'
tops are nodes of a tree a thousandth the size, which is climbed likewise, so the rows move
once and a group that holds most of them is spread over its blocks. Numbering the leaves is a
range partition, a sort and a shift; the driver sees one number per partition.

Nulls: a null field is hashed as ``-``; rows with a null group are a group of their own,
ordered first; rows with a null id come last in their group. Rows that share an id are
ordered by their leaf; whole repeats are interchangeable. Texts of any length are hashed
where they are read and don't move. A group of one row has that row's leaf as its root, a
single group's root is that of the dataset, and both then add nothing to the proof. An
empty table gives no rows. Columns of the input beside the ones asked for play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlift.llm.common import stage
from starlift.operators.keys import dense_keys

#: Leaves of a block at most, where the fanout allows it.
BLOCK = 1024

_STEP = "array<struct<before:string,after:string>>"


def encoded(value: Column) -> Column:
    """A field as it is hashed: its UTF-8 length, a colon and the value, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to along a proof."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """H of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def _levels(fanout: int) -> int:
    levels, span = 1, fanout
    while span * fanout <= BLOCK:
        levels, span = levels + 1, span * fanout
    return levels


def climb(nodes: DataFrame, fanout: int, largest: int) -> DataFrame:
    """``nodes`` with ``top``, the root of their tree, and ``path``, their proof up to it.

    ``nodes`` has the columns tree, place (from 0, without gaps), size (of the tree) and
    digest beside others; no tree has more than ``largest`` nodes.
    """
    kept = [name for name in nodes.columns if name != "digest"]
    levels = _levels(fanout)
    span = fanout**levels
    rows = nodes.withColumn("block", F.expr(f"place div {span}")).repartition("tree", "block")
    rows = rows.withColumn("top", F.col("digest"))
    steps = []
    for level in range(levels):
        width = fanout**level
        if largest <= width:
            break
        slot = F.expr(f"place div {width} % {fanout}")
        # Dealt by tree and block already, which holds all of a parent: no shuffle, one sort.
        children = Window.partitionBy("tree", "block", F.expr(f"place div {width * fanout}"))
        slots = [F.max(F.when(slot == at, F.col("top"))).over(children).alias(f"slot{at}") for at in range(fanout)]
        rows = rows.select("*", *slots)
        column = [F.coalesce(f"slot{at}", F.lit("")) for at in range(fanout)]
        before = F.concat(F.lit(""), *(F.when(slot > at, column[at]).otherwise("") for at in range(fanout - 1)))
        after = F.concat(F.lit(""), *(F.when(slot < at, column[at]).otherwise("") for at in range(1, fanout)))
        going_on = F.col("size") > width
        step = F.when(going_on, F.struct(before.alias("before"), after.alias("after"))).alias(f"step{level}")
        top = F.when(going_on, F.sha2(F.concat(*column), 256)).otherwise(F.col("top")).alias("top")
        rows = rows.select(*kept, "digest", "block", *steps, step, top)
        steps.append(f"step{level}")
    path = F.array_compact(F.array(*steps)) if steps else F.array()
    rows = stage(rows.select(*kept, "digest", "block", "top", path.cast(_STEP).alias("path")), "climbed")
    if largest <= span:
        return rows.drop("block")
    upper = rows.filter(f"place % {span} = 0").select(
        "tree", F.col("block").alias("place"), F.expr(f"(size + {span - 1}) div {span}").alias("size"), F.col("top").alias("digest")
    )
    upper = climb(upper, fanout, -(-largest // span)).select(
        "tree", F.col("place").alias("block"), F.col("top").alias("root"), F.col("path").alias("rest")
    )
    joined = rows.join(upper, ["tree", "block"])
    return joined.select(*kept, "digest", F.col("root").alias("top"), F.concat("path", "rest").alias("path"))


def manifest(
    rows: DataFrame, leaf: Column, group: str = "lang", order: str = "doc_id", keep: dict[str, Column] | None = None, fanout: int = 2
) -> DataFrame:
    """Per row: the group and the id under their own names, ``keep``, leaf, subroot, root and
    proof, an array of (before, after) from the leaf to the root."""
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    kept = [F.col(f"kept.{name}").alias(name) for name in keep or {}]
    leaves = rows.select(
        F.col(group).alias("grp"),
        F.col(order).alias("id"),
        leaf.alias("leaf"),
        F.struct(F.lit(0).alias("_"), *(value.alias(name) for name, value in (keep or {}).items())).alias("kept"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written first: numbering samples its input, which would hash every text twice.
    leaves = stage(leaves.select("*", F.col("grp").isNotNull().alias("named")), "leaves")
    numbered = dense_keys(leaves, "number", ["named", "grp", "id", "leaf", "row"]).drop("row")

    groups = numbered.groupBy("named", "grp").agg(F.min("number").alias("first"), F.count("*").alias("size"))
    groups = stage(dense_keys(groups, "tree", ["first"]), "groups")
    counts = groups.agg(F.count("*").alias("trees"), F.coalesce(F.max("size"), F.lit(0)).alias("largest")).first()
    of_group = groups.select(F.col("grp").alias("_grp"), "tree", "first", "size")
    nodes = numbered.join(of_group, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        "tree", (F.col("number") - F.col("first")).alias("place"), "size", "grp", "id", "kept", F.col("leaf").alias("digest")
    )
    climbed = climb(nodes, fanout, counts["largest"])

    tops = climbed.filter("place = 0").select(
        F.lit(0).alias("tree"), (F.col("tree") - 1).alias("place"), F.lit(counts["trees"]).alias("size"), F.col("top").alias("digest")
    )
    tops = climb(tops, fanout, counts["trees"]).select((F.col("place") + 1).alias("tree"), F.col("top").alias("root"), F.col("path").alias("rest"))
    return climbed.join(tops, "tree").select(
        F.col("grp").alias(group),
        F.col("id").alias(order),
        *kept,
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        F.concat("path", "rest").alias("proof"),
    )


def changed_by_one(value: Column) -> Column:
    """``value`` plus one, as its decimal text: no number is too large."""
    return (value.cast("decimal(38,0)") + 1).cast("string")


def fields(text_length: Column | None = None) -> list[Column]:
    """What stands for a document, with another text length if one is given."""
    length = F.col("n_chars") if text_length is None else text_length
    return [F.col("doc_id"), F.col("source"), F.col("lang"), length, F.col("text")]


def divisible(value: Column, by: int) -> Column:
    """Whether ``by`` divides the unsigned CRC-32 of the value's text; false for a null."""
    return F.coalesce(F.crc32(value.cast("string").cast("binary")) % by == 0, F.lit(False))


def verified(docs: DataFrame, fanout: int = 2) -> DataFrame:
    """The documents' manifest, and the root that each leads to after some were tampered with."""
    tampered = divisible(F.col("doc_id"), 7)
    later = F.when(tampered, leaf_digest(*fields(changed_by_one(F.col("n_chars")))))
    found = manifest(docs, leaf_digest(*fields()), keep={"later": later}, fanout=fanout)
    root = folded(F.coalesce("later", "leaf"), F.col("proof"))
    found = found.select("doc_id", "leaf", "subroot", "root", "proof", root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
