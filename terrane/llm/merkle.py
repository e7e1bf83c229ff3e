"""Merkle dataset manifest (operator 12): hash trees per group and over the groups, built by sibling-shift self-joins.

A row's leaf is the SHA-256 of its fields. Leaves of a group, in order, are the nodes of level 0; every ``ARITY``
consecutive nodes of a level become their hash, until one node remains, the group's subroot. The subroots, in the
order of their groups, are the leaves of one more tree, whose last node is the root of the data set.

1. Order. Rows are range partitioned and sorted by (group, id, leaf) and numbered where they lie; a table with one row
   per group and partition turns these numbers into places 0, 1, 2, ... of each group. No group meets in one task.
2. Levels. A node at place i is in run i div ARITY and slot i mod ARITY; its siblings' places are computed by shifting
   the slot (slot + j) mod ARITY within the run. Each node asks for them by an equi join of the level with itself on
   (group, place); what a node learns is what stands before and after it in its run. Rows of slot 0 emit the parents.
3. Proofs. From the top down, each node takes its parent's path by an equi join on (group, place div ARITY) and puts
   its own siblings in front. A path has at most ARITY - 1 hashes a level, so it grows with the logarithm of a group.

Tables hold digests as 32 bytes; hashes are taken of their lower-case hexadecimal text.

Defined results: a null field is hashed as ``-``; a null group is a group of its own and the first; rows of a null id
come first in their group and are never tampered with in ``tampering_trial``; rows of one id in a group are ordered by
leaf, equal rows are interchangeable; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import Scratch

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of ``monotonically_increasing_id``: the place in the partition lies below this bit, the partition's number above.
PARTITION_BIT = 33
PATH = "array<struct<before:binary,after:binary>>"


def field(value: Column) -> Column:
    """One field of a leaf: UTF-8 byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def shown(digests: Column) -> Column:
    """Digests, one after the other, as text."""
    return F.lower(F.hex(digests))


def leaf_hash(values: list[Column]) -> Column:
    return digest(F.concat(*map(field, values)))


def placed(scratch: Scratch, rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``i``, the place of each in its group ``g`` by ``order``, and ``size``, the rows of the group.

    The sorted rows are written once, so that numbering and counting see the same partitions.
    """
    keys = [F.col("g"), *(F.col(c) for c in order)]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    dealt = scratch.write(dealt, f"{name}-sorted").withColumn("part", F.shiftright("at", PARTITION_BIT))
    runs = dealt.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # one row per group and partition; rows of a group before a partition
    group = Window.partitionBy("g")
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("n").over(group).alias("size"))
    return dealt.join(runs, ["g", "part"]).withColumn("i", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _with_siblings(level: DataFrame, arity: int) -> DataFrame:
    """g, i, size, h, before, after of every node of a group with more than one node.

    ``before`` and ``after`` are the digests of the node's siblings on either side, in order.
    """
    nodes = level.where("size > 1")
    slot = F.pmod("i", F.lit(arity))
    shift = F.explode(F.sequence(F.lit(0), F.lit(arity - 1))).alias("j")
    asked = nodes.select("g", "i", "size", shift).withColumn("sibling", F.col("i") - slot + F.pmod(slot + F.col("j"), F.lit(arity)))
    told = nodes.select("g", F.col("i").alias("sibling"), "h")
    run = F.sort_array(F.collect_list(F.struct("sibling", "h")))
    met = (asked.where("sibling < size").select("g", "i", "size", "sibling").join(told, ["g", "sibling"])
           .groupBy("g", "i").agg(F.first("size").alias("size"), run.alias("run")))

    def joined(kept) -> Column:
        return F.aggregate(F.filter("run", kept), F.lit(bytearray()), lambda all_, s: F.concat(all_, s["h"]))

    return met.select("g", "i", "size", joined(lambda s: s["sibling"] == F.col("i")).alias("h"),
                      joined(lambda s: s["sibling"] < F.col("i")).alias("before"),
                      joined(lambda s: s["sibling"] > F.col("i")).alias("after"))


def build_levels(scratch: Scratch, nodes: DataFrame, name: str, arity: int = ARITY) -> list[tuple[DataFrame, DataFrame | None]]:
    """From the leaves up: each level's nodes (g, i, h, size) and their siblings (see ``_with_siblings``).

    The last level holds only groups that have come down to one node. The number of levels is the logarithm of the
    largest group's size.
    """
    levels: list[tuple[DataFrame, DataFrame | None]] = []
    level = scratch.write(nodes.select("g", "i", "h", "size"), f"{name}-level-0")
    while True:
        if level.where("size > 1").isEmpty():
            return [*levels, (level, None)]
        met = scratch.write(_with_siblings(level, arity), f"{name}-siblings-{len(levels)}")
        levels.append((level, met))
        parents = met.where(F.pmod("i", F.lit(arity)) == 0).select(
            "g", F.expr(f"i div {arity}").alias("i"), digest(shown(F.concat("h", "after"))).alias("h"),
            F.ceil(F.col("size") / arity).alias("size"))
        level = scratch.write(parents, f"{name}-level-{len(levels)}")


def paths(levels: list[tuple[DataFrame, DataFrame | None]], above: DataFrame | None = None, arity: int = ARITY) -> DataFrame:
    """g, i, top (the group's last node), path (siblings, level by level from the node up) of every leaf.

    ``above`` (g, upper_path, root): where the groups' last nodes are leaves of another tree, its path goes behind and
    its root is carried along.
    """
    below = None
    carried = ["top"] if above is None else ["top", "root"]
    for level, met in reversed(levels):
        tops = level.where("size = 1").select("g", "i", F.col("h").alias("top"))
        if above is None:
            own = tops.select("g", "i", *carried, F.array().cast(PATH).alias("path"))
        else:
            own = tops.join(above, "g").select("g", "i", *carried, F.col("upper_path").alias("path"))
        if met is not None:
            parents = below.withColumnRenamed("i", "parent")
            step = F.array(F.struct("before", "after"))
            inner = met.withColumn("parent", F.expr(f"i div {arity}")).join(parents, ["g", "parent"])
            own = own.unionByName(inner.select("g", "i", *carried, F.concat(step, "path").alias("path")))
        below = own
    return below


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(shown(F.concat(s["before"], node, s["after"]))))


def build_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", id_col: str = "doc_id",
                   extra: dict[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """Per row: id, leaf, subroot, root and path (siblings on either side, level by level, up to the root); digests
    as bytes.

    ``extra`` adds columns made from the input's (names that the result does not have).
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    # a null group comes first, the others follow bytewise
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("g")
    rows = docs.select(group, F.col(id_col).alias("id"), leaf_hash([F.col(f) for f in fields]).alias("h"),
                       *(c.alias(f"x_{n}") for n, c in (extra or {}).items()))
    # hashed once: range partitioning reads its input twice
    rows = scratch.write(rows, "leaves")
    leaves = scratch.write(placed(scratch, rows, ["id", "h"], "leaves"), "placed")
    scratch.drop("leaves", "leaves-sorted")
    groups = build_levels(scratch, leaves, "group", arity)
    subroots = None
    for level, _ in groups:
        tops = level.where("size = 1").select(F.lit("").alias("g"), F.col("g").alias("of"), "h")
        subroots = tops if subroots is None else subroots.unionByName(tops)
    subroots = scratch.write(placed(scratch, subroots, ["of"], "subroots"), "subroots")
    upper = paths(build_levels(scratch, subroots, "upper", arity), arity=arity).select(
        "i", F.col("top").alias("root"), F.col("path").alias("upper_path"))
    above = scratch.write(subroots.join(upper, "i").select(F.col("of").alias("g"), "root", "upper_path"), "above")
    known = paths(groups, above, arity).withColumnRenamed("top", "subroot")
    return leaves.join(known, ["g", "i"]).select(
        F.col("id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", "path",
        *(F.col(f"x_{n}").alias(n) for n in (extra or {})))


def verified(manifest: DataFrame, leaf: Column) -> DataFrame:
    """The manifest with proof_sha256, folded_root (from ``leaf`` and the row's path) and whether that is the root;
    digests as hexadecimal text."""
    siblings = F.aggregate("path", F.lit(bytearray()), lambda all_, s: F.concat(all_, s["before"], s["after"]))
    told = manifest.withColumn("folded_root", folded(leaf, F.col("path")))
    return (told.withColumn("verified", F.col("folded_root") == F.col("root")).withColumn("proof_sha256", F.sha2(shown(siblings), 256))
            .withColumns({c: shown(F.col(c)) for c in ("leaf", "subroot", "root", "folded_root")}))


def tampering_trial(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, checked against leaves of which every third (by the id's CRC-32) is made of a text
    with lower-cased A-Z."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(chosen, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    # null where the leaf stays: an untouched text is not hashed again
    other = F.when(chosen & (text != F.col("text")), leaf_hash([text if f == "text" else F.col(f) for f in FIELDS]))
    told = verified(build_manifest(docs, extra={"tampered": other}), F.coalesce("tampered", "leaf"))
    return told.drop("path", "tampered")
