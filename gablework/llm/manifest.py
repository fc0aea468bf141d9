"""Merkle manifest of a dataset with a proof for every row, by pointer jumping.

Rows are leaves; runs of FAN nodes are hashed level by level, first within each source, then over the sources' roots. Every inner node
starts with a segment: the digests of its siblings, left and right of it, and its parent as the ancestor that the segment leads
to. Joining the table with itself on that ancestor doubles the distance and concatenates the segments, until all inner nodes
reach the root; leaves then take their parents' segments. Ancestors with many descendants are dealt to as many salted copies as
they need, so no source, however large, meets in one task. Ranks come from range partitions and their counts, never from a window over a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablework.llm.common import Scratch, with_lit_crc

FAN = 16
#: Rows that one key of a self-join meets at most (about).
SPREAD = 256
#: Every so many documents (by crc32 of the id) the tampered copy differs.
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Number of the tree over the sources' roots.
TOP = -1


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """A row's digest, in hex, with text in place of its own."""
    return F.sha2(F.concat(*(_field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text))), 256)


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def ranked(rows: DataFrame, scratch: Scratch, group: str, *order: Column) -> tuple[DataFrame, DataFrame]:
    """rows (a written table) with pos, their rank from 0 within group, nulls first, and n, the group's size; and the groups with n.

    Rows are dealt by ranges of (group, order), so a large group lies in many tasks."""
    by = [F.col(group), *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = scratch.table(placed, "ranks")
    own = Window.partitionBy(group)
    parts = placed.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    before = F.sum("held").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = scratch.table(parts.select(group, "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(own).alias("n")), "parts")
    return placed.join(parts, [group, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift"), parts.select(group, "n").distinct()


def _level(nodes: DataFrame) -> DataFrame:
    """The runs' parents of the trees that have more than one node: tree, pos, n, digest, weight (leaves below), children."""
    run = F.sort_array(F.collect_list(F.struct("pos", "digest")))
    up = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("pos"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n")).agg(run.alias("run"), F.sum("weight").alias("weight"))
    up = up.withColumn("text", F.array_join(F.transform("run", lambda x: _hex(x["digest"])), ""))
    return up.select("tree", "pos", "n", F.unhex(F.sha2("text", 256)).alias("digest"), "weight", F.unhex("text").alias("children"))


def _levels(nodes: DataFrame, most: int, scratch: Scratch) -> list[DataFrame]:
    """Levels 1, 2, ... of trees of at most most nodes, each a written table."""
    out = []
    while most > 1:
        nodes = scratch.table(_level(nodes), "level")
        out.append(nodes)
        most = -(-most // FAN)
    return out


def _node(tree: Column, level: Column, pos: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def _own(level: int) -> Column:
    """The name of a node at a level; a source's root is a leaf of the tree over the sources."""
    plain = _node(F.col("tree"), F.lit(level), F.col("pos"))
    return F.when((F.col("tree") != TOP) & (F.col("n") == 1), _node(F.lit(TOP), F.lit(0), F.col("tree"))).otherwise(plain)


def _cut(children: Column, at: Column) -> Column:
    """The siblings to the left and to the right of child number at."""
    return F.struct(F.substring(children, F.lit(1), (at * 32).cast("int")).alias("left"), F.substring(children, (at * 32 + 33).cast("int"), F.lit(32 * FAN)).alias("right"))


def _segments(parents: DataFrame, level: int) -> DataFrame:
    """node, to (its parent), weight (of to), subroot (where known), path: the first segments of the children of a level's nodes."""
    below = parents.withColumn("k", F.explode(F.sequence(F.lit(0), (F.octet_length("children") / 32 - 1).cast("int"))))
    child = F.substring("children", (F.col("k") * 32 + 1).cast("int"), F.lit(32))
    subroot = F.when(F.col("tree") == TOP, child if level == 1 else None).when(F.col("n") == 1, F.col("digest"))
    return below.select(_node(F.col("tree"), F.lit(level - 1), F.col("pos") * FAN + F.col("k")).alias("node"), _own(level).alias("to"), "weight", subroot.alias("subroot"), F.array(_cut(F.col("children"), F.col("k"))).alias("path"))


def _jumped(table: DataFrame, root: Column) -> DataFrame:
    """Twice the distance: the segments of each node and of the ancestor they lead to, as one."""
    copies = lambda: F.greatest(F.lit(1), F.ceil(F.col("weight") / (FAN * SPREAD))).cast("int")
    open_ = table.where(F.col("to") != root).withColumn("salt", F.pmod(F.xxhash64("node"), copies().cast("long")).cast("int"))
    held = table.select(F.col("node").alias("to"), F.explode(F.sequence(F.lit(0), F.col("own_copies") - 1)).alias("salt"), F.col("to").alias("next"), F.col("weight").alias("above"), F.col("subroot").alias("s"), F.col("path").alias("more"))
    far = open_.join(held, ["to", "salt"]).select("node", F.col("next").alias("to"), F.col("above").alias("weight"), "own_copies", F.coalesce("subroot", "s").alias("subroot"), F.concat("path", "more").alias("path"))
    return table.where(F.col("to") == root).unionByName(far)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of documents.

    A null column is a `-` in the leaf, null sources are one source, the first; rows without a doc_id come first in their source and are
    never tampered with. Rows that repeat a doc_id are leaves each, in order of their digests; equal rows differ only by their
    proofs. Empty texts have a length of 0, texts are hashed whole, other columns are ignored, and an empty table gives no row."""
    scratch = Scratch(docs.sparkSession)
    odd = with_lit_crc(F.col("doc_id")) % TAMPERED == 0
    changed = F.when(odd, leaf(F.translate("text", _UPPER, _LOWER)))
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key")
    leaves = scratch.table(docs.select("doc_id", source, F.unhex(leaf(F.col("text"))).alias("digest"), F.unhex(changed).alias("changed")), "leaves")
    rows, sources = ranked(leaves, scratch, "key", F.col("doc_id").asc_nulls_first(), F.col("digest"))
    named, _ = ranked(scratch.table(sources.select("key", F.col("n").alias("size"), F.lit(0).alias("all")), "sources"), scratch, "all", F.col("key"))
    named = scratch.table(named.select("key", F.col("pos").alias("tree"), "size", F.col("n").alias("of")), "sources")
    # How high the trees are.
    most, of = named.agg(F.max("size"), F.max("of")).first()
    if of is None:
        scratch.drop()
        return docs.select("doc_id").limit(0).selectExpr("doc_id", *(f"cast(null as string) as {c}" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), "false as verified")
    rows = scratch.table(rows.join(named.select("key", "tree"), "key").select("doc_id", "digest", "changed", "tree", "pos", "n"), "rows")
    nodes = rows.select("tree", "pos", "n", "digest", F.lit(1).cast("long").alias("weight"))
    low = _levels(nodes, most, scratch)
    subroots = nodes.where("n = 1").select("tree", "digest", "weight")
    for x in low:
        subroots = subroots.union(x.where("n = 1").select("tree", "digest", "weight"))
    subroots = scratch.table(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(of).cast("long").alias("n"), "digest", "weight"), "subroots")
    high = _levels(subroots, of, scratch)
    root_digest = (high[-1] if high else subroots).first()["digest"]
    root = _node(F.lit(TOP), F.lit(len(high)), F.lit(0))
    parts = [_segments(x, k) for k, x in enumerate(low, 1) if k > 1] + [_segments(x, k) for k, x in enumerate(high, 1)]
    path_type = "array<struct<left:binary,right:binary>>"
    if parts:
        table = parts[0]
        for x in parts[1:]:
            table = table.unionByName(x)
        # The copies that a node needs as an ancestor follow from the leaves below it.
        weights = [x.select(_own(k).alias("node"), F.col("weight").alias("w")) for k, x in enumerate(low, 1)]
        weights += [x.select(_node(F.lit(TOP), F.lit(k), F.col("pos")).alias("node"), F.col("weight").alias("w")) for k, x in enumerate([subroots, *high]) if k < len(high)]
        known = weights[0]
        for x in weights[1:]:
            known = known.union(x)
        copies = F.greatest(F.lit(1), F.ceil(F.max("w") / (FAN * SPREAD))).cast("int")
        table = scratch.table(table.join(known.groupBy("node").agg(copies.alias("own_copies")), "node"), "jumps")
        reach, height = 1, max(0, len(low) - 1) + len(high)
        while reach < height:
            new = scratch.table(_jumped(table, root), "jumps")
            scratch.drop(*(x for _, x in scratch.held if x is not table))
            table, reach = new, reach * 2
        table = table.select(F.col("node"), F.col("path"), F.col("subroot").alias("known"))
    else:
        table = rows.limit(0).select(_node(F.lit(0), F.lit(0), F.lit(0)).alias("node"), F.lit(None).cast(path_type).alias("path"), F.lit(None).cast("binary").alias("known"))
    lone = subroots.where("weight = 1").select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("run"), F.lit(None).cast("binary").alias("children"), "digest", F.lit(True).alias("is_root"), _node(F.lit(TOP), F.lit(0), F.col("pos")).alias("node"))
    hosts = lone
    if low:
        hosts = low[0].select("tree", F.col("pos").alias("run"), "children", "digest", (F.col("n") == 1).alias("is_root"), _own(1).alias("node")).union(lone)
    hosts = hosts.join(table, "node", "left").select("tree", "run", "children", F.when(F.col("is_root"), F.col("digest")).otherwise(F.col("known")).alias("subroot"), F.coalesce("path", F.array().cast(path_type)).alias("above"))
    own = F.array(_cut(F.col("children"), F.col("pos") % FAN))
    proved = rows.withColumn("run", F.expr(f"pos div {FAN}")).join(hosts, ["tree", "run"])
    proved = proved.withColumn("path", F.when(F.col("children").isNull(), F.col("above")).otherwise(F.concat(own, "above")))
    folded = F.aggregate("path", _hex(F.coalesce("changed", "digest")), lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])), 256))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    top = F.lit(root_digest.hex())
    out = proved.select("doc_id", _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), top.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    out = scratch.table(out.withColumn("verified", F.col("folded_root") == F.col("root")), "proofs")
    scratch.drop(out)
    return out
