"""Fixity audit of WARC archives by Merkle trees.

A catalogue gives every page's record an archive and a byte offset; a replica is the records' bytes as they are stored
there. Each replica is hashed from its own bytes: its tree has a leaf for each offset range of LEAF_BYTES, the hash of its
records' hashes in offset order, and nodes of FAN_OUT children above, up to a root for each archive. Two replicas are
compared from the roots downward: only children of nodes that differ are looked at, down to the offset ranges and the
records in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablework.llm.common import materialize

ARCHIVE_BYTES, LEAF_BYTES, FAN_OUT = 8 << 20, 16 << 10, 16


def record(url: Column, html: Column) -> Column:
    """A WARC response record's bytes."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def _number(text: Column, first: int, digits: int = 8) -> Column:
    return F.conv(F.substring(text, first, digits), 16, 10).cast("long")


def records(pages: DataFrame) -> DataFrame:
    """The record of every row of pages (page_id, url, html): page_id, payload, digest, size. Null urls and texts count as empty."""
    rows = pages.select("page_id", record(F.col("url"), F.col("html")).alias("payload"))
    return rows.select("page_id", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"))


def _named(of: DataFrame) -> DataFrame:
    """Distinct records without their bytes: page_id, digest, size, copies and name, empty for a page's only record, its hash otherwise."""
    one = materialize(of.groupBy("page_id", "digest", "size").agg(F.count("*").alias("copies")), "records")
    several = one.groupBy(F.col("page_id").alias("of")).agg(F.count("*").alias("n")).where("n > 1").select("of", F.lit(True).alias("several"))
    named = one.join(several, F.col("page_id").eqNullSafe(F.col("of")), "left")
    return named.select("page_id", "digest", "size", "copies", F.when(F.col("several"), F.col("digest")).otherwise("").alias("name"))


def catalogue(of: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Places of records: page_id, name, archive, offset. The md5 of a record's page_id and name deals it to an archive, where
    records stand in order of page_id (nulls first) and name, with room for all copies. So a page whose bytes change keeps its
    place in a catalogue that was made before."""
    named = _named(of)
    total = named.agg(F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0)).alias("n")).first().n
    archives = max(1, -(-total // archive_bytes))
    key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"), F.col("name"))
    archive = F.pmod(_number(F.md5(key.cast("binary")), 1), F.lit(archives))
    # An archive has a bounded number of bytes, so its records are ordered by one task.
    order = Window.partitionBy("archive").orderBy(F.col("page_id").asc_nulls_first(), "name")
    length = F.col("size") * F.col("copies")
    return materialize(named.withColumn("archive", archive).select("page_id", "name", "archive", (F.sum(length).over(order) - length).alias("offset")), "catalogue")


def stored(of: DataFrame, places: DataFrame) -> DataFrame:
    """A replica: the records that the catalogue knows, at their places: archive, offset, page_id, copies, payload. A place
    holds a record of its page, whatever its bytes are now; repeated rows share theirs. Only this join can send bytes, and
    it doesn't while the places are small enough for Spark to broadcast them."""
    same = F.col("page_id").eqNullSafe(F.col("of")) & (F.col("name") == F.col("of_name"))
    where = places.select(F.col("page_id").alias("of"), F.col("name").alias("of_name"), "archive", "offset")
    at = _named(of).join(where, same).select(F.col("page_id").alias("at_id"), F.col("digest").alias("at_digest"), "copies", "archive", "offset")
    at = materialize(at, "places")
    return of.join(at, F.col("page_id").eqNullSafe(F.col("at_id")) & (F.col("digest") == F.col("at_digest"))).select("archive", "offset", "page_id", "copies", "payload")


def hashed(replica: DataFrame) -> DataFrame:
    """Hashes of a replica's records, from the bytes that are stored: archive, offset, page_id, copies, digest."""
    return replica.select("archive", "offset", "page_id", "copies", F.sha2("payload", 256).alias("digest")).distinct()


def leaves(records: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """A replica's lowest level: archive, node (number of the offset range) and hash. A range has a bounded number of
    records, as each has a header."""
    one = F.format_string("%d:%d:%s", "offset", "copies", "digest")
    rows = records.withColumn("node", F.floor(F.col("offset") / leaf_bytes))
    return rows.groupBy("archive", "node").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", one.alias("x")))), lambda r: r["x"]), "\n"), 256).alias("hash"))


def tree(records: DataFrame, height: int, leaf_bytes: int = LEAF_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels from the leaves up to the roots, each written to the shared folder."""
    levels = [materialize(leaves(records, leaf_bytes), "merkle")]
    for _ in range(height):
        parent = levels[-1].select("archive", F.floor(F.col("node") / fan_out).alias("node"), F.struct("node", "hash").alias("child"))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list("child")), lambda c: F.format_string("%d:%s", c["node"], c["hash"])), "\n")
        levels.append(materialize(parent.groupBy("archive", "node").agg(F.sha2(joined, 256).alias("hash")), "merkle"))
    return levels


def audit(ours: DataFrame, theirs: DataFrame, leaf_bytes: int = LEAF_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """Records in which two replicas (archive, offset, copies, page_id, digest) differ: archive, offset, page_id, status (altered,
    missing or extra in theirs), expected and found (hashes). Archives and offsets are where ours has a record, or theirs if ours has
    none. Equal replicas give no rows, as do empty ones."""
    columns = ["archive", "offset", "copies", "page_id", "digest"]
    ours, theirs = ours.select(columns), theirs.select(columns)
    end = ours.unionByName(theirs).agg(F.max("offset").alias("n")).first().n
    height, top = 0, (end or 0) // leaf_bytes
    while top:
        top, height = top // fan_out, height + 1
    a, b = (tree(x, height, leaf_bytes, fan_out) for x in (ours, theirs))
    differs = None
    for level in range(height, -1, -1):
        x, y = (t[level].withColumnRenamed("hash", n) for t, n in ((a, "mine"), (b, "other")))
        if differs is not None:
            # Only children of nodes that differ.
            parents = differs.select("archive", F.col("node").alias("parent"))
            x, y = (t.withColumn("parent", F.floor(F.col("node") / fan_out)).join(parents, ["archive", "parent"], "left_semi").drop("parent") for t in (x, y))
        differs = materialize(x.join(y, ["archive", "node"], "full").where(~F.col("mine").eqNullSafe(F.col("other"))).select("archive", "node"), "merkle-differs")
    inside = lambda t, n: t.withColumn("node", F.floor(F.col("offset") / leaf_bytes)).join(differs, ["archive", "node"], "left_semi").select("archive", "offset", F.struct("page_id", "copies", "digest").alias(n))
    met = inside(ours, "o").join(inside(theirs, "t"), ["archive", "offset"], "full").where(~F.col("o").eqNullSafe(F.col("t")))
    status = F.when(F.col("t").isNull(), "missing").when(F.col("o").isNull(), "extra").otherwise("altered")
    return met.select("archive", "offset", F.coalesce("o.page_id", "t.page_id").alias("page_id"), status.alias("status"), F.col("o.digest").alias("expected"), F.col("t.digest").alias("found"))


def damaged(replica: DataFrame, every: int = 53, archives: int = 4) -> DataFrame:
    """A replica whose bytes have decayed at places that hashes choose, in one of so many archives: of every records one has a
    byte changed, one has lost its last two bytes, and one is gone."""
    turn = F.pmod(_number(F.sha2("payload", 256), 9), F.lit(every))
    struck = F.pmod(_number(F.md5(F.col("archive").cast("string").cast("binary")), 1), F.lit(archives)) == 0
    changed = F.concat(F.substring("payload", 1, 7), F.lit("!").cast("binary"), F.expr("substring(payload, 9)"))
    payload = F.when(struck & (turn == 0), changed).when(struck & (turn == 2), F.expr("substring(payload, 1, octet_length(payload) - 2)")).otherwise(F.col("payload"))
    return replica.where(~(struck & (turn == 1))).select("archive", "offset", "page_id", "copies", payload.alias("payload"))
