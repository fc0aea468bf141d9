"""Blocks of vectors, and the pairing of query blocks with blocks of all rows.

A block packs up to BLOCK rows of one dimension into binary values. Every block of candidates meets every block of
queries, as a stated query set against all rows does; a block of queries is sent to the groups into which the candidates'
blocks are dealt, so that pairs of blocks spread over tasks and neither side is broadcast or collected."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.llm.common import lean

BLOCK = 16_384
BLOCKS = "block long, dim int, n int, ids binary, data binary"


def usable(table: DataFrame, nonzero: bool, *others: Column) -> DataFrame:
    """vec_id, embedding as doubles and others, without rows whose id is null or whose vector is null, empty, holds null or
    non-finite components, or (nonzero) is all zeros."""
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), *others)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~bad
    return rows.where(good & F.exists("embedding", lambda x: x != 0.0) if nonzero else good)


def queries(rows: DataFrame, every: int) -> DataFrame:
    """Rows whose vec_id is divisible by every, one for each vec_id (the least vector, if rows repeat an id)."""
    own = rows.where(F.col("vec_id") % every == 0)
    repeated = own.groupBy("vec_id").count().where("count > 1").limit(1).count()
    return own.groupBy("vec_id").agg(F.min("embedding").alias("embedding")) if repeated else own


def blocks(rows: DataFrame, rows_in_block: int = BLOCK) -> DataFrame:
    """Pack each task's rows, by dimension and in order of vec_id. block: task number and count, unique."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, held = TaskContext.get().partitionId() << 32, 0, {}

        def close(dim: int) -> pa.RecordBatch:
            nonlocal count
            ids, data = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            order = np.argsort(ids, kind="stable")
            count += 1
            row = (base + count, dim, len(ids), ids[order].tobytes(), data[order].tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["block", "dim", "n", "ids", "data"])

        for batch in batches:
            ids, lists = batch.column("vec_id").to_numpy(), batch.column("embedding")
            sizes = np.diff(np.asarray(lists.offsets))
            flat = np.asarray(lists.flatten())
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                data = flat[starts[own][:, None] + np.arange(dim)]
                for k in range(0, len(own), rows_in_block):
                    held.setdefault(dim, []).append((ids[own[k : k + rows_in_block]], data[k : k + rows_in_block]))
                    if sum(len(x[0]) for x in held[dim]) >= rows_in_block:
                        yield close(dim)
        for dim in list(held):
            yield close(dim)

    return rows.mapInArrow(lean(packed), BLOCKS)


def paired(candidates: DataFrame, asked: DataFrame) -> DataFrame:
    """Each block of candidates (a written table) with each block of queries of its dimension (columns of asked get a q_ before).
    Candidates are dealt to about as many groups as they have blocks."""
    sizes = {r["dim"]: r["count"] for r in candidates.groupBy("dim").count().collect()}
    if not sizes:
        return candidates.select(*candidates.columns, *(F.lit(None).cast(t).alias(f"q_{c}") for c, t in asked.dtypes)).drop("dim", "q_dim")
    groups = F.create_map(*(F.lit(x) for item in sizes.items() for x in item))
    mine = asked.select(*(F.col(c).alias(f"q_{c}") for c in asked.columns)).where(groups[F.col("q_dim")].isNotNull())
    sent = mine.withColumn("to", F.explode(F.sequence(F.lit(0), groups[F.col("q_dim")].cast("int") - 1)))
    held = candidates.withColumn("of", F.pmod(F.xxhash64("block"), groups[F.col("dim")].cast("long")).cast("int"))
    return sent.join(held, (F.col("q_dim") == F.col("dim")) & (F.col("to") == F.col("of"))).drop("to", "of", "dim", "q_dim")


def best(found: DataFrame, k: int, score: Column) -> DataFrame:
    """The k best rows of each query, best first, ties to smaller vec_id. A query has k rows from each block at most."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(score.desc(), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
