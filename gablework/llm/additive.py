"""Approximate nearest neighbours by additive quantisation.

A vector is coded as a sum of one entry from each of several full-dimensional codebooks. The codebooks are fitted one
after the other on the residuals of a bounded sample; a vector is encoded by beam search over all of them, and the norm of
its reconstruction is stored. A query's inner products with all entries form lookup tables, by which the coded rows of a
block are scored; the best of a block are ranked again by the exact inner product of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.llm.common import lean, materialize
from gablework.llm.vectors import best, blocks, paired, queries, usable

#: Codebooks and their entries; beams of the encoder; candidates of a block that are ranked exactly, for each result wanted.
BOOKS, ENTRIES, BEAM, RERANK = 16, 256, 3, 12
#: Rows (expected, by hash of vec_id) that the codebooks are fitted on, and rounds of k-means for each.
SAMPLE_ROWS, ROUNDS = 8_000, 8


def fit(sample: np.ndarray, books: int = BOOKS, entries: int = ENTRIES, seed: int = 0) -> np.ndarray:
    """Codebooks (books, entries, dim), each by k-means on what the ones before leave."""
    rng = np.random.default_rng(seed)
    rest, out = sample.copy(), []
    for _ in range(books):
        k = min(entries, len(rest))
        centre = rest[rng.choice(len(rest), k, replace=False)]
        for _ in range(ROUNDS):
            near = _nearest(rest, centre)
            count = np.bincount(near, minlength=k)
            total = np.zeros_like(centre)
            np.add.at(total, near, rest)
            centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
        out.append(np.concatenate((centre, np.zeros((entries - k, sample.shape[1])))))
        rest = rest - centre[_nearest(rest, centre)]
    return np.stack(out)


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre**2).sum(axis=1) - 2 * (x @ centre.T), axis=1)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, books) by beam search, and the squared norms of what they stand for."""
    n, dim = x.shape
    m, entries, _ = books.shape
    best_codes, norms = [], []
    if not n:
        return np.zeros((0, m), np.uint8), np.zeros(0)
    x, books = x.astype(np.float32), books.astype(np.float32)
    for lo in range(0, n, 2048):
        rest, codes = x[lo : lo + 2048, None, :], np.zeros((min(2048, n - lo), 1, 0), np.uint8)
        for book in books:
            # Squared error of each beam with each entry; the best beams go on.
            cost = (rest.reshape(-1, dim) @ (-2 * book.T)).reshape(*rest.shape[:2], entries)
            cost += ((rest**2).sum(axis=2)[:, :, None] + (book**2).sum(axis=1))
            flat = cost.reshape(len(rest), -1)
            width = min(beam, flat.shape[1])
            at = np.argpartition(flat, width - 1, axis=1)[:, :width]
            at = np.take_along_axis(at, np.argsort(np.take_along_axis(flat, at, 1), axis=1, kind="stable"), 1)
            which, entry = at // entries, at % entries
            codes = np.concatenate((np.take_along_axis(codes, which[:, :, None], 1), entry[:, :, None].astype(np.uint8)), axis=2)
            rest = np.take_along_axis(rest, which[:, :, None], 1) - book[entry]
        best_codes.append(codes[:, 0])
        norms.append(((x[lo : lo + 2048] - rest[:, 0]) ** 2).sum(axis=1))
    return np.concatenate(best_codes), np.concatenate(norms)


def scan(codes: np.ndarray, norms: np.ndarray, books: np.ndarray, queries: np.ndarray, euclidean: bool = False) -> np.ndarray:
    """Scores (rows, queries) from lookup tables: inner products, or by the stored norms minus half the squared distance
    (up to what depends on the query alone)."""
    out = np.zeros((len(codes), len(queries)), np.float32)
    for m, book in enumerate(books):
        table = (book @ queries.T).astype(np.float32)
        out += table[codes[:, m]]
    if euclidean:
        out -= (norms / 2).astype(np.float32)[:, None]
    return out


def search(table: DataFrame, k: int = 20, every: int = 20, rerank: int = RERANK, sample_rows: int = SAMPLE_ROWS, euclidean: bool = False) -> DataFrame:
    """For each row of vec_id and embedding whose vec_id is divisible by every, the k nearest other rows found, by the
    largest inner product: query_id, rank, vec_id, score (that product in double precision, on the original vectors). euclidean: by
    the least distance instead; coded rows are then scored with their stored norms, and score is minus the squared distance.

    Codebooks are fitted on about sample_rows rows of each dimension, chosen by hash; every row is encoded. Null, empty and zero
    vectors, and those that hold null or non-finite components, take no part, nor do rows without an id; vectors meet only
    those of their dimension. Equal vectors have equal codes, so ties go to smaller vec_id. Fewer than k candidates give
    all; an empty table gives none."""
    rows = usable(table, nonzero=True)
    sizes = {r.d: r.n for r in rows.groupBy(F.size("embedding").alias("d")).count().withColumnRenamed("count", "n").collect()}
    spark, models = table.sparkSession, {}
    if sizes:
        part = F.pmod(F.xxhash64(F.lit("codebooks"), "vec_id"), F.lit(1_000_000)).cast("double") / 1e6
        share = F.create_map(*(x for d, n in sizes.items() for x in (F.lit(d), F.lit(min(1.0, sample_rows / n)))))
        got = rows.where(part < share[F.size("embedding")]).select("embedding").toArrow().column("embedding").to_pylist()
        for d in sizes:
            own = np.array([x for x in got if len(x) == d] or np.zeros((1, d)))
            models[d] = fit(own)
    shared = spark.sparkContext.broadcast(models)
    all_blocks = blocks(rows)
    coded_schema = "block long, dim int, n int, ids binary, data binary, codes binary, norms binary"

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, norms = [], []
            for r in range(batch.num_rows):
                x = np.frombuffer(batch.column("data")[r].as_py(), np.float64).reshape(batch.column("n")[r].as_py(), -1)
                c, s = encode(x, shared.value[x.shape[1]])
                codes.append(c.tobytes())
                norms.append(s.astype(np.float64).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(norms, pa.binary())], [*batch.schema.names, "codes", "norms"])

    index = materialize(all_blocks.mapInArrow(lean(coded), coded_schema), "additive-index")
    query_blocks = blocks(queries(rows, every), 4096)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name: batch.column(name)[r].as_py()  # noqa: B023, E731
                ids, query_ids = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("q_ids"), np.int64)
                x = np.frombuffer(get("data"), np.float64).reshape(len(ids), -1)
                asked = np.frombuffer(get("q_data"), np.float64).reshape(len(query_ids), -1)
                books = shared.value[x.shape[1]]
                codes = np.frombuffer(get("codes"), np.uint8).reshape(len(ids), -1)
                norms = np.frombuffer(get("norms"), np.float64)
                wanted = min(len(ids), rerank * k + 1)
                q, v, s = [], [], []
                for lo in range(0, len(asked), 128):
                    part = asked[lo : lo + 128]
                    rough = scan(codes, norms, books, part, euclidean)
                    # Falling score, then position (ids are ascending), as one number.
                    bits = rough.T.copy().view(np.int32).astype(np.int64)
                    bits = np.where(bits < 0, -(bits & 0x7FFFFFFF), bits)
                    key = -(bits << 28) + np.arange(len(ids))
                    at = np.argpartition(key, wanted - 1, axis=1)[:, :wanted] if wanted < len(ids) else np.tile(np.arange(len(ids)), (len(part), 1))
                    exact = np.einsum("qd,qcd->qc", part, x[at])
                    if euclidean:
                        exact = 2 * exact - (part**2).sum(axis=1)[:, None] - (x[at] ** 2).sum(axis=2)
                    exact[ids[at] == query_ids[lo : lo + 128, None]] = -np.inf
                    for own, places, score in zip(query_ids[lo : lo + 128].tolist(), at, exact, strict=True):
                        order = np.lexsort((ids[places], -score))[:k]
                        order = order[np.isfinite(score[order])]
                        q.append(np.full(len(order), own))
                        v.append(ids[places[order]])
                        s.append(score[order])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (q, v, s)], ["query_id", "vec_id", "score"])

    found = paired(index, query_blocks).mapInArrow(lean(nearest), "query_id long, vec_id long, score double")
    return best(found, k, F.col("score"))
