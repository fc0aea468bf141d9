"""Hard negatives by rotated one-bit codes with deterministic intervals.

A block's index holds for each vector, less the nearest of the block's centres and rotated by a fixed orthogonal matrix, the signs of its
components as one bit each (the code), the inner product of the vector with its code as a unit vector (the alignment) and the length of what
the code leaves over (the residual). A query is rotated and its components are put on a grid of BITS bits, so its inner product with a code is a
few popcounts. Inner products then lie in an interval around alignment times estimate, whose width is what the grid leaves over and, by
Cauchy-Schwarz, the query's part across the code times the residual. Rows whose interval can't reach what is asked for go; the integers of
all others are multiplied out, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablework.llm.common import Scratch, lean
from gablework.llm.vectors import BLOCKS, best, blocks, paired, queries, usable

SCALE, ANCHORS = 256, 100
#: Positives of an anchor, and negatives of each of them.
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least LOW and at most HIGH hundredths of the positive's.
LOW, HIGH = 80, 100
#: Bits of a query's component.
BITS = 6
#: A block's centres at most, rows for each of them at least, and rounds in which they are fitted to the block.
CENTRES, ROWS_EACH, ROUNDS = 64, 16, 4
#: Part of the lengths' product that covers what rounding can add to an interval.
ROUNDING = 1e-9
_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    if dim not in _ROTATIONS:
        _ROTATIONS.clear()
        _ROTATIONS[dim] = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))[0]
    return _ROTATIONS[dim]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as (words, rows) of 64 bits each."""
    n, dim = bits.shape
    full = np.zeros((n, -(-dim // 64) * 64), np.uint8)
    full[:, :dim] = bits
    return np.ascontiguousarray(np.packbits(full, axis=1, bitorder="little").view(np.uint64).T)


def _centres(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's centres, fitted to all its rows from some of them, and the nearest centre of each row."""
    n, dim = values.shape
    k = max(1, min(CENTRES, n // ROWS_EACH))
    centres = values[np.arange(k) * n // k]
    for _ in range(ROUNDS):
        cell = np.argmin(np.square(centres).sum(axis=1) - 2 * (values @ centres.T), axis=1)
        held = np.bincount(cell, minlength=k)
        sums = np.stack([np.bincount(cell, weights=column, minlength=k) for column in values.T], axis=1)
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres, np.argmin(np.square(centres).sum(axis=1) - 2 * (values @ centres.T), axis=1)


class Codes:
    """The one-bit codes of a block of integer vectors, a row each."""

    def __init__(self, values: np.ndarray):
        n, dim = values.shape
        self.centres, self.cell = _centres(values.astype(np.float64))
        turned = (values - self.centres[self.cell]) @ rotation(dim)
        self.codes = _packed(turned > 0)
        self.align = np.abs(turned).sum(axis=1) / np.sqrt(dim)
        self.rest = np.sqrt(np.maximum(np.square(turned).sum(axis=1) - np.square(self.align), 0))

    def to_bytes(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.codes, self.cell, self.align, self.rest, self.centres))

    @classmethod
    def from_bytes(cls, data: bytes, n: int, dim: int) -> Codes:
        out, words = cls.__new__(cls), -(-dim // 64)
        out.codes = np.frombuffer(data, np.uint64, words * n).reshape(-1, n)
        out.cell = np.frombuffer(data, np.int64, n, 8 * words * n)
        real = np.frombuffer(data, np.float64, offset=8 * (words + 1) * n)
        out.align, out.rest, out.centres = real[:n], real[n : 2 * n], real[2 * n :].reshape(-1, dim)
        return out

    def intervals(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Between what the inner products of all rows with an integer query lie."""
        dim = len(query)
        turned = query @ rotation(dim)
        low = turned.min()
        step = (turned.max() - low) / ((1 << BITS) - 1) or 1.0
        grid = np.rint((turned - low) / step).astype(np.int64)
        held = np.bitwise_count(self.codes).sum(axis=0, dtype=np.int64) * low
        for b in range(BITS):
            plane = _packed((grid >> b & 1)[None])
            held += np.bitwise_count(self.codes & plane).sum(axis=0, dtype=np.int64) * (step * (1 << b))
        near = (2 * held - (low * dim + step * grid.sum())) / np.sqrt(dim)
        off = np.abs(turned - (low + step * grid)).sum() / np.sqrt(dim)
        size = float(np.square(query.astype(float)).sum())
        across = np.sqrt(np.maximum(size - np.square(np.maximum(np.abs(near) - off, 0)), 0))
        middle = (self.centres @ query)[self.cell] + self.align * near
        reach = np.hypot(self.align, self.rest) + np.linalg.norm(self.centres, axis=1)[self.cell]
        half = self.align * off + across * self.rest + ROUNDING * (np.sqrt(size) * reach + 1)
        return middle - half, middle + half


def _nth(values: np.ndarray, n: int) -> float:
    """The n-th largest, or less than all if there are fewer."""
    return float(np.partition(values, len(values) - n)[len(values) - n]) if len(values) >= n else -np.inf


def _first(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:n]


class Block:
    """A block's rows: ids, labels, integers and codes."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, index: bytes):
        self.ids, self.labels, self.values = ids, values[:, 0], values[:, 1:]
        self.codes = Codes.from_bytes(index, len(ids), self.values.shape[1])

    def positives(self, own: int, label: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k first other rows of the label."""
        low, high = self.codes.intervals(query)
        rows = np.flatnonzero((self.labels == label) & (self.ids != own))
        rows = rows[high[rows] >= _nth(low[rows], k)]
        scores = self.values[rows] @ query
        at = _first(self.ids[rows], scores, k)
        return rows[at], scores[at]

    def negatives(self, label: int, query: np.ndarray, against: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each positive's score, places and scores of the k first rows of other labels within its bounds."""
        low, high = self.codes.intervals(query)
        other, asked = self.labels != label, [int(x) for x in against]
        wanted = np.zeros(len(self.ids), bool)
        for score in set(asked):
            least, most = LOW * score / 100, HIGH * score / 100
            may = other & (high >= least) & (low <= most)
            sure = low[may & (low >= least) & (high <= most)]
            wanted |= may & (high >= _nth(sure, k))
        rows = np.flatnonzero(wanted)
        scores = self.values[rows] @ query
        out = []
        for score in asked:
            fit = np.flatnonzero((100 * scores >= LOW * score) & (100 * scores <= HIGH * score))
            at = fit[_first(self.ids[rows[fit]], scores[fit], k)]
            out.append((rows[at], scores[at]))
        return out


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """Each block of candidates with its ids and rows of queries."""
    for batch in batches:
        for r in range(batch.num_rows):
            get = lambda name: batch.column(name)[r].as_py()  # noqa: B023, E731
            ids, asked = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("q_ids"), np.int64)
            block = Block(ids, np.frombuffer(get("data"), np.int64).reshape(len(ids), -1), get("codes"))
            yield block, asked, np.frombuffer(get("q_data"), np.int64).reshape(len(asked), -1)


def hard_negatives(table: DataFrame, label: str = "label", every: int = ANCHORS, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every row whose vec_id is divisible by every, its
    first positives of the same label by integer inner product of floor(scale * x), and for each of them the first rows of other
    labels with LOW to HIGH hundredths of its score, higher scores first, ties to smaller vec_id.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part; vectors meet only those of
    their dimension. Scores must fit into 64 bits, times 100. Of rows that repeat an anchor's vec_id the one with the least label and
    vector asks; none of them is its positive, and one of another label can be its negative. An anchor without a positive, and a positive without a negative, give
    no row; an empty table gives none. Other columns are ignored."""
    scratch = Scratch(table.sparkSession)
    integers = F.transform("embedding", lambda x: F.floor(x * scale).cast("long"))
    # The label is the first component of a packed row.
    rows = usable(table, False, F.col(label).cast("long").alias("own_label")).where("own_label is not null")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.concat(F.array("own_label"), integers).alias("embedding"))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [Codes(np.frombuffer(d.as_py(), np.int64).reshape(n, -1)[:, 1:]).to_bytes() for d, n in zip(batch.column("data"), batch.column("n").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], [*batch.schema.names, "codes"])

    index = scratch.table(blocks(rows).mapInArrow(lean(indexed), f"{BLOCKS}, codes binary"), "codes")
    anchors = scratch.table(queries(rows, every), "anchors")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, asked in _blocks_of(batches):
            out = [(own, *block.positives(own, row[0], row[1:], positives)) for own, row in zip(ids.tolist(), asked, strict=True)]
            columns = (np.concatenate(x) for x in ([np.full(len(at), own) for own, at, _ in out], [block.ids[at] for _, at, _ in out], [s for _, _, s in out]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    found = best(paired(index, blocks(anchors, 4096)).mapInArrow(lean(near), "query_id long, vec_id long, score long"), positives, F.col("score"))
    own = found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("own"))
    # A packed row of the second search: label, number of positives, their ids and scores (filled up), components.
    filled = lambda c: F.slice(F.concat(F.transform("own", lambda x: x[c]), F.array_repeat(F.lit(0).cast("long"), positives)), 1, positives)
    head = F.concat(F.slice("embedding", 1, 1), F.array(F.size("own").cast("long")), filled("vec_id"), filled("score"))
    second = anchors.join(own, F.col("vec_id") == F.col("query_id")).select("vec_id", F.concat(head, F.slice("embedding", 2, F.size("embedding"))).alias("embedding"))
    second = scratch.table(second, "positives")
    width = 2 + 2 * positives
    names = ["anchor_id", "k", "positive_id", "negative_id", "positive_score", "negative_score"]

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, asked in _blocks_of(batches):
            out = []
            for anchor, row in zip(ids.tolist(), asked, strict=True):
                n = int(row[1])
                partners, scores = row[2 : 2 + n], row[2 + positives : 2 + positives + n]
                for k, (at, s) in enumerate(block.negatives(int(row[0]), row[width:], scores, negatives)):
                    out.append([np.full(len(at), x) for x in (anchor, k, partners[k])] + [block.ids[at], np.full(len(at), scores[k]), s])
            columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    met = paired(index, blocks(second, 4096).withColumn("dim", F.col("dim") - (width - 1)))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "k").orderBy(F.col("negative_score").desc(), "negative_id"))
    mined_rows = met.mapInArrow(lean(mined), ", ".join(f"{n} long" for n in names)).withColumn("rank", rank).where(F.col("rank") <= negatives)
    out = scratch.table(mined_rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    scratch.drop(out)
    return out
