"""Exact top-k search by inner product over a bit-sliced index.

Components are quantised to integers. A block's index holds, for each attribute, one bitmap over the block's rows for
each bit of the (shifted, unsigned) value. For a query, the slices of every attribute are added with weights given by the
bits of the query's components, by carry-save adders on whole bitmaps, which gives the score's own slices. The top rows
are selected from the most significant slice downward; rows that tie at the boundary are resolved by vec_id, and the
scores of the rows found are computed again exactly from the integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.llm.common import lean, materialize
from gablework.llm.vectors import BLOCKS, best, blocks, paired, queries, usable

SCALE = 1024


def sliced(values: np.ndarray) -> np.ndarray:
    """The slices (attributes, bits, words) of integers, a row of values each, less each attribute's least value."""
    low = values.min(axis=0)
    width = max(1, int((values.max(axis=0) - low).max()).bit_length())
    shifted, words = (values - low).astype(np.uint64), -(-len(values) // 64)
    return np.stack([np.stack([_bitmap(column >> np.uint64(b) & np.uint64(1), words) for b in range(width)]) for column in shifted.T])


class SlicedIndex:
    def __init__(self, ids: np.ndarray, slices: np.ndarray):
        """ids: ascending, one for each row."""
        self.ids, self.slices = ids, slices
        _, self.width, self.words = slices.shape
        # A slice's complement is over the block's rows.
        self.all = _bitmap(np.ones(len(ids), np.uint64), self.words)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the score, least significant first. Negative components add the complement of a slice: both
        differ from the true score by the same amount in every row."""
        columns: dict[int, list[np.ndarray]] = {}
        size = np.abs(query)
        for b in range(int(size.max()).bit_length()) if len(size) else []:
            for negative in (False, True):
                own = np.flatnonzero((size >> b & 1 == 1) & ((query < 0) == negative))
                if len(own):
                    for j in range(self.width):
                        planes = self.slices[own, j]
                        columns.setdefault(b + j, []).append(planes ^ self.all if negative else planes)
        out, at = [], 0
        while columns:
            stack = columns.pop(at, None)
            planes = np.concatenate(stack) if stack else np.zeros((0, self.words), np.uint64)
            # Three planes become a sum here and a carry in the next column, until one is left.
            while len(planes) > 1:
                third = len(planes) // 3
                if third:
                    a, b, c = planes[:third], planes[third : 2 * third], planes[2 * third : 3 * third]
                    x = a ^ b
                    total, carry = x ^ c, (a & b) | (x & c)
                    planes = np.concatenate((total, planes[3 * third :]))
                else:
                    a, b = planes
                    carry, planes = (a & b)[None], (a ^ b)[None]
                columns.setdefault(at + 1, []).append(carry)
            out.append(planes[0] if len(planes) else np.zeros(self.words, np.uint64))
            at += 1
        return out

    def top(self, query: np.ndarray, k: int, own_id: int | None = None) -> np.ndarray:
        """Positions of the k rows with the largest scores, ties to smaller ids; own_id takes no part."""
        equal, above = self.all.copy(), np.zeros(self.words, np.uint64)
        if own_id is not None:
            for at in range(int(np.searchsorted(self.ids, own_id)), int(np.searchsorted(self.ids, own_id, "right"))):
                equal[at >> 6] &= ~np.uint64(1 << (at & 63))
        for plane in reversed(self.scores(query)):
            high = equal & plane
            n = int(np.bitwise_count(above).sum() + np.bitwise_count(high).sum())
            if n > k:
                equal = high
            else:
                above |= high
                equal = equal & ~plane
                if n == k:
                    equal = np.zeros_like(equal)
                    break
        sure = _positions(above)
        return np.concatenate((sure, _positions(equal)[: k - len(sure)]))


def _bitmap(bits: np.ndarray, words: int) -> np.ndarray:
    full = np.zeros(words * 64, np.uint8)
    full[: len(bits)] = bits
    return np.packbits(full, bitorder="little").view(np.uint64)


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_k(table: DataFrame, k: int = 10, every: int = 100, scale: int = SCALE) -> DataFrame:
    """For each row of vec_id and embedding whose vec_id is divisible by every, the k other rows with the largest
    integer inner product of floor(scale * x): query_id, rank, vec_id, score.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id; vectors
    meet only those of their dimension. Scores must fit into 64 bits. Rows that repeat a vec_id are candidates each, but
    never for a query of that id, and ask once. Fewer than k candidates give all; an empty table gives none."""
    rows = usable(table, nonzero=False).withColumn("embedding", F.transform("embedding", lambda x: F.floor(x * scale).cast("long")))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slices = [sliced(np.frombuffer(d.as_py(), np.int64).reshape(n, -1)) for d, n in zip(batch.column("data"), batch.column("n").to_pylist(), strict=True)]
            widths = pa.array([x.shape[1] for x in slices], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, widths, pa.array([x.tobytes() for x in slices], pa.binary())], [*batch.schema.names, "width", "slices"])

    index = materialize(blocks(rows).mapInArrow(lean(indexed), f"{BLOCKS}, width int, slices binary"), "sliced-index")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name: batch.column(name)[r].as_py()  # noqa: B023, E731
                ids = np.frombuffer(get("ids"), np.int64)
                values = np.frombuffer(get("data"), np.int64).reshape(len(ids), -1)
                held = SlicedIndex(ids, np.frombuffer(get("slices"), np.uint64).reshape(values.shape[1], get("width"), -1))
                query_ids = np.frombuffer(get("q_ids"), np.int64)
                asked = np.frombuffer(get("q_data"), np.int64).reshape(len(query_ids), -1)
                q, v, s = [], [], []
                for own, query in zip(query_ids.tolist(), asked, strict=True):
                    at = held.top(query, k, own)
                    q.append(np.full(len(at), own))
                    v.append(ids[at])
                    s.append(values[at] @ query)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (q, v, s)], ["query_id", "vec_id", "score"])

    found = paired(index, blocks(queries(rows, every), 4096)).mapInArrow(lean(search), "query_id long, vec_id long, score long")
    return best(found, k, F.col("score"))
