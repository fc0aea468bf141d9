"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Documents are cut into full windows, which need no padding, and a remainder. The remainders of a batch are dealt
to k windows by the differencing method: partial partitions (k sums each) wait in a heap by their spread; the two
with the widest spread are merged, the fullest windows of one onto the emptiest of the other, until one partition is
left. If its fullest window exceeds the capacity, k rises by one and the batch is dealt again. A batch is closed by a
cut where its windows come out nearly full, and the batch's short pieces (a few remainders cut small) let the method
even the windows out to a few tokens. What a task has left over at its end is dealt likewise to as many windows as it
fills. What is beyond them, about a window's tokens of each task, is gathered from POOLED tasks and dealt once more; only
what is left of that, a window's tokens or less, is cut into windows whose lengths are powers of two, which stay unpadded.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.common import Scratch, crc_of_ids, lean, short_batches
from gablework.llm.tokens import encoder, with_end

#: Tokens of a window; windows of a batch; tokens that a full batch leaves free in all.
CAPACITY, WINDOWS, SLACK = 2048, 64, 256
#: So many of a batch's remainders are cut for short pieces of these lengths.
EVENED, SHORT = 32, (128, 64, 32, 16, 8, 4, 2, 1)
#: Tokens that each window of a task's rest leaves free (the first number that does), and the step in which what is beyond those
#: windows is taken.
FREE, STEP = (4, 16, 64, 160), 32
#: Tasks whose rests are dealt together.
POOLED = 512


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Deal sizes to k windows: each item's window and the windows' sums."""
    n = len(sizes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(k, np.int64)
    # A node's slots are ordered by falling sums. Leaves: the item is in slot 0.
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i, x in enumerate(np.asarray(sizes, np.int64).tolist()):
        v = np.zeros(k, np.int64)
        v[0] = x
        sums[i] = v
        heap.append((-x, i))
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        node = n + len(merged)
        merged.append((a, b, order))
        sums[node] = total
        heapq.heappush(heap, (int(total[-1] - total[0]), node))
    # From the root down: which window each slot of a node is.
    root = heap[0][1]
    where = {root: np.arange(k)}
    for node in range(n + len(merged) - 1, n - 1, -1):
        a, b, order = merged[node - n]
        slots = where.pop(node)
        own = np.empty(k, np.int64)
        own[order] = slots
        where[a], where[b] = own, own[::-1]
    window = np.fromiter((where[i][0] for i in range(n)), np.int64, n)
    return window, np.bincount(window, weights=sizes, minlength=k).astype(np.int64)


def deal(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Windows for pieces of at most the capacity; the number of windows rises until none is exceeded."""
    k = max(1, -(-int(np.sum(sizes)) // capacity))
    while True:
        window, sums = differencing(sizes, k)
        if not len(sums) or sums.max() <= capacity:
            return window, k
        k += 1


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs one task's documents; place() and finish() return pieces (document, start, length, window, offset)."""

    def __init__(self, capacity: int = CAPACITY, windows: int = WINDOWS, slack: int = SLACK):
        self.capacity, self.full, self.next = capacity, windows * capacity - slack, 0
        self.short = [x for x in SHORT if x < capacity // 4]
        self.open: list[tuple[int, int, int]] = []
        self.held = 0

    def place(self, doc: int, size: int) -> list[tuple[int, int, int, int, int]]:
        out, at = [], 0
        while size - at >= self.capacity:
            out.append((doc, at, self.capacity, self.next, 0))
            self.next += 1
            at += self.capacity
        while at < size:
            n = min(size - at, self.full - self.held)
            self.open.append((doc, at, n))
            self.held += n
            at += n
            if self.held == self.full:
                out += self._close()
        return out

    def _close(self) -> list[tuple[int, int, int, int, int]]:
        """Deal a full batch."""
        pieces, self.open, self.held = self.open, [], 0
        return self._deal(pieces, EVENED)

    def _deal(self, pieces, spare: int) -> list[tuple[int, int, int, int, int]]:
        cut = self._shortened(pieces, spare)
        return self._lay(cut, *deal(np.array([x[2] for x in cut]), self.capacity))

    def _shortened(self, pieces, spare: int) -> list[tuple[int, int, int]]:
        """Pieces, of which the longest give the short pieces by which windows even out."""
        cut = []
        for doc, at, n in sorted(pieces, key=lambda x: -x[2]):
            if spare and n > 2 * sum(self.short):
                spare -= 1
                for x in self.short:
                    cut.append((doc, at, x))
                    at, n = at + x, n - x
            cut.append((doc, at, n))
        return cut

    def _lay(self, pieces, window, k) -> list[tuple[int, int, int, int, int]]:
        out, ends = [], [0] * k
        for (doc, at, n), w in zip(pieces, window.tolist(), strict=True):
            out.append((doc, at, n, self.next + w, ends[w]))
            ends[w] += n
        self.next += k
        return out

    def finish(self) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
        """Deal the rest to as many windows as it fills: the pieces, and what is beyond those windows (document, start, length)."""
        k, out = self.held // self.capacity, []
        # Each window stays free by a few tokens, or by more where few pieces don't even out.
        for free in FREE if k else (0,):
            kept, cut = self._beyond(k, free)
            pieces = self._shortened(kept, max(4, EVENED * k // WINDOWS))
            if pieces:
                window, n = deal(np.array([x[2] for x in pieces]), self.capacity)
                if n > k and free != FREE[-1]:
                    continue
                out = self._lay(pieces, window, n)
            break
        self.open, self.held = [], 0
        return out, cut

    def _beyond(self, k: int, free: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """The open pieces that k windows hold, each but for free tokens, and what is beyond: in steps, so that no window of it is tiny."""
        kept, cut, left = list(self.open), [], self.held
        if k:
            step = min(STEP, self.capacity // 8)
            left = max(0, -(-(self.held - k * self.capacity + free * k) // step) * step)
        while left:
            doc, at, n = kept.pop()
            x = min(n, left)
            left -= x
            cut.append((doc, at + n - x, x))
            if n > x:
                kept.append((doc, at, n - x))
        return kept, cut

    def unpadded(self, cut: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
        """Windows of powers of two."""
        out, room, w, used = [], powers(sum(n for _, _, n in cut)), 0, 0
        for doc, at, n in cut:
            while n:
                x = min(n, room[w] - used)
                out.append((doc, at, x, self.next + w, used))
                at, n, used = at + x, n - x, used + x
                if used == room[w]:
                    w, used = w + 1, 0
        self.next += len(room)
        return out


PIECES = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack(docs: DataFrame, vocabulary: str, end_id: int, blank_counts: bool = True, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents in sequences of at most capacity tokens: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Each task packs its own partition in one pass and holds one Arrow batch and one open batch of windows; only its rest, less than two
    windows' tokens, is shuffled. A null text counts as empty; every document has end_id appended, so an empty one is a single
    token. Repeated rows are packed each; other columns are ignored; an empty table gives none. sequence_id is the task's partition number
    times 2**40 plus the task's own count; for pooled rests 2**62 is added."""
    short_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    schema = T.StructType([*PIECES, T.StructField("part", T.LongType()), T.StructField("ids", T.BinaryType())])

    def batch_of(out, base: int, of) -> list[list[int]]:
        """Columns of pieces; of: a document's id, ids, where they begin and how many it has in all."""
        own = [of[x[0]] for x in out]
        return [
            [d for d, *_ in own],
            [first + x[1] for x, (_, _, first, _) in zip(out, own, strict=True)],
            [x[2] for x in out],
            [crc_of_ids(ids[x[1] : x[1] + x[2]]) for x, (_, ids, _, _) in zip(out, own, strict=True)],
            [total for *_, total in own],
            [base + x[3] for x in out],
            [x[4] for x in out],
        ]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer = encoder(vocabulary, blank_counts), Packer(capacity)
        kept: dict[int, tuple[int | None, np.ndarray, int, int]] = {}
        count = 0

        def rows(out, ids=None) -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in batch_of(out, part << 40, kept)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(out), pa.int64()), pa.array(ids or [None] * len(out), pa.binary())], schema.names)

        for batch in batches:
            ids, ends = with_end(*encode(batch.column("text")), end_id)
            out = []
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = ids[ends[k] : ends[k + 1]]
                kept[count] = (doc, own, 0, len(own))
                out += packer.place(count, len(own))
                count += 1
            if out:
                yield rows(out)
            # Only documents in the open batch of windows are needed again.
            kept = {x[0]: (kept[x[0]][0], kept[x[0]][1].copy(), *kept[x[0]][2:]) for x in packer.open}
        out, cut = packer.finish()
        if out:
            yield rows(out)
        if cut:
            yield rows([(doc, at, n, 0, 0) for doc, at, n in cut], [kept[doc][1][at : at + n].astype("<u4").tobytes() for doc, at, n in cut])

    def pooled(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        get = lambda c: table.column(c).to_pylist()
        of = [(d, np.frombuffer(ids, "<u4"), start, total) for d, ids, start, total in zip(get("doc_id"), get("ids"), get("start"), get("doc_tokens"), strict=True)]
        packer, out = Packer(capacity), []
        for k, x in enumerate(of):
            out += packer.place(k, len(x[1]))
        more, cut = packer.finish()
        out += more
        out += packer.unpadded(cut)
        columns = batch_of(out, (1 << 62) + (get("part")[0] // POOLED << 40), of)
        return pa.table([pa.array(c, pa.int64()) for c in columns], PIECES.names)

    placed = scratch.table(docs.select("doc_id", "text").mapInArrow(lean(pieces), schema), "pieces")
    rest = placed.where("ids is not null").groupBy(F.floor(F.col("part") / POOLED)).applyInArrow(pooled, PIECES)
    return placed.where("ids is null").select(*PIECES.names).union(rest)
