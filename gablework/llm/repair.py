"""Token-id files compressed by pair replacement (Re-Pair), a grammar for each shard.

Pairs of neighbouring symbols become new symbols (nonterminals) by falling frequency: a round takes the most frequent pair and
those at least 1 / SPREAD as frequent, the more frequent first where two overlap, and counts again; it ends when no pair
is used so often that its rule pays. Only pairs that were frequent before or hold a new symbol are counted again, as
no other pair's count can rise.

Shard blob, little-endian: the magic RPG2; six u32 (terminals, rules, symbols in the sequence, ids, rounds, bytes of a
sequence symbol); the terminals as u32; the rules as u32 pairs; their expansion lengths as u32; the end of each
round in the rules as u32; the sequence as u16 or u32. Shards lie in Parquet files, a row each, beside the ids of
their documents and the documents' lengths.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.common import crc_of_ids, lean, ranges, shared_dir, short_batches
from gablework.llm.tokens import encoder, with_end

MAGIC = b"RPG2"
#: Ids after which a shard is closed (documents stay whole).
SHARD_IDS = 1_000_000
#: Uses from which a rule pays: it takes 12 bytes, and each use saves a symbol of two bytes.
MIN_USES = 6
#: A round takes pairs down to this part of the most frequent one's uses.
SPREAD = 32
#: Room of a worker's encoder: most of the ids' work is to encode words that it doesn't remember.
ROOM = 4


def compress(ids: np.ndarray, min_uses: int = MIN_USES, spread: int = SPREAD) -> bytes:
    """The shard blob of a sequence of ids below 2**32."""
    ids = np.asarray(ids, np.uint32)
    if len(ids) and int(ids.max()) < 1 << 22:
        terminals = np.flatnonzero(np.bincount(ids))
        code = np.zeros(int(terminals[-1]) + 1, np.uint32)
        code[terminals] = np.arange(len(terminals))
        seq = code[ids]
    else:
        terminals, seq = np.unique(ids, return_inverse=True)
        seq = seq.astype(np.uint32)
    n, rules, ends = len(terminals), [], []
    size = [np.ones(n, np.int64)]
    alive = np.ones(len(seq), bool)
    while (made := _round(seq, alive, n, min_uses, spread)) is not None:
        seq, alive, pairs = made
        lengths = np.concatenate(size)
        size = [lengths, lengths[pairs[:, 0]] + lengths[pairs[:, 1]]]
        rules.append(pairs)
        n += len(pairs)
        ends.append(n - len(terminals))
    pairs = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    width = 2 if n <= 65_536 else 4
    head = struct.pack("<6I", len(terminals), len(pairs), len(seq), len(ids), len(ends), width)
    lengths = np.concatenate(size)[len(terminals) :]
    parts = (terminals.astype("<u4"), pairs.astype("<u4"), lengths.astype("<u4"), np.asarray(ends, "<u4"), seq.astype(f"<u{width}"))
    return MAGIC + head + b"".join(x.tobytes() for x in parts)


def _groups(seq: np.ndarray, at: np.ndarray, n: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of pairs (beginning at at) that can be used least times or more, sorted by pair and position; for each pair, the number
    of its positions and its uses."""
    left, right = seq[at], seq[at + 1]
    if n <= 1 << 20 and len(seq) <= 1 << 24:
        packed = (left.astype(np.uint64) << np.uint64(44)) | (right.astype(np.uint64) << np.uint64(24)) | at.astype(np.uint64)
        packed.sort()
        key, at = packed >> np.uint64(24), (packed & np.uint64((1 << 24) - 1)).astype(np.int64)
    else:
        key = (left.astype(np.uint64) << np.uint64(32)) | right
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(key)))
    uses = lengths
    follows = np.flatnonzero(~new[1:] & (at[1:] == at[:-1] + 1)) + 1
    if len(follows):
        # Of a run of one symbol, every second pair counts.
        begins = np.ones(len(at), bool)
        begins[follows] = False
        runs = np.flatnonzero(begins)
        place = np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))
        uses = np.add.reduceat((place % 2 == 0).astype(np.int64), heads)
    often = uses >= least
    kept, lengths = np.repeat(often, lengths), lengths[often]
    return at[kept], lengths, uses[often]


def _round(seq: np.ndarray, alive: np.ndarray, n: int, least: int, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The shorter sequence, the places where a pair has to be counted, and the pairs that became symbols n, n + 1, ...; None if no
    pair is used often enough any more."""
    at = np.flatnonzero(alive[:-1])
    if not len(at):
        return None
    at, lengths, counts = _groups(seq, at, n, least)
    if not len(at):
        return None
    group = np.full(len(seq), -1, np.int32)
    group[at] = np.repeat(np.arange(len(counts), dtype=np.int32), lengths)
    alive = group >= 0
    top = int(counts.max())
    chosen = counts >= max(least, -(-top // spread))
    p, g = _apart(group, chosen, counts)
    used = np.bincount(g, minlength=len(counts))
    live = np.flatnonzero(used >= least)
    if not len(live):
        # Overlaps leave too few of all: the most frequent pair goes alone.
        p, g = _apart(group, np.arange(len(counts)) == counts.argmax(), counts)
        live = g[:1].astype(np.int64)
    symbol = np.full(len(counts), -1, np.int64)
    symbol[live] = n + np.arange(len(live))
    new = symbol[g]
    p, new = p[new >= 0], new[new >= 0]
    first = at[(np.cumsum(lengths) - lengths)[live]]
    pairs = np.stack((seq[first], seq[first + 1]), axis=1)
    seq = seq.copy()
    seq[p] = new
    alive[p] = True
    alive[p[p > 0] - 1] = True
    stays = np.ones(len(seq), bool)
    stays[p + 1] = False
    return seq[stays], alive[stays], pairs


def _apart(group: np.ndarray, chosen: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and groups of chosen pairs, so that no two overlap: the more frequent first, and of a chain of equally frequent ones
    every second."""
    p = np.flatnonzero(np.append(chosen, False)[group])
    uses = counts[group[p]]
    kept = []
    while len(p):
        near = p[1:] == p[:-1] + 1
        same = np.concatenate(([False], near & (uses[1:] == uses[:-1])))
        runs = np.flatnonzero(~same)
        even = (np.arange(len(p)) - np.repeat(runs, np.diff(np.append(runs, len(p))))) % 2 == 0
        wins = even.copy()
        wins[1:] &= ~(near & (uses[:-1] > uses[1:]))
        wins[:-1] &= ~(near & (uses[1:] > uses[:-1]))
        # The first of a chain may win by its place and lose to a more frequent one on its other side.
        wins[1:] &= ~(wins[:-1] & near)
        kept.append(p[wins])
        out = wins.copy()
        out[1:] |= wins[:-1] & near
        out[:-1] |= wins[1:] & near
        p, uses = p[~out], uses[~out]
    p = np.sort(np.concatenate(kept)) if kept else p
    return p, group[p]


class Shard:
    """A shard blob, decoded as a whole or by range."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a shard of this format")
        t, r, s, self.n_ids, k, width = struct.unpack_from("<6I", blob, 4)
        at = 28
        read = lambda kind, n: np.frombuffer(blob, kind, n, at)
        self.terminals = read("<u4", t)
        at += 4 * t
        self.pairs = read("<u4", 2 * r).reshape(-1, 2)
        at += 8 * r
        self.size = np.concatenate((np.ones(t, np.int64), read("<u4", r)))
        at += 4 * r
        self.rounds = read("<u4", k).astype(np.int64)
        at += 4 * k
        self.seq = read(f"<u{width}", s)
        self.ends = np.cumsum(self.size[self.seq])

    def ids(self) -> np.ndarray:
        """All ids. A round's rules name symbols of earlier rounds only, so what they stand for is put together round by round."""
        t, start = len(self.terminals), np.cumsum(self.size) - self.size
        flat = np.zeros(int(self.size.sum()), np.uint32)
        flat[:t] = self.terminals
        for lo, hi in zip([0, *self.rounds.tolist()], self.rounds.tolist(), strict=False):
            parts = self.pairs[lo:hi].reshape(-1).astype(np.int64)
            got = flat[ranges(start[parts], self.size[parts])]
            flat[start[t + lo] : start[t + lo] + len(got)] = got
        return flat[ranges(start[self.seq], self.size[self.seq])]

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi: the symbols that cover them are found by the lengths, and only rules below those are expanded."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.ends, (lo, hi - 1), "right")
        symbol = self.seq[a : b + 1].astype(np.int64)
        place = self.ends[a : b + 1] - self.size[symbol] - lo
        t, out = len(self.terminals), np.zeros(hi - lo, np.uint32)
        while len(symbol):
            inside = (place < hi - lo) & (place + self.size[symbol] > 0)
            symbol, place = symbol[inside], place[inside]
            leaf = symbol < t
            out[place[leaf]] = self.terminals[symbol[leaf]]
            pair, place = self.pairs[symbol[~leaf] - t].astype(np.int64), place[~leaf]
            symbol, place = pair.T.reshape(-1), np.concatenate((place, place + self.size[pair[:, 0]]))
        return out


SHARDS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("part_start", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("doc_sizes", T.ArrayType(T.LongType())),
        T.StructField("grammar", T.BinaryType()),
    ]
)


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, blank_counts: bool = False, shard_ids: int = SHARD_IDS) -> None:
    """Encode doc_id and text and write the shards to path, in ascending order of doc_id (nulls first; ties by a hash of the text, a null
    one first, so that they too are spread).

    Documents are dealt by ranges of that order; a task holds one Arrow batch and the ids of one open shard. Null texts
    count as empty, and every document gets end_id appended; repeated rows are written each, other columns are ignored, and an
    empty table gives no shard."""
    short_batches(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        encode = encoder(vocabulary, blank_counts, ROOM)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal done
            ids, sizes = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
            row = (part, done, len(ids), [i for x in held for i in x[0]], sizes.tolist(), compress(ids))
            done += len(ids)
            held.clear()
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], SHARDS.names)

        for batch in batches:
            ids, rows = with_end(*encode(batch.column("text")), end_id)
            names, lo = batch.column("doc_id").to_pylist(), 0
            while lo < len(names):
                room = shard_ids - sum(len(x[1]) for x in held)
                hi = max(lo + 1, int(np.searchsorted(rows, rows[lo] + room, "right")) - 1)
                held.append((names[lo:hi], ids[rows[lo] : rows[hi]].copy(), np.diff(rows[lo : hi + 1])))
                lo = hi
                if lo < len(names) or sum(len(x[1]) for x in held) >= shard_ids:
                    yield close()
        if held:
            yield close()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    ordered = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text").select("doc_id", "text")
    ordered.mapInArrow(lean(shards), SHARDS).write.parquet(path)


def read_ids(spark: SparkSession, path: str, digest: bool = True, wanted: list[int] | None = None) -> DataFrame:
    """A row for each document of the files: doc_id, start (ids of all documents before it), n_tokens, and either the
    crc32 of its ids (ids_crc32) or the ids themselves.

    wanted: only documents of these doc_ids; shards without them are not decoded, and the others by the ranges of ids alone."""
    shards = spark.read.schema(SHARDS).parquet(path)
    # One row for each task that wrote, so this window and its broadcast hold as many rows as the write had tasks.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as before")
    kind = T.LongType() if digest else T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32" if digest else "ids", kind)])
    if wanted is not None:
        shards = shards.where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, wanted)).cast("array<bigint>")))
    chosen = set(wanted or ())

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch.column("grammar")[k].as_py())
                names, sizes = batch.column("doc_ids")[k].values, np.asarray(batch.column("doc_sizes")[k].values)
                ends = np.cumsum(sizes)
                first = batch.column("before")[k].as_py() + batch.column("part_start")[k].as_py()
                if wanted is None:
                    whole, at = shard.ids(), np.arange(len(sizes))
                    own = [whole[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                else:
                    at = np.array([i for i, x in enumerate(names.to_pylist()) if x in chosen], np.int64)
                    own = [shard.slice(int(ends[i] - sizes[i]), int(ends[i])) for i in at]
                last = pa.array([crc_of_ids(x) for x in own], pa.int64()) if digest else pa.array([x.tolist() for x in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), pa.array((first + ends - sizes)[at], pa.int64()), pa.array(sizes[at], pa.int64()), last], schema.names)

    return shards.join(F.broadcast(before), "part").mapInArrow(lean(documents), schema)


def token_files(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write docs to the shared folder in this format and read them back."""
    path = shared_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, vocabulary, end_id)
    return read_ids(docs.sparkSession, path)
