"""Near-duplicate documents by improved consistent weighted sampling (ICWS) over TF-IDF word shingles.

A document is the weighted set of its five-word shingles; a shingle weighs its count times its inverse document frequency, on
a scale from 1 (in all documents) to 2 (in one). ICWS draws for each of SAMPLES hashes one shingle (at one weight level),
alike in two documents with a chance equal to their weighted Jaccard similarity. Samples are banded; documents that share
a band's samples are candidates; candidates are verified by the exact weighted Jaccard similarity of their whole texts,
and verified links are joined to classes.

Equal texts are one node from the start. A bucket of up to SMALL nodes pairs all of them. In a larger, crowded one all nodes are
paired with a leader first, which joins most families of copies. Crowded buckets of one leader are then a group, and what is
left, nodes outside a group's largest class, is held against all nodes of other classes there, in blocks that meet in many
tasks. A task verifies what agrees, best matches first, and goes on only where no link has joined two nodes' classes yet. So
any two nodes of a bucket end in one class, or agree too little, or have been verified, and no pair is sent but links. The
work on a group grows with its nodes times those outside its largest class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.common import Scratch, lean, ranges, short_batches, text_buffers
from gablework.llm.components import components
from gablework.llm.texts import distinct, hashes, mix, runs, spans

WORDS, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares a band with a chance of 0.99, one of 0.5 with one of 0.32.
BANDS, ROWS = 12, 5
SAMPLES = BANDS * ROWS
SMALL = 16
#: Nodes and bytes of text (expected) of a block of a group of crowded buckets.
BLOCK, BLOCK_BYTES = 1024, 8 << 20
#: Candidates share a band, so as many samples agree at least; all of them are verified, but for those whose total weights alone
#: keep their similarity below the bound.
LEAST_AGREEING = ROWS
#: What rounding can take from a ratio of total weights.
ROUNDED = 1 - 1e-6
#: Counters of each of the sketch's two rows, and the pieces in which they are summed.
SKETCH_BITS, SEGMENTS, FAN_IN = 18, 16, 512

#: Ids of documents with a candidate are broadcast up to this number, and joined by a shuffle of the texts beyond.
BROADCAST_IDS = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_PLACE = mix(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: row, key, count, sorted by row. Words are runs of letters and digits (and all non-ASCII
    characters), in lower case; a text of fewer words than a shingle is one shingle, one without words has none."""
    data, offsets = text_buffers(column)
    parts = []
    for lo, hi in runs(offsets):
        own = offsets[lo : hi + 1] - offsets[lo]
        low = _LOWER[data[offsets[lo] : offsets[hi]]]
        # Accented capitals of the Latin-1 range, two bytes each.
        accents = np.flatnonzero(low[:-1] == 0xC3) + 1 if len(low) else np.zeros(0, np.int64)
        accents = accents[(low[accents] >= 0x80) & (low[accents] <= 0x9E) & (low[accents] != 0x97)]
        low[accents] += 0x20
        starts, ends, first = spans(_LETTER[low], own)
        word = hashes(low, starts, ends)
        count = np.diff(first)
        full = np.maximum(count - WORDS + 1, 0)
        at = ranges(first[:-1], full)
        key = reduce(np.add, (word[at + k] * _PLACE[k] for k in range(WORDS)))
        row = np.repeat(np.arange(hi - lo), full)
        short = np.flatnonzero((count > 0) & (count < WORDS))
        if len(short):
            some = np.zeros(len(short), np.uint64)
            for k in range(WORDS - 1):
                has = count[short] > k
                some[has] += word[first[short[has]] + k] * _PLACE[k]
            key, row = np.concatenate((key, some)), np.concatenate((row, short))
        r, k, n = distinct(row, mix(key), hi - lo)
        parts.append((r + lo, k, n))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _slots(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (key >> np.uint64(44 - SKETCH_BITS)).astype(np.int64), (key & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """A count-min sketch (two rows) of the number of documents with a shingle, over all documents, and their number.

    Each task sums its own counters; they are added up by piece and in two levels, so no task gets more than FAN_IN pieces
    (or the square root of the tasks' number). What comes to the driver has a fixed size."""
    short_batches(docs.sparkSession)
    size, piece = 1 << SKETCH_BITS, (2 << SKETCH_BITS) // SEGMENTS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(2 * size, np.int64), 0
        for batch in batches:
            row, key, _ = shingles(batch.column("text"))
            a, b = _slots(key)
            total[:size] += np.bincount(a, minlength=size)
            total[size:] += np.bincount(b, minlength=size)
            n += len(np.unique(row))
        part = TaskContext.get().partitionId() // FAN_IN
        data = [total[k * piece : (k + 1) * piece].tobytes() for k in range(SEGMENTS)] + [np.int64(n).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(data), pa.int64()), pa.array(range(len(data)), pa.int32()), pa.array(data, pa.binary())], ["part", "segment", "counts"])

    def added(table: pa.Table) -> pa.Table:
        total = 0
        for chunk in table.column("counts").chunks:
            for x in chunk:
                total = total + np.frombuffer(x.as_buffer(), np.int64)
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64()), "segment": pa.array([table.column("segment")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, segment int, counts binary"
    sums = docs.select("text").mapInArrow(lean(counted), schema).groupBy("part", "segment").applyInArrow(added, schema).groupBy("segment").applyInArrow(added, schema)
    got = {r.segment: np.frombuffer(r.counts, np.int64) for r in sums.collect()}
    if not got:
        return np.zeros((2, size), np.int64), 0
    return np.concatenate([got[k] for k in range(SEGMENTS)]).reshape(2, size), int(got[SEGMENTS][0])


class Weights:
    """Inverse document frequency of a shingle, 1 + ln(n / df) / ln(n + 1): 1 if all n documents have it, near 2 if one has.

    df is read from the sketch, less what other shingles add to a counter on average. The rest of the error has a
    standard deviation of about sqrt(n * shingles in a document / 2**SKETCH_BITS) documents, so that its share of n falls as n
    grows; frequencies below that are taken for each other."""

    def __init__(self, sketch: np.ndarray, n: int):
        others = (sketch.sum(axis=1, keepdims=True) - sketch) / (sketch.shape[1] - 1)
        self.n, self.rows = n, (sketch - others).astype(np.float32)

    def frequency(self, key: np.ndarray) -> np.ndarray:
        a, b = _slots(key)
        return np.clip(np.minimum(self.rows[0][a], self.rows[1][b]), 1, max(self.n, 1))

    def __call__(self, key: np.ndarray) -> np.ndarray:
        return 1 + np.log(max(self.n, 1) / self.frequency(key)) / np.log(self.n + 1 if self.n else 2)


def _draws() -> tuple[np.ndarray, ...]:
    rng, n = np.random.default_rng(11), 1 << 14
    r, c, beta = rng.gamma(2, 1, n), rng.gamma(2, 1, n), rng.uniform(0, 1, n)
    return tuple(x.astype(np.float32) for x in (r, 1 / r, np.log(c), beta))


_R, _INVERSE_R, _LOG_C, _BETA = _draws()
_HASH = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) << np.uint64(20)) | np.uint64(1)


def sample(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """ICWS samples (n, SAMPLES) of weighted sets, sorted by row: for each hash the least ln(a), a number that is the same
    only for the same shingle at the same weight level. Rows without shingles get zeros."""
    out = np.zeros((n, SAMPLES), np.float32)
    if not len(key):
        return out
    for lo in range(0, len(key), 1 << 18):
        # Whole rows, about 2**18 shingles at a time.
        if lo and row[lo] == row[lo - 1]:
            lo = int(np.searchsorted(row, row[lo], "right"))  # noqa: PLW2901
        hi = min(len(key), (lo >> 18 << 18) + (1 << 18))
        hi = int(np.searchsorted(row, row[hi - 1], "right")) if hi < len(key) or hi == len(key) else hi
        if lo >= hi:
            continue
        own_row, own_key, log_w = row[lo:hi], key[lo:hi], np.log(weight[lo:hi]).astype(np.float32)
        heads = np.flatnonzero(np.concatenate(([True], own_row[1:] != own_row[:-1])))
        for k in range(SAMPLES):
            x = own_key * _HASH[k]
            r_at, c_at, b_at = (x >> np.uint64(50)).astype(np.int32), ((x >> np.uint64(36)) & np.uint64(16383)).astype(np.int32), ((x >> np.uint64(22)) & np.uint64(16383)).astype(np.int32)
            beta = _BETA[b_at]
            level = np.floor(log_w * _INVERSE_R[r_at] + beta)
            log_a = _LOG_C[c_at] - _R[r_at] * (level - beta + 1)
            out[own_row[heads], k] = np.minimum.reduceat(log_a, heads)
    return out


def similarities(sets: tuple, a: np.ndarray, b: np.ndarray, weights: Weights) -> np.ndarray:
    """Weighted Jaccard similarity of sets a[p] and b[p] of sets (row, key, count; sorted by row) for each pair p."""
    row, key, count = sets
    weight = count * weights(key).astype(float)
    first = np.searchsorted(row, np.arange((int(max(a.max(), b.max())) if len(a) else 0) + 2))
    out = np.zeros(len(a))
    size = first[a + 1] - first[a] + first[b + 1] - first[b]
    part = np.cumsum(size) >> 18
    for lo, hi in zip(*(lambda x: (x[:-1], x[1:]))(np.append(np.searchsorted(part, np.unique(part)), len(a))), strict=True):
        own_a, own_b = a[lo:hi], b[lo:hi]
        at = np.concatenate([ranges(first[x], first[x + 1] - first[x]) for x in (own_a, own_b)])
        tag = np.concatenate([np.repeat(np.arange(hi - lo), first[x + 1] - first[x]) for x in (own_a, own_b)]).astype(np.uint64)
        tagged = (tag << np.uint64(44)) | key[at]
        order = np.argsort(tagged, kind="stable")
        tagged, w, tag = tagged[order], weight[at][order], tag[order].astype(np.int64)
        twice = np.flatnonzero(tagged[1:] == tagged[:-1])
        both = np.bincount(tag[twice], weights=np.minimum(w[twice], w[twice + 1]), minlength=hi - lo)
        out[lo:hi] = both / np.maximum(np.bincount(tag, weights=w, minlength=hi - lo) - both, 1e-300)
    return out


def _samples(column: pa.Array) -> np.ndarray:
    return text_buffers(column)[0].reshape(-1, SAMPLES)


def _joined(samples: tuple, masses: tuple, texts: tuple, roots: tuple, similarity: float, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) between a block of x and a block of y that together join all classes between which one of similarity is to be
    found. Pairs of one class are never verified, the others from the best agreement downward."""
    (xs, ys), (xm, ym), (xt, yt), (xr, yr) = samples, masses, texts, roots
    alike = np.zeros((len(xs), len(ys)), np.uint8)
    for k in range(SAMPLES):
        alike += xs[:, k, None] == ys[:, k]
    names, back = np.unique(np.concatenate((xr, yr)), return_inverse=True)
    root, x_of, y_of = np.arange(len(names)), back[: len(xr)], back[len(xr) :]
    alike[(alike < LEAST_AGREEING) | (x_of[:, None] == y_of)] = 0
    alike[np.minimum(xm[:, None], ym) < np.maximum(xm[:, None], ym) * (similarity * ROUNDED)] = 0
    rows, found, count = np.flatnonzero(alike.any(axis=1)), [], 4
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sets = shingles(pa.concat_arrays([xt, yt]))
    while len(rows):
        # The best of each row that is left.
        own = alike[rows]
        width = min(count, own.shape[1])
        at = np.argpartition(own, own.shape[1] - width, axis=1)[:, -width:]
        i, j = np.repeat(rows, width), at.ravel()
        some = alike[i, j] > 0
        i, j = i[some], j[some]
        alike[i, j] = 0
        near = similarities(sets, i, len(xs) + j, weights) >= similarity
        for p, q in zip(i[near].tolist(), j[near].tolist(), strict=True):
            u, v = root[x_of[p]], root[y_of[q]]
            if u != v:
                root[root == max(u, v)] = min(u, v)
                found.append((p, q))
        if near.any():
            alike[root[x_of][:, None] == root[y_of]] = 0
        rows, count = rows[alike[rows].any(axis=1)], count * 2
    return tuple(np.array(found, np.int64).reshape(-1, 2).T)


def _rest(groups: DataFrame, roots: DataFrame, nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], scratch: Scratch, similarity: float, shared) -> DataFrame:
    """Links a, b between nodes of one group (leader, node) whose classes (roots: node, root) they join."""
    rows = groups.join(roots, "node", "left").select("leader", "node", F.coalesce("root", "node").alias("root"))
    sizes = rows.groupBy("leader", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("leader").agg(F.max(F.struct("n", "root"))["root"].alias("largest"), F.count("*").alias("classes")).where("classes > 1")
    rows = scratch.table(rows.join(largest.select("leader", "largest"), "leader"), "crowded")
    texts = texts_of(rows.select("node").distinct())
    blocks = rows.join(texts.select("node", F.octet_length("text").alias("bytes")), "node").groupBy("leader").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    rows = rows.join(blocks, "leader").join(nodes.select("node", "samples", "mass"), "node").join(texts, "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    packed = lambda n: [F.collect_list(c).alias(f"{n}_{c}") for c in ("node", "root", "samples", "mass", "text")]
    every = rows.groupBy("leader", "block").agg(*packed("y"))
    # A block of others is sent to every block of its group.
    others = rows.where("root <> largest").groupBy("leader", "block").agg(F.max("blocks").alias("blocks"), *packed("x"))
    others = others.drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: tuple(batch.column(f"{n}_{c}")[r].values for n in "xy")  # noqa: B023, E731
                x, y = (np.asarray(c) for c in get("node"))
                i, j = _joined(tuple(map(_samples, get("samples"))), tuple(map(np.asarray, get("mass"))), get("text"), tuple(map(np.asarray, get("root"))), similarity, shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(x[i], pa.int64()), pa.array(y[j], pa.int64())], ["a", "b"])

    return others.join(every, ["leader", "block"]).drop("leader", "block").mapInArrow(lean(compared), "a long, b long")


def text_hashes() -> tuple[Column, Column]:
    """The two hashes by which texts are told apart."""
    return F.xxhash64("text"), F.xxhash64(F.lit("second"), "text")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """For every row of doc_id and text: doc_id, class_id, kept (whether it is the one of its class that stays), h1 and h2 (its text's hashes).

    class_id is the least doc_id of the row's class of near duplicates. Classes are of texts: equal texts are always of one class, and rows that
    share a doc_id are only if their texts are near. Where the least doc_ids of several classes are one, the class whose row of it has the
    least hashes is named by it, the others by negative numbers made of theirs. Kept is the row with the least doc_id, then hashes; rows equal in both are all marked.
    Texts that are null or without words are of no class but their own, as is a null doc_id, which stands for itself; these rows have class_id
    doc_id, are kept and have null hashes. Other columns are ignored; an empty table gives none."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    short_batches(spark)
    sketch, n = frequencies(docs)
    shared = spark.sparkContext.broadcast(Weights(sketch, n))
    hashed = [h.alias(f"h{k}") for k, h in enumerate(text_hashes(), 1)]
    rows = docs.select("doc_id", "text", *hashed)
    schema = T.StructType([*rows.select("doc_id", "h1", "h2").schema.fields, T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("samples", T.BinaryType()), T.StructField("mass", T.DoubleType())])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, key, count = shingles(batch.column("text"))
            k, weight = batch.num_rows, count * shared.value(key)
            drawn, mass = sample(row, key, weight, k), np.bincount(row, weights=weight, minlength=k)
            bits = drawn.view(np.uint32).astype(np.uint64).reshape(k, BANDS, ROWS)
            band = mix(reduce(lambda a, b: mix(a) + b, (bits[:, :, j] for j in range(ROWS))) + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)
            some = np.isin(np.arange(k), row)
            bands = pa.array([x if s else None for x, s in zip(band, some, strict=True)], pa.list_(pa.int64()))
            # A byte of each sample: those that agree stay so.
            short = mix(bits.reshape(k, SAMPLES)).astype(np.uint8)
            samples = pa.array([x.tobytes() if s else None for x, s in zip(short, some, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "h1", "h2")), bands, samples, pa.array(mass)], schema.names)

    known = scratch.table(rows.mapInArrow(lean(sampled), schema), "samples")
    used = known.where("doc_id is not null and bands is not null")
    # Equal texts are one node; of their rows, one with the least doc_id stands for them.
    nodes = used.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("samples").alias("samples"), F.first("mass").alias("mass"))
    nodes = scratch.table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    member = scratch.table(used.select("doc_id", "h1", "h2").join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("doc_id", "node"), "members")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = pa.concat_arrays([batch.column(c) for c in ("a", "b")]).to_numpy()
            names, where, of = np.unique(both, return_index=True, return_inverse=True)
            texts = pa.concat_arrays([batch.column(f"{c}_text") for c in ("a", "b")]).take(pa.array(where))
            alike = similarities(shingles(texts), of[: batch.num_rows], of[batch.num_rows :], shared.value)
            yield batch.select(["a", "b"]).filter(pa.array(alike >= similarity))

    def texts_of(some: DataFrame) -> DataFrame:
        """node and text of distinct nodes, from one row each."""
        needed = scratch.table(some.join(nodes.select("node", "h1", "h2", "least"), "node"), "needed")
        if needed.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
            needed = F.broadcast(needed)
        found = docs.select("doc_id", "text", *hashed).join(needed, ["h1", "h2"]).where("doc_id = least")
        return scratch.table(found.select("node", "text").dropDuplicates(["node"]), "texts")

    def near(pairs: DataFrame) -> DataFrame:
        texts = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        text = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text"))
        return pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "a_text", "b_text").mapInArrow(lean(verified), "a long, b long")

    bands = nodes.select("node", F.posexplode("bands").alias("k", "band")).select("node", F.xxhash64("k", "band").alias("bucket"))
    met = scratch.table(bands.join(bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "bucket"), "buckets")
    small = met.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list("node")).alias("all"))
    pairs = small.select(F.inline(F.flatten(F.transform("all", lambda x, i: F.transform(F.slice("all", i + 2, F.size("all")), lambda y: F.struct(x.alias("a"), y.alias("b")))))))
    # The leader of a crowded bucket is the node that meets most others over all its buckets.
    crowded = met.where(F.col("n") > SMALL)
    degree = crowded.groupBy("node").agg(F.sum("n").alias("degree"))
    leaders = crowded.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node"))["node"].alias("leader"))
    groups = scratch.table(crowded.join(leaders, "bucket").select("leader", "node").distinct(), "groups")
    stars = groups.where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("mass").alias(f"{name}_mass"))
    mass = (F.col("a_mass"), F.col("b_mass"))
    pairs = pairs.union(stars).distinct().join(side("a"), "a").join(side("b"), "b").where(F.least(*mass) >= F.greatest(*mass) * (similarity * ROUNDED)).select("a", "b")
    links = scratch.table(near(scratch.table(pairs, "candidates")), "links")
    roots = scratch.table(components(links, "a", "b", scratch), "roots")
    if groups.limit(1).count():
        fresh = scratch.table(_rest(groups, roots, nodes, texts_of, scratch, similarity, shared), "links")
        if fresh.limit(1).count():
            roots = scratch.table(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(fresh), "a", "b", scratch), "roots")
    placed = nodes.select("node", "least", "h1", "h2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = placed.groupBy("root").agg(F.min(F.struct("least", "h1", "h2")).alias("kept")).withColumn("class_id", F.col("kept.least"))
    # A doc_id can name several classes only if its rows have several texts.
    if member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").limit(1).count():
        classes = scratch.table(classes, "named")
        first = classes.groupBy("class_id").agg(F.min("kept").alias("first"))
        other = -1 - F.xxhash64("kept.h1", "kept.h2").bitwiseAND(F.lit((1 << 62) - 1))
        classes = classes.join(first, "class_id").withColumn("class_id", F.when(F.col("kept") == F.col("first"), F.col("class_id")).otherwise(other))
    found = member.join(placed.select("node", "root", "h1", "h2"), "node").join(classes, "root")
    found = found.select("doc_id", "class_id", (F.col("kept") == F.struct(F.col("doc_id").alias("least"), "h1", "h2")).alias("kept"), "h1", "h2")
    alone = known.where("doc_id is null or bands is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), *(F.lit(None).cast("long").alias(c) for c in ("h1", "h2")))
    out = scratch.table(found.union(alone), "classes")
    scratch.drop(out)
    return out
