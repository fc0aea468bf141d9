"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of orders 3 to 0, frozen after fitting. The code length of a byte is found from
the longest context downward: an order that has seen the context but not the byte costs an escape (method C: as
likely as the context has distinct bytes), whose symbols are excluded below; past order 0 the bytes not yet seen are
equally likely. A text's code length is the exact sum over all its bytes, and the language with the shortest one is
predicted.

Code lengths depend on four bytes alone, so a worker keeps them by their hash and walks the trees once for each new
group of four; the rest is table lookups over whole batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.common import lean, short_batches, text_buffers, with_lit_crc
from gablework.llm.texts import runs

ORDER = 3
#: Bytes of text for each language that the trees are fitted on (expected, chosen by hash among all training rows).
SAMPLE_BYTES = 4_000_000
UNDECIDED = "und"
_START, _CHUNK, _SLOTS = 10, 1 << 19, 20


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the three before it, as one number; a text begins after line ends. And the rows' offsets."""
    n = len(offsets) - 1
    where = np.arange(len(data)) + np.repeat(ORDER * np.arange(1, n + 1), np.diff(offsets))
    wide = np.full(len(data) + ORDER * n, _START, np.uint32)
    wide[where] = data
    out = wide.copy()
    for k in range(1, ORDER + 1):
        out[k:] |= wide[:-k] << np.uint32(8 * k)
    return out[where], offsets


def windows(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """grams() of about _CHUNK bytes at a time: the first row, its groups and the rows' offsets. A longer text comes in
    several parts."""
    for lo, hi in runs(offsets, _CHUNK):
        if hi > lo + 1 or offsets[hi] - offsets[lo] <= _CHUNK:
            yield lo, *grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            continue
        for a in range(int(offsets[lo]), int(offsets[hi]), _CHUNK):
            # Three bytes more on the left are the first groups' contexts.
            b, before = min(a + _CHUNK, int(offsets[hi])), min(ORDER, a - int(offsets[lo]))
            four, _ = grams(data[a - before : b], np.array([0, b - a + before]))
            yield lo, four[before:], np.array([0, b - a])


class Tree:
    """A language's counts: for each order, the sorted contexts and the sorted contexts with a next byte."""

    def __init__(self, four: np.ndarray, counts: np.ndarray):
        self.symbols, self.contexts = [], []
        for k in range(ORDER + 1):
            key, back = np.unique(four & np.uint32((1 << 8 * (k + 1)) - 1), return_inverse=True)
            self.symbols.append((key, np.bincount(back, weights=counts, minlength=len(key))))
        for k, (key, n) in enumerate(self.symbols):
            ctx, back = np.unique(key >> np.uint32(8), return_inverse=True)
            total, distinct = np.bincount(back, weights=n), np.bincount(back).astype(float)
            if k:
                # What is left one order below when this context's bytes are excluded.
                lower, lower_n = self.symbols[k - 1]
                own = lower_n[np.searchsorted(lower, key & np.uint32((1 << 8 * k) - 1))]
                short, short_total, short_distinct = self.contexts[k - 1][:3]
                at = np.searchsorted(short, ctx & np.uint32((1 << 8 * (k - 1)) - 1))
                rest, rest_distinct = short_total[at] - np.bincount(back, weights=own), short_distinct[at] - distinct
            else:
                rest = rest_distinct = np.zeros(len(ctx))
            self.contexts.append((ctx, total, distinct, rest, rest_distinct))

    def bits(self, four: np.ndarray) -> np.ndarray:
        """Code length of each group's last byte."""
        n = len(four)
        out, open_ = np.zeros(n), np.ones(n, bool)
        # Counts at the order in turn, after exclusion; negative: its context decides by itself.
        total, distinct = np.full(n, -1.0), np.full(n, -1.0)
        for k in range(ORDER, -1, -1):
            at = np.flatnonzero(open_)
            if not len(at):
                break
            key = four[at] & np.uint32((1 << 8 * (k + 1)) - 1)
            ctx, c_total, c_distinct, rest, rest_distinct = self.contexts[k]
            c = np.minimum(np.searchsorted(ctx, key >> np.uint32(8)), max(len(ctx) - 1, 0))
            seen = ctx[c] == key >> np.uint32(8) if len(ctx) else np.zeros(len(at), bool)
            at, key, c = at[seen], key[seen], c[seen]
            fresh = total[at] < 0
            a, d = np.where(fresh, c_total[c], total[at]), np.where(fresh, c_distinct[c], distinct[at])
            names, counts = self.symbols[k]
            s = np.minimum(np.searchsorted(names, key), len(names) - 1)
            hit = names[s] == key
            out[at[hit]] += np.log2((a + d)[hit]) - np.log2(counts[s[hit]])
            open_[at[hit]] = False
            lost = ~hit
            cost = np.zeros(int(lost.sum()))
            some = d[lost] > 0
            cost[some] = np.log2((a + d)[lost][some]) - np.log2(d[lost][some])
            out[at[lost]] += cost
            total[at[lost]], distinct[at[lost]] = rest[c[lost]], rest_distinct[c[lost]]
        seen0 = len(self.symbols[0][0])
        out[open_] += np.log2(max(1, 256 - seen0))
        return out


class Model:
    def __init__(self, languages: list[str], trees: list[Tree]):
        self.languages, self.trees = languages, trees
        self._cache()

    def _cache(self) -> None:
        self.key = np.zeros(1 << _SLOTS, np.uint32)
        self.full = np.zeros(1 << _SLOTS, bool)
        self.value = np.zeros((1 << _SLOTS, len(self.trees)))

    def __getstate__(self):
        return {"languages": self.languages, "trees": self.trees}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._cache()

    def lengths(self, four: np.ndarray) -> np.ndarray:
        """Code lengths by language, a row for each group of four bytes."""
        slot = (four * np.uint32(2654435769)) >> np.uint32(32 - _SLOTS)
        miss = np.flatnonzero((self.key[slot] != four) | ~self.full[slot])
        if not len(miss):
            return self.value[slot]
        new, back = np.unique(four[miss], return_inverse=True)
        bits = np.stack([t.bits(new) for t in self.trees], axis=1)
        at = (new * np.uint32(2654435769)) >> np.uint32(32 - _SLOTS)
        out = self.value[slot]
        out[miss] = bits[back]
        # Of new groups with one slot, the last stays; a row is written whole.
        self.key[at], self.full[at] = new, True
        own = self.key[at] == new
        self.value[at[own]] = bits[own]
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        """Code length of every text in every language."""
        data, offsets = text_buffers(column)
        out = np.zeros((len(offsets) - 1, len(self.trees)))
        for lo, four, rows in windows(data, offsets):
            full = np.flatnonzero(np.diff(rows))
            if len(full):
                out[lo + full] += np.add.reduceat(self.lengths(four), rows[full], axis=0, dtype=np.float64)
        return out


def train(docs: DataFrame, held_out: Column, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Fit a tree for each non-null lang of rows that are not held out. Rows are chosen by hash so that each language
    has about sample_bytes; only counts of byte groups come to the driver, whose number that bounds."""
    short_batches(docs.sparkSession)
    rows = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r.lang: r.n or 0 for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    languages = sorted(k for k, n in sizes.items() if n)
    if not languages:
        return None
    part = F.pmod(F.xxhash64(F.lit("ppm"), "doc_id", F.octet_length("text")), F.lit(1_000_000)).cast("double") / 1e6
    share = F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample_bytes / sizes[k])))))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("four", T.LongType()), T.StructField("n", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(names)):
                parts = [np.unique(four, return_counts=True) for _, four, _ in windows(*text_buffers(batch.column("text").take(pa.array(np.flatnonzero(names == lang)))))]
                if not parts:
                    continue
                key, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([c for _, c in parts]), minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(n)], schema.names)

    counts = rows.where(part < share[F.col("lang")]).select("lang", "text").mapInArrow(lean(counted), schema).groupBy("lang", "four").agg(F.sum("n").alias("n")).toArrow()
    code = counts.column("lang").combine_chunks().dictionary_encode()
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    at, found = code.indices.to_numpy(zero_copy_only=False), code.dictionary.to_pylist()
    four, n = counts.column("four").to_numpy().astype(np.uint32), counts.column("n").to_numpy().astype(float)
    languages = sorted(found)
    return Model(languages, [Tree(four[at == found.index(k)], n[at == found.index(k)]) for k in languages]) if languages else None


def classify(docs: DataFrame, model: Model | None, keep: list[str], inside: str | None = None, named: Column | None = None) -> DataFrame:
    """The columns keep (inside: one of them that is a struct with the text, which then is sent to Python once) with lang_pred (a learned language; und if the text is null or has no letter), score (the
    posterior of that language when all are as likely before; 0 for und) and bits_per_byte. One pass without a shuffle; a task holds one
    Arrow batch. Ties go to the first language by name. named: a language that the text is said to be in; then excess_bits
    says how many bits that one takes more than the best (null if it is no learned language)."""
    short_batches(docs.sparkSession)
    more = [] if named is None else ["excess_bits"]
    if model is None:
        return docs.select(*keep, F.lit(UNDECIDED).alias("lang_pred"), F.lit(0.0).alias("score"), *(F.lit(None).cast("double").alias(c) for c in ("bits_per_byte", *more)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col(inside)["text"] if inside else F.col("text")
    rows = docs.select(*keep, *([] if inside else [text.alias("_text")]), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letters"), *([] if named is None else [named.cast("string").alias("_named")]))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), *(T.StructField(c, T.DoubleType()) for c in ("bits_per_byte", *more))])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names, place = np.array(known.languages, object), {x: k for k, x in enumerate(known.languages)}
        for batch in batches:
            texts = batch.column(inside).field("text") if inside else batch.column("_text")
            bits = known.score(texts)
            best = bits.argmin(axis=1) if len(bits) else np.zeros(0, int)
            least = bits.min(axis=1, keepdims=True) if len(bits) else bits
            sure = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(axis=1)
            letters = batch.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
            size = np.maximum(1, np.diff(text_buffers(texts)[1]))
            columns = [pa.array(np.where(letters, names[best], UNDECIDED), pa.string()), pa.array(np.where(letters, sure, 0.0)), pa.array(least[:, 0] / size)]
            if more:
                own = np.array([place.get(x, -1) for x in batch.column("_named").to_pylist()], np.int64)
                columns.append(pa.array(bits[np.arange(len(own)), own] - least[:, 0], pa.float64(), mask=own < 0))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(keep))), *columns], schema.names)

    return rows.mapInArrow(lean(predict), schema)


def held_out(doc_id: Column | str = "doc_id", folds: int = 5) -> Column:
    """Rows that are never learned from: crc32 of the id's text leaves no remainder (a null id is never learned from)."""
    return F.coalesce(with_lit_crc(F.col(doc_id) if isinstance(doc_id, str) else doc_id) % folds == 0, F.lit(True))


def language_id(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Fit on the rows not held out and predict all: doc_id, held_out, lang_pred, score, bits_per_byte."""
    model = train(docs, held_out(), sample_bytes)
    return classify(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])
