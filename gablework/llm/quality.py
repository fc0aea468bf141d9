"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from the bytes of whole texts, for batches at once. The trees are grown level by level on binned
features with logistic loss and kept as complete binary trees in flat arrays, so that a batch goes down all of them with one
indexed comparison a level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.llm.common import lean, short_batches, text_buffers, with_lit_crc
from gablework.llm.texts import RUN, distinct, hashes, runs, spans

#: Labelled rows (expected, by hash of doc_id) that the trees are fitted on.
TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAST, SHRINK = 60, 4, 64, 0.2, 8, 1.0

_CLASSES = ("lower", "upper", "digit", "blank", "line_end", "stop", "comma", "exclaims", "bar", "symbol", "slash", "quote", "other", "high", "control", "dash")


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES.index("other"), np.uint8)
    for name, chars in {"blank": " \t", "line_end": "\n", "stop": ".", "comma": ",;:", "exclaims": "!?", "bar": "|", "symbol": "#$%&*@^~+=", "slash": "/\\<>{}[]_", "quote": "'\"`()", "dash": "-"}.items():
        table[[ord(c) for c in chars]] = _CLASSES.index(name)
    table[ord("a") : ord("z") + 1] = _CLASSES.index("lower")
    table[ord("A") : ord("Z") + 1] = _CLASSES.index("upper")
    table[ord("0") : ord("9") + 1] = _CLASSES.index("digit")
    table[[c for c in range(32) if c not in (9, 10)]] = _CLASSES.index("control")
    table[128:] = _CLASSES.index("high")
    return table


_TABLE = _class_table()
#: Statistics of a document, in the order of the columns of statistics().
NAMES = (
    *(f"share_{c}" for c in _CLASSES), "log_bytes", "log_words", "mean_word", "word_spread", "short_words", "long_words", "distinct_words", "top_word",
    "log_lines", "mean_line", "blank_lines", "repeated_lines", "repeated_line_bytes", "capital_words", "entropy",
)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of statistics for each text; a null one counts as empty."""
    data, offsets = text_buffers(column)
    out = np.zeros((len(offsets) - 1, len(NAMES)))
    for lo, hi in runs(offsets):
        out[lo:hi] = _statistics(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
    return out


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n, size = len(offsets) - 1, np.diff(offsets)
    # How often each row has each byte, by parts, as a row can be long.
    bytes_ = np.zeros(n * 256, np.int64)
    for at in range(0, len(data), RUN):
        own = data[at : at + RUN]
        row = np.repeat(np.arange(n), np.diff(np.clip(offsets, at, at + len(own))))
        bytes_ += np.bincount(row * 256 + own, minlength=n * 256)
    bytes_ = bytes_.reshape(n, 256)
    k = len(_CLASSES)
    sums = np.stack([bytes_[:, c == _TABLE].sum(axis=1) for c in range(k)], axis=1)
    share = sums / np.maximum(size, 1)[:, None]
    kind = _TABLE[data]
    white = (kind == _CLASSES.index("blank")) | (kind == _CLASSES.index("line_end"))
    starts, ends, first = spans(~white, offsets)
    length, words = ends - starts, np.diff(first)
    own = np.repeat(np.arange(n), words)
    per = np.maximum(words, 1)
    total = lambda x: np.bincount(own, weights=x, minlength=n)
    mean = total(length) / per
    spread = np.sqrt(np.maximum(total(length.astype(float) ** 2) / per - mean**2, 0))
    word_row, _, count = distinct(own, hashes(data, starts, ends), n)
    different = np.bincount(word_row, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, word_row, count)
    capital = total(kind[starts] == _CLASSES.index("upper"))
    # Lines: what stands between line ends, blank ones aside.
    l_start, l_end, l_first = spans(kind != _CLASSES.index("line_end"), offsets)
    lines = np.diff(l_first)
    l_row = np.repeat(np.arange(n), lines)
    breaks = sums[:, _CLASSES.index("line_end")]
    line_hash = hashes(data, l_start, l_end)
    order = np.lexsort((line_hash, l_row))
    again = np.zeros(len(order), bool)
    again[1:] = (line_hash[order][1:] == line_hash[order][:-1]) & (l_row[order][1:] == l_row[order][:-1])
    repeated = np.bincount(l_row[order][again], minlength=n)
    repeated_bytes = np.bincount(l_row[order][again], weights=(l_end - l_start)[order][again], minlength=n)
    bytes_ = bytes_ / np.maximum(size, 1)[:, None]
    entropy = -(bytes_ * np.log2(np.where(bytes_ > 0, bytes_, 1))).sum(axis=1)
    return np.column_stack(
        (share, np.log1p(size), np.log1p(words), mean, spread, total(length <= 3) / per, total(length >= 12) / per, different / per, top / per,
         np.log1p(lines), size / np.maximum(lines, 1), (breaks + 1 - lines) / (breaks + 1), repeated / np.maximum(lines, 1), repeated_bytes / np.maximum(size, 1), capital / per, entropy)
    )


@dataclass
class Trees:
    """Complete binary trees of one depth: node i has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); a row goes right if its value is above
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - len(feature)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Fit on a row of features for each label (0 or 1). No rows, or one class alone, give a constant score."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base, inner = float(np.log(share / (1 - share))), (1 << depth) - 1
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    n_features = x.shape[1]
    flat = binned + np.arange(n_features) * bins
    margin = np.full(len(y), base)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            # Histograms of all nodes of the level at once.
            slot = ((node - first)[:, None] * (n_features * bins) + flat).ravel()
            size = width * n_features * bins
            g, h, c = (np.bincount(slot, weights=np.repeat(v, n_features), minlength=size).reshape(width, n_features, bins) for v in (gradient, weight, np.ones(len(y))))
            gl, hl, cl = g.cumsum(axis=2), h.cumsum(axis=2), c.cumsum(axis=2)
            gt, ht, ct = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
            gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt**2 / (ht + SHRINK)
            gain[(cl < LEAST) | (ct - cl < LEAST)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            for w in np.flatnonzero(gain.reshape(width, -1)[np.arange(width), best] > 1e-9):
                f, b = divmod(int(best[w]), bins)
                if b < len(edges[f]):
                    out.feature[t, first + w], out.threshold[t, first + w] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), out.feature[t, node]] > out.threshold[t, node])
        at = node - inner
        g, h = np.bincount(at, weights=gradient, minlength=inner + 1), np.bincount(at, weights=weight, minlength=inner + 1)
        out.leaf[t] = -rate * g / (h + SHRINK)
        margin += out.leaf[t][at]
    return out


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id's text leaves 1 by 3 (a null id is never learned from)."""
    return F.coalesce(with_lit_crc(F.col(doc_id) if isinstance(doc_id, str) else doc_id) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Fit on labelled documents that are not held out. About rows labels are chosen by hash of doc_id, which bounds the
    side that is broadcast and the statistics that come to the driver (one row for each doc_id)."""
    short_batches(docs.sparkSession)
    usable = labels.where(~held_out() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = usable.count()
    part = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)).cast("double") / 1e6
    chosen = F.broadcast(usable.where(part < min(1.0, rows / max(n, 1))))
    joined = docs.select("doc_id", "text").join(chosen, "doc_id")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("quality").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], schema.names)

    got = joined.mapInArrow(lean(described), schema).groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("x").alias("x")).orderBy("doc_id").toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(NAMES))
    return boost(x, got.column("quality").to_numpy().astype(float))


def classify(docs: DataFrame, trees: Trees, keep: list[str]) -> DataFrame:
    """The columns keep with score (0 to 1, higher: label 1 likelier) and predicted, for every row, in one pass without a
    shuffle."""
    short_batches(docs.sparkSession)
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = trees.score(statistics(batch.column("_text")))
            columns = [*(batch.column(c) for c in range(len(keep))), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(lean(scored), schema)


def quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Score every document: doc_id, held_out, score, predicted. A null text counts as empty, repeated rows are scored each, other
    columns are ignored; without labels every score is 0.5."""
    trees = train(docs, labels, rows)
    return classify(docs.withColumn("held_out", held_out()), trees, ["doc_id", "held_out"])
