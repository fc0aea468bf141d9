"""What operators leave in the shared folder, long texts, and the search's recall where few rows are ranked exactly."""

import os
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gablework.llm import additive, cws, lines, manifest, negatives, packing, pieces
from gablework.llm.common import BATCH_BYTES, lean, materialize
from gablework.llm.queries import op2_merkle_audit
from gablework.llm.tokens import encoder, public_path
from tests.llm.test_edges import DOCS, SCHEMA

DOCUMENTS = {
    "classes": (lambda d: cws.near_duplicates(d), 1),
    "lines": (lambda d: lines.line_dedup(d), 2),
    "manifest": (lambda d: manifest.manifest(d), 1),
    "packing": (lambda d: packing.pack(d, public_path("byte_bpe_50k.json"), 1), 1),
    "pieces": (lambda d: pieces.encode(d, public_path("piece_bpe_32k.model")), 0),
}


def _folders(spark):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/gablework"
    return set(os.listdir(path)) if os.path.isdir(path) else set()


@pytest.mark.parametrize("name", sorted(DOCUMENTS))
def test_only_what_the_result_reads_stays(spark, name):
    operator, most = DOCUMENTS[name]
    before = _folders(spark)
    assert operator(spark.createDataFrame(DOCS, SCHEMA)).count() > 0
    assert len(_folders(spark) - before) <= most


def test_negatives_leave_their_result(spark):
    rows = [(k, [float(k % 7), 1.0, float(k % 3)], k % 2) for k in range(300)]
    before = _folders(spark)
    assert negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).count() > 0
    assert len(_folders(spark) - before) == 1


def test_recall_with_few_rows_ranked_exactly(spark):
    """Of 20,000 rows without clusters at most 2 % are ranked exactly for a query; nine of ten true neighbours are found."""
    rng, n, every = np.random.default_rng(8), 20_000, 400
    x = rng.normal(size=(n, 16)).astype(np.float32)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").coalesce(1)
    got = additive.search(table, k=20, every=every).toPandas()
    exact = x.astype(float) @ x[::every].astype(float).T
    hit = 0
    for j, own in enumerate(range(0, n, every)):
        score = exact[:, j].copy()
        score[own] = -np.inf
        hit += len(set(np.argsort(-score, kind="stable")[:20]) & set(got[got["query_id"] == own]["vec_id"]))
    assert hit / (20 * len(range(0, n, every))) >= 0.9
    assert (additive.RERANK * 20 + 1) * 2 <= 0.025 * n


def test_a_very_long_text(spark):
    """8 MB in one row through the new operators."""
    text = "The quick brown fox jumps over the lazy dog, again and again. " * 135_000
    docs = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.expr(f"repeat('{text[:62]}', 135000)").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(len(text)).cast("long").alias("n_chars"))
    row = pieces.encode(docs, public_path("piece_bpe_32k.model")).select("n_tokens", F.md5("text").alias("m"), F.length("text").alias("n")).first()
    same = docs.select(F.md5("text").alias("m"), F.length("text").alias("n")).first()
    assert (row.m, row.n) == (same.m, same.n) and row.n_tokens > 1_000_000
    proof = manifest.manifest(docs).first()
    assert proof.leaf == proof.root == proof.subroot and proof.verified


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """They are as large as the table; Spark deletes them soon after the write, and the session's setting is as before."""
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", _shuffle_files(spark)
    was, frame = spark.conf.get(key), spark.range(5000).repartition(7, "id").groupBy((F.col("id") % 9).alias("k")).count()
    assert sum(r["count"] for r in materialize(frame, "counts").collect()) == 5000
    end = time.time() + 20
    while (stay := _shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not stay and spark.conf.get(key) == was
    assert frame.count() == 9


def test_audit_leaves_no_replica(spark, tmp_path):
    rows = [(k, f"http://a/{k}", f"<p>{k}</p>" * 40) for k in range(300)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    before = _folders(spark)
    assert op2_merkle_audit(spark, str(tmp_path)).count() > 0
    assert not [x for x in _folders(spark) - before if x.startswith("replica")]


def _held_mb():
    """Memory of this process's own, as the check tool counts it."""
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", f.read()))) / 1024


def test_a_task_gives_back_what_a_batch_left():
    """A batch frees 150 MB of small pieces below one that stays; the next batch begins without them."""
    batch, seen = pa.RecordBatch.from_arrays([pa.array(["x" * BATCH_BYTES])], ["text"]), []

    def f(batches):
        stays = []
        for x in batches:
            seen.append(_held_mb())
            if len(seen) == 1:
                pieces = [bytes(3000) for _ in range(50_000)]
                stays.append(pieces[-1])
                del pieces
            yield x

    assert len(list(lean(f)(iter([batch] * 3)))) == 3
    assert max(seen) - seen[0] < 50


def test_ids_in_little_memory():
    """Texts of 4 MB in one batch take 5 times their own size while they are encoded (14 times in runs of 2 MB), and equal the library's ids."""
    rng = np.random.default_rng(3)
    words = np.array(["".join(chr(c) for c in rng.integers(97, 123, n)) for n in rng.integers(2, 9, 3000)])
    texts = [" ".join(words[rng.integers(0, len(words), 450)]) + " été." for _ in range(1500)]
    own, column = encoder(public_path("byte_bpe_50k.json"), True), pa.array(texts)
    own(column)
    tracemalloc.start()
    ids, rows = own(column)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("peak", most / column.nbytes)
    assert most < 12 * column.nbytes
    assert [x.ids for x in own.model.encode_batch_fast(texts[:50], add_special_tokens=False)] == [ids[rows[k] : rows[k + 1]].tolist() for k in range(50)]
