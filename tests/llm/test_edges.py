"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.llm import additive, bitsliced, cws, lines, mixing, packing, ppm, quality, repair, warc
from gablework.llm.tokens import public_path

LONG = "alpha beta gamma delta epsilon zeta eta theta " * 4000
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here.\nSecond line of text.", "en", "a", 10),
    (2, None, "en", "a", 0),
    (3, "", None, None, 0),
    (4, "12 !! 34", "de", "b", 5),
    (5, LONG, "en", "b", len(LONG)),
    (5, LONG, "en", "b", len(LONG)),
    (None, "no id here but some words to read and to keep in mind", None, "a", 3),
    (7, "The quick brown fox jumps over the lazy dog and runs far away from here.\nSecond line of text.", "fr", "c", 10),
    (8, "\n\n  \n", "fr", None, 4),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    clash = ["held_out", "score", "predicted", "size", "u", "copies", "class_id", "start", "length", "n_lines", "pos", "line", "bands", "rank", "of", "h1", "node", "row", "lang_pred"]
    return spark.createDataFrame(DOCS, SCHEMA).withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def vectors(spark, extra=True):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows[50] = (50, rows[51][1])
    rows += [(1000, None), (1100, [float("nan")] * 6), (1200, [None, 1.0, 0.0, 0.0, 0.0, 0.0]), (1300, [0.0] * 6), (1400, []), (None, [1.0] * 6), (1500, [1.0, 2.0]), (120, rows[120][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({c: F.lit(1) for c in ("score", "rank", "query_id", "block", "dim")}) if extra else df


def plain(spark):
    return [(r.vec_id, np.array(r.embedding, float)) for r in vectors(spark, False).collect() if r.vec_id is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)]


def test_bit_sliced_equals_brute_force(spark):
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in bitsliced.top_k(vectors(spark), k=7, every=20).collect())
    rows, want = [(i, np.floor(1024 * x).astype(int)) for i, x in plain(spark)], []
    for q, x in dict(rows).items():
        if q % 20 == 0:
            best = sorted((-int(x @ y), i) for i, y in rows if i != q and len(y) == len(x))[:7]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_additive_quantisation_recall_and_scores(spark):
    got = additive.search(vectors(spark), k=5, every=10, rerank=8).collect()
    rows = [(i, x) for i, x in plain(spark) if x.any()]
    by = dict(rows)
    hit = total = 0
    for q in {r.query_id for r in got}:
        best = sorted((-float(by[q] @ y), i) for i, y in rows if i != q and len(y) == len(by[q]))[:5]
        own = [r for r in got if r.query_id == q]
        assert all(r.score == pytest.approx(float(by[q] @ by[r.vec_id]), abs=1e-12) for r in own)
        hit += len({i for _, i in best} & {r.vec_id for r in own})
        total += len(best)
    assert hit / total >= 0.9
    assert all(r.query_id != r.vec_id for r in got)


def test_searches_of_nothing(spark):
    empty = vectors(spark).limit(0)
    assert additive.search(empty).count() == bitsliced.top_k(empty).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality(docs, labels).collect()
    assert len(out) == len(DOCS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(none, labels).count() == 0


def test_language(docs, none):
    out = {(r.doc_id, r.lang_pred, r.score) for r in ppm.language_id(docs).collect()}
    assert {d for d, p, _ in out if p == "und"} == {2, 3, 4, 8}
    assert all(0 <= s <= 1 for *_, s in out)
    assert ppm.language_id(none).count() == 0


def test_token_files(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_path("word_bpe_49k.json")
    model, want, at = Tokenizer.from_file(path), [], 0
    for d, t, *_ in sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in repair.token_files(docs, path, 2).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert repair.token_files(none, path, 2).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer

    path = public_path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    out = packing.pack(docs, path, 1).collect()
    ids = {d: np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t, *_ in DOCS}
    assert sum(r.length for r in out) == sum(len(ids[d]) for d, *_ in DOCS)
    for r in out:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(none, path, 1).count() == 0


def test_mixing(docs, none):
    out = mixing.mix(docs).collect()
    assert len(out) == len(DOCS)
    size = {d: len((t or "").split()) for d, t, *_ in DOCS}
    assert all(r.size == size[r.doc_id] and 0 <= r.taken <= 3 * r.size and r.target <= 3 * r.source_size for r in out)
    again = mixing.mix(docs).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    twice = mixing.repeated(docs)
    assert twice.columns == docs.columns
    assert sum(size[r.doc_id] for r in twice.collect()) == sum(r.taken for r in out)
    assert mixing.mix(none).count() == mixing.repeated(none).count() == 0


def test_near_duplicates(docs, none):
    out = sorted(((r.doc_id, r.class_id) for r in cws.near_duplicates(docs).collect()), key=str)
    assert out == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (5, 5), (None, None), (7, 1), (8, 8)], key=str)
    assert cws.near_duplicates(none).count() == 0


def test_lines(docs, none):
    out = {r.doc_id: r for r in lines.line_dedup(docs).collect()}
    assert out[1].text == DOCS[0][1] and out[7].text == "" and out[7].n_dropped == 2
    assert out[2].text is None and out[2].n_lines == 0 and out[8].text == "\n\n  \n"
    assert lines.line_dedup(docs).count() == len(DOCS) and lines.line_dedup(none).count() == 0


def test_archives(spark):
    rows = [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (2, None, None), (None, "v", ""), (None, "w", ""), (4, "w", LONG), (5, "z", "b"), (6, "y", "c")]
    pages = lambda r: spark.createDataFrame(r, "page_id long, url string, html string").withColumn("offset", F.lit(1))
    records = warc.records(pages(rows))
    places = warc.catalogue(records, archive_bytes=400).cache()
    ours = warc.hashed(warc.stored(records, places)).cache()
    assert ours.agg(F.sum("copies")).first()[0] == 8 and warc.audit(ours, ours).count() == 0
    # Two tables that differ in one page, altered, and in one that is gone: no other record is reported.
    other = warc.records(pages([(i, u, "<p>another, longer text</p>" if i == 5 else h) for i, u, h in rows if i != 6]))
    theirs = warc.hashed(warc.stored(other, places))
    got = warc.audit(ours, theirs, leaf_bytes=256, fan_out=2).collect()
    assert sorted((r.page_id, r.status) for r in got) == [(5, "altered"), (6, "missing")]
    assert next(r.found for r in got if r.page_id == 5) == other.where("page_id = 5").select(F.sha2("payload", 256)).first()[0]
    assert [r.status for r in warc.audit(ours.where("page_id is null or page_id <> 1"), ours).collect()] == ["extra"]
    none = warc.records(pages(rows).limit(0))
    assert warc.audit(*(warc.hashed(warc.stored(none, warc.catalogue(none))) for _ in range(2))).count() == 0


def test_damage_is_found_from_bytes(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://x/"), "id").alias("url"), F.repeat(F.col("id").cast("string"), 30).alias("html"))
    records = warc.records(pages)
    ours = warc.stored(records, warc.catalogue(records, archive_bytes=20_000)).cache()
    theirs = warc.damaged(ours).cache()
    key = ["archive", "offset", "page_id"]
    both = ours.select(*key, F.col("payload").alias("a")).join(theirs.select(*key, F.col("payload").alias("b")), key, "left")
    want = sorted((r.page_id, "missing" if r.b is None else "altered") for r in both.where("b is null or a <> b").collect())
    got = sorted((r.page_id, r.status) for r in warc.audit(warc.hashed(ours), warc.hashed(theirs)).collect())
    assert got == want and len(want) > 10 and {s for _, s in want} == {"missing", "altered"}


def test_pipeline_stages(spark, docs, none):
    import corpus_pipeline

    for table in (docs, none):
        at = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, "/root/testdata/sf0.001")
            assert at.columns == table.columns, name
            at = at.cache()
            assert at.count() > 0 or table is none
        assert corpus_pipeline.STAGES[-1][1](spark, at, "").count() >= at.count()


def test_language_stage_uses_its_prediction(spark):
    import corpus_pipeline

    text = {"de": "der hund und die katze laufen durch das haus und den garten ", "en": "the dog and the cat run through the house and the garden "}
    rows = [(k, text[lang] * 3, lang) for k in range(40) for lang in ("de", "en") if k % 2 == (lang == "en")]
    rows += [(100, text["de"], None), (101, text["en"], None), (102, "Q7#zX!9@kW$3^vJ&5*pL(2)" * 9, None), (103, "12 34", "en"), (104, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert got == {k: lang for k, _, lang in rows[:40]} | {100: "de", 101: "en"}
    # Wrong names are mended; short texts keep theirs, whatever they are, and stay.
    wrong = [(200, text["de"] * 2, "en"), (201, text["en"] * 2, "de"), (202, "HTTP/1.1 404", "en"), (203, "Tor", "de"), (204, text["de"], None)]
    more = spark.createDataFrame(rows[:40] + wrong, docs.schema)
    got = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, more, "").collect()}
    assert got == {k: lang for k, _, lang in rows[:40]} | {200: "de", 201: "en", 202: "en", 203: "de", 204: "de"}
    unnamed = corpus_pipeline.identify_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), "")
    assert unnamed.count() == 43


def test_near_duplicate_stage_on_repeated_ids(spark):
    import corpus_pipeline

    words = [f"w{k}" for k in range(400)]
    a, b, c = (" ".join(words[k : k + 100]) for k in (0, 120, 260))
    rows = [(5, a, 1), (5, b, 1), (5, a, 1), (6, a, 2), (7, c, 3), (7, None, 4), (7, None, 4), (8, b + " more", 1), (None, a, 5), (None, a, 5)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, extra long")
        got = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str)
        assert got == sorted([(5, a, 1), (5, b, 1), (7, c, 3), (7, None, 4), (7, None, 4), (None, a, 5), (None, a, 5)], key=str)
    # Of two texts under one id, each with a near copy, both are left, once.
    rows = [(5, a, 1), (5, b, 1), (6, a + " more", 1), (7, b + " more", 1)]
    for order in (rows, rows[::-1]):
        got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(order, "doc_id long, text string, extra long"), "").collect()
        assert sorted(map(tuple, got)) == sorted([(5, a, 1), (5, b, 1)])
