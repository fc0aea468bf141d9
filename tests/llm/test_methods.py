"""Cores of the operators against brute force, round trips and held-out accuracy."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gablework.llm import cws, lines, mixing, packing, ppm, repair, tokens
from gablework.llm.common import read_table
from gablework.llm.components import components

DATA = "/root/testdata/sf0.001"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=120), st.integers(0, 120), st.integers(0, 120))
def test_grammar_round_trip(ids, a, b):
    ids = np.array(ids, np.uint32)
    shard = repair.Shard(repair.compress(ids, min_uses=2))
    lo, hi = sorted((min(a, len(ids)), min(b, len(ids))))
    assert (shard.ids() == ids).all() and (shard.slice(lo, hi) == ids[lo:hi]).all()


def test_grammar_of_large_ids():
    ids = np.tile(np.array([2**31, 5, 2**31, 7], np.uint32), 50)
    blob = repair.compress(ids)
    assert (repair.Shard(blob).ids() == ids).all() and len(blob) < ids.nbytes


VOCABULARIES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]


def _same_as_the_library(name, blank, texts):
    from tokenizers import Tokenizer

    model, encode = Tokenizer.from_file(tokens.public_path(name)), tokens.Encoder(tokens.public_path(name), blank)
    ids, rows = encode(pa.array(texts, pa.string()))
    assert len(rows) == len(texts) + 1
    for k, x in enumerate(model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)):
        assert ids[rows[k] : rows[k + 1]].tolist() == x.ids, texts[k]


@pytest.mark.parametrize(("name", "blank"), VOCABULARIES)
@pytest.mark.parametrize("run", [64, 1 << 20])
def test_tokens_equal_the_library(name, blank, run, monkeypatch):
    """Also with texts cut into small runs, and with little memory for pre-tokens."""
    monkeypatch.setattr(tokens, "RUN", run)
    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    rnd = random.Random(5)
    parts = ["a", "B", "é", "É", " ", "\n", ".", ",", "'s", "'", "'S", "'ll", "re", "1", "²", "!", "\t", "  ", "\r", "\u00a0", "<|", "<|endoftext|>", "–", "€", "İ", "ß", "日本", "\u0301", "\u3000", "\x1c", "x y", "dog "]
    texts = ["".join(rnd.choice(parts[: rnd.choice([22, 32])]) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    _same_as_the_library(name, blank, [*texts, "", None, "word " * 300])


@pytest.mark.parametrize(("name", "blank"), VOCABULARIES)
def test_tokens_of_all_code_points(name, blank):
    """Each code point up to U+FFFF beside letters, digits, blanks, line ends, apostrophes and itself."""
    _same_as_the_library(name, blank, [f"a{c}b {c}x 1{c}\n{c}{c} 's{c}'S {c} " for c in map(chr, range(1 << 16)) if not "\ud800" <= c <= "\udfff"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2048), min_size=1, max_size=60))
def test_windows_hold_every_piece(sizes):
    window, k = packing.deal(np.array(sizes))
    sums = np.bincount(window, weights=sizes, minlength=k)
    assert sums.max() <= 2048 and sums.sum() == sum(sizes)


def test_packing_leaves_little_free():
    rng = np.random.default_rng(2)
    packer, out = packing.Packer(), []
    sizes = np.minimum(rng.lognormal(6, 1.1, 6000).astype(int) + 1, 30000).tolist()
    for k, n in enumerate(sizes):
        out += packer.place(k, n)
    more, cut = packer.finish()
    out += more + packer.unpadded(cut)
    sums = np.bincount([x[3] for x in out], weights=[x[2] for x in out]).astype(int)
    padded = sum(int(n) if n & (n - 1) == 0 else 2048 for n in sums)
    assert sums.sum() == sum(sizes) and padded <= 1.01 * sum(sizes)


def test_rests_of_small_tasks_are_pooled(spark, monkeypatch):
    """At 20 documents a task, windows of powers of two hold less than a hundredth of the tokens; pieces stay whole."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").withColumn("x", F.lit(1))
    out = packing.pack(docs.repartition(50), tokens.public_path("byte_bpe_50k.json"), 1).toPandas()
    filled = out.groupby("sequence_id")["length"].sum()
    unpadded = (filled & (filled - 1) == 0) & (filled < 2048)
    assert filled[unpadded].sum() < 0.01 * filled.sum() and filled.max() <= 2048
    assert (2048 - filled[~unpadded]).sum() < 0.01 * filled.sum()
    whole = out.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert (whole["length"].sum() == whole["doc_tokens"].first()).all() and len(whole) == docs.count()
    assert ((out["start"] + out["length"]) == whole["start"].shift(-1).reindex(out.index).fillna(out["doc_tokens"])).all()
    place = out.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (place["offset"].first() == 0).all()
    assert ((out["offset"] + out["length"]) == place["offset"].shift(-1).reindex(out.index).fillna(out["sequence_id"].map(filled))).all()
    # Fewer tasks in a pool, so that there are several.
    monkeypatch.setattr(packing, "POOLED", 7)
    again = packing.pack(docs.repartition(50), tokens.public_path("byte_bpe_50k.json"), 1).toPandas()
    assert again["length"].sum() == out["length"].sum() and again.groupby("sequence_id")["length"].sum().max() <= 2048


@pytest.mark.parametrize("n", [1, 40, 300])
def test_remainders_are_dealt(n):
    """What a task has left at its end goes through differencing, but for about a window."""
    rng = np.random.default_rng(n)
    packer, sizes = packing.Packer(), np.minimum(rng.lognormal(6, 1.1, n).astype(int) + 1, 30000).tolist()
    out = [p for k, x in enumerate(sizes) for p in packer.place(k, x)]
    rest, cut = packer.finish()
    assert sum(n for _, _, n in cut) < 2048 + 32 + packing.FREE[-1] * 64
    rest += packer.unpadded(cut)
    held = sum(x[2] for x in rest)
    windows = {}
    for x in rest:
        windows[x[3]] = windows.get(x[3], 0) + x[2]
    dealt = sum(v for v in windows.values() if v >= 1880)
    assert held - dealt < 2048 + 32 + packing.FREE[-1] * 64
    for k, x in enumerate(sizes):
        own = sorted((p[1], p[2]) for p in out + rest if p[0] == k)
        assert sum(v for _, v in own) == x and all(a + v == b for (a, v), (b, _) in zip(own, own[1:], strict=False))


def test_frequent_pairs_are_all_replaced():
    """No pair is left that would pay, and the rules' lengths are those of what they stand for."""
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 40, rng.integers(2, 9)) for _ in range(60)]
    ids = np.concatenate([words[k] for k in rng.integers(0, 60, 3000)]).astype(np.uint32)
    shard = repair.Shard(repair.compress(ids))
    pairs, last = {}, {}
    for k, p in enumerate(zip(shard.seq[:-1].tolist(), shard.seq[1:].tolist(), strict=True)):
        if last.get(p) != k - 1:
            pairs[p], last[p] = pairs.get(p, 0) + 1, k
    assert max(pairs.values()) < repair.MIN_USES and len(shard.seq) < len(ids) / 3
    assert (shard.ids() == ids).all() and shard.size[shard.seq].sum() == len(ids)


def test_documents_by_range(spark, tmp_path):
    docs = read_table(spark, DATA, "documents")
    path = tokens.public_path("word_bpe_49k.json")
    repair.write_ids(docs, str(tmp_path / "ids"), path, 2, shard_ids=5000)
    every = {r.doc_id: tuple(r) for r in repair.read_ids(spark, str(tmp_path / "ids")).collect()}
    some = repair.read_ids(spark, str(tmp_path / "ids"), wanted=[3, 50, 199]).collect()
    assert sorted(r.doc_id for r in some) == [3, 50, 199] and all(every[r.doc_id] == tuple(r) for r in some)


def test_boosted_trees_equal_plain_search():
    """The first tree against a search over all features and edges, and the walk over arrays against one node by node."""
    from gablework.llm import quality

    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.2 * rng.normal(size=120) > 0.3).astype(float)
    trees = quality.boost(x, y, trees=3, depth=2, bins=8)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    g, h = share - y, np.full(120, share * (1 - share))

    def best(rows):
        score = lambda r: g[r].sum() ** 2 / (h[r].sum() + quality.SHRINK)
        found = (1e-9, None, None)
        for f in range(3):
            for edge in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 9)[1:-1])):
                left, right = rows[x[rows, f] <= edge], rows[x[rows, f] > edge]
                if min(len(left), len(right)) >= quality.LEAST and (gain := score(left) + score(right) - score(rows)) > found[0] + 1e-12:
                    found = (gain, f, edge)
        return found[1:]

    def grow(rows, node, depth):
        if depth == 2:
            assert trees.leaf[0, node - 3] == pytest.approx(-quality.RATE * g[rows].sum() / (h[rows].sum() + quality.SHRINK))
            return
        f, edge = best(rows)
        if f is not None:
            assert (trees.feature[0, node], trees.threshold[0, node]) == (f, pytest.approx(edge))
        right = x[rows, trees.feature[0, node]] > trees.threshold[0, node]
        grow(rows[~right], 2 * node + 1, depth + 1)
        grow(rows[right], 2 * node + 2, depth + 1)

    grow(np.arange(120), 0, 0)
    for row, margin in zip(x[:30], trees.margin(x[:30]), strict=True):
        total = trees.base
        for t in range(3):
            node = 0
            while node < 3:
                node = 2 * node + (2 if row[trees.feature[t, node]] > trees.threshold[t, node] else 1)
            total += trees.leaf[t, node - 3]
        assert margin == pytest.approx(total)


def test_long_texts_are_worked_on_by_parts(monkeypatch):
    """Statistics and code lengths of one text are the same whatever the parts are."""
    from gablework.llm import quality, texts

    rnd = random.Random(1)
    text = pa.array([" ".join(rnd.choice(["alpha", "Bé", "12", "x.\n", "!!"]) for _ in range(4000)), "short", None, ""])
    data, offsets = cws.text_buffers(text)
    four, _ = ppm.grams(data, offsets)
    key, n = np.unique(four, return_counts=True)
    model = ppm.Model(["a", "b"], [ppm.Tree(key, n.astype(float)), ppm.Tree(key[::3], n[::3].astype(float))])
    whole = quality.statistics(text), model.score(text), [x.tolist() for x in cws.shingles(text)]
    for module, name in ((quality, "RUN"), (texts, "RUN"), (ppm, "_CHUNK")):
        monkeypatch.setattr(module, name, 777)
    assert np.allclose(whole[0], quality.statistics(text)) and np.allclose(whole[1], model.score(text))
    assert whole[2] == [x.tolist() for x in cws.shingles(text)]


def test_additive_recall_on_the_table(spark):
    from gablework.llm import additive

    table = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = table.select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in additive.search(table).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for k in np.flatnonzero(ids % 20 == 0):
        score = x @ x[k]
        score[k] = -np.inf
        hits.append(len(got[int(ids[k])] & set(ids[np.argsort(-score)[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_additive_by_distance(spark):
    from gablework.llm import additive

    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)) * rng.uniform(0.2, 3, 400)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hits = []
    got = additive.search(table, k=5, every=40, euclidean=True).collect()
    for q in {r.query_id for r in got}:
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        own = [r for r in got if r.query_id == q]
        assert all(r.score == pytest.approx(-d[r.vec_id]) for r in own)
        hits.append(len({r.vec_id for r in own} & set(np.argsort(d)[:5].tolist())) / 5)
    assert np.mean(hits) >= 0.9


def test_mix_favours_higher_classes(spark):
    rows = [(k, "word " * 10, "a", 1 + k % 3) for k in range(3000)] + [(5000 + k, "word " * 10, "b", 1) for k in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, own int")
    got = mixing.mix(docs, weights=(1, 3), relative="own").join(docs.select("doc_id", "own"), "doc_id").where("source = 'a'")
    taken = {r.own: r.c for r in got.groupBy("own").agg(F.avg("copies").alias("c")).collect()}
    # A target as large as the source: classes 1, 2 and 3 are expected 0.5, 1 and 1.5 times.
    assert all(taken[k] == pytest.approx(k / 2, abs=0.06) for k in (1, 2, 3))


def test_code_lengths_are_exact():
    """Against a plain PPM that walks the contexts byte by byte."""
    text, probe = b"the cat sat on the mat and the bat", b"the rat sat on that\x00"
    four, _ = ppm.grams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    key, n = np.unique(four, return_counts=True)
    tree = ppm.Tree(key, n.astype(float))
    counts = {}
    full = b"\n" * 3 + text
    for i in range(3, len(full)):
        for k in range(4):
            seen = counts.setdefault(full[i - k : i], {})
            seen[full[i]] = seen.get(full[i], 0) + 1

    def bits(context, byte):
        total, out = 0.0, set()
        for k in range(3, -1, -1):
            seen = counts.get(context[3 - k :])
            if seen is None:
                continue
            left = {s: c for s, c in seen.items() if s not in out}
            if not left:
                continue
            size = sum(left.values()) + len(left)
            if byte in left:
                return total - np.log2(left[byte] / size)
            total -= np.log2(len(left) / size)
            out |= seen.keys()
        return total + np.log2(256 - len(out))

    four, _ = ppm.grams(np.frombuffer(probe, np.uint8), np.array([0, len(probe)]))
    padded = b"\n" * 3 + probe
    want = [bits(padded[i : i + 3], padded[i + 3]) for i in range(len(probe))]
    assert np.allclose(tree.bits(four), want)


def test_language_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = ppm.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_quality_held_out_accuracy(spark):
    from gablework.llm import quality

    docs, labels = (read_table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    got = quality.quality(docs, labels).join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95


def test_banded_distance_equals_levenshtein(spark):
    rnd = random.Random(1)
    rows = []
    for _ in range(400):
        a = [rnd.choice("abé") for _ in range(rnd.randint(0, 14))]
        b = list(a)
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randint(0, len(b))
            b[at : at + rnd.randint(0, 1)] = [rnd.choice("abé")] * rnd.randint(0, 1)
        rows.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    for t in (0, 1, 2, 4):
        assert df.where(lines.within(F.col("a"), F.col("b"), t) != (F.levenshtein("a", "b") <= t)).count() == 0


def test_crowded_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lines, "CROWD", 2)
    rnd, base, texts = random.Random(11), "the quick brown fox jumps", []
    for _ in range(45):
        b = list(base)
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randrange(len(b))
            b[at : at + rnd.randint(0, 1)] = [rnd.choice("xyz")] * rnd.randint(0, 1)
        texts.append("".join(b))
    docs = [(i, "\n".join(texts[3 * i : 3 * i + 3])) for i in range(15)]

    def near(a, b):
        p = sum(1 for i in range(1, min(len(a), len(b)) + 1) if a[:i] == b[:i])
        s = sum(1 for i in range(1, min(len(a), len(b)) + 1) if a[-i:] == b[-i:])
        return abs(len(a) - len(b)) <= 1 and p + s >= max(len(a), len(b)) - 1

    seen, want = [], {}
    for i, text in docs:
        keep = []
        for line in text.split("\n"):
            if not any(e == line or (min(len(e), len(line)) >= 20 and near(e, line)) for e in seen):
                keep.append(line)
            seen.append(line)
        want[i] = "\n".join(keep)
    got = {r.doc_id: r.text for r in lines.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), 1, 20).collect()}
    assert got == want


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 44, 600, dtype=np.uint64)
    a, b = np.sort(keys[:500]), np.sort(keys[100:])
    drawn = [cws.sample(np.zeros(500, np.int64), k, np.ones(500) * 1.5, 1) for k in (a, b)]
    assert abs((drawn[0] == drawn[1]).mean() - 400 / 600) < 0.2


def test_near_duplicate_links_are_kept(spark):
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(900)]
    base = [rnd.choice(words) for _ in range(300)]
    rows = []
    for k in range(40):
        text = list(base)
        text[rnd.randrange(300)] = "edit"
        rows.append((100 + k, " ".join(text)))
    rows += [(k, " ".join(rnd.choice(words) for _ in range(200))) for k in range(40)]
    got = {r.doc_id: r.class_id for r in cws.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[100 + k] == 100 for k in range(40)) and all(got[k] == k for k in range(40))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20) if i != 9] + [(30, 31)], "a long, b long")
    got = {r.node: r.root for r in components(links, "a", "b").collect()}
    assert got == {i: 0 if i < 10 else 10 for i in range(21)} | {30: 30, 31: 30}


def test_mix_comes_near_its_targets(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    sums = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"))
    assert all(abs(r.taken - r.target) <= r.most for r in sums.collect())


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, DATA)
    assert out.count() > 0 and out.columns == packing.PIECES.names


def test_crowded_near_duplicates_equal_all_pairs(spark):
    """Sub-families that drift under one template, so that nodes in crowded buckets are near others than the leaders."""
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(4000)]
    template, rows, ids = [rnd.choice(words) for _ in range(360)], [], rnd.sample(range(10**6), 120)
    for _ in range(4):
        text = template[:260] + [rnd.choice(words) for _ in range(100)]
        for k in range(10):
            if k:
                at = rnd.randrange(336)
                text[at : at + 24] = [rnd.choice(words) for _ in range(24)]
            for v in range(3):
                own = list(text)
                if v:
                    own[rnd.randrange(360)] = "edit"
                rows.append((ids.pop(), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in cws.near_duplicates(docs).collect()}
    weights = cws.Weights(*cws.frequencies(docs))
    classes = _classes(rows, _near_pairs(rows, weights))
    assert len(set(classes.values())) == 4
    assert got == classes


def _near_pairs(rows, weights, least=0.8):
    """All pairs of rows (id, text) whose sets' weighted Jaccard similarity is at least so much, by plain dictionaries."""
    sets, out = {}, []
    for i, text in rows:
        _, key, count = cws.shingles(pa.array([text]))
        sets[i] = dict(zip(key.tolist(), (count * weights(key)).tolist(), strict=True))
    total, places = {i: sum(s.values()) for i, s in sets.items()}, {}
    for i, s in sets.items():
        shared = {}
        for k, w in s.items():
            for j, v in places.setdefault(k, []):
                shared[j] = shared.get(j, 0) + min(w, v)
            places[k].append((i, w))
        out += [(j, i) for j, both in shared.items() if both >= least * (total[i] + total[j] - both)]
    return out


def _classes(rows, pairs):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        x, y = sorted((find(i), find(j)))
        root[y] = x
    return {i: find(i) for i in root}


def test_near_duplicates_recall_on_the_table(spark):
    """Against all pairs of the whole table: nearly no link is lost, and no class joins what isn't linked."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.text]
    pairs = _near_pairs(rows, cws.Weights(*cws.frequencies(docs)))
    got = {r.doc_id: r.class_id for r in cws.near_duplicates(docs).collect()}
    assert len(pairs) > 50 and np.mean([got[i] == got[j] for i, j in pairs]) > 0.98
    truth = _classes(rows, pairs)
    assert all(truth[i] == truth[c] for i, c in got.items() if c != i)


def test_frequencies_come_near_the_truth(spark):
    docs = read_table(spark, "/root/testdata/sf0.1", "documents")
    weights = cws.Weights(*cws.frequencies(docs))
    keys = np.concatenate([cws.shingles(pa.array([r.text]))[1] for r in docs.select("text").collect() if r.text])
    key, true = np.unique(keys, return_counts=True)
    rough = weights.frequency(key)
    assert np.median(np.abs(rough - true)) <= 1 and np.abs(rough - true).mean() < 5
    ideal = 1 + np.log(weights.n / true) / np.log(weights.n + 1)
    assert np.abs(weights(key) - ideal).mean() < 0.1


def test_rows_of_one_doc_id_with_unlike_texts(spark):
    """A doc_id's rows are of one class only if their texts are near; classes that share their least doc_id have different names."""
    rnd = random.Random(3)
    a, b = (" ".join(f"w{rnd.randrange(9000)}" for _ in range(200)) for _ in range(2))
    rows = [(5, a), (5, b), (6, a + " more"), (7, b + " more"), (8, a), (None, a), (9, " ".join(f"w{rnd.randrange(9000)}" for _ in range(200)))]
    for order in (rows, rows[::-1]):
        got = cws.near_duplicates(spark.createDataFrame(order, "doc_id long, text string")).collect()
        of = {r.doc_id: r.class_id for r in got}
        both = {r.class_id for r in got if r.doc_id == 5}
        assert both == {of[6], of[7]} and 5 in both and min(both) < 0 and of[8] == of[6] and of[9] == 9 and of[None] is None
        assert sorted((r.doc_id for r in got if r.kept), key=str) == [5, 5, 9, None]


@pytest.mark.parametrize(("threshold", "crowd", "least"), [(1, 2, 8), (2, 2, 8), (0, 1, 0), (1, 1, 0)])
def test_crowded_lines_at_thresholds_equal_brute_force(spark, monkeypatch, threshold, crowd, least):
    monkeypatch.setattr(lines, "CROWD", crowd)
    rnd, base, texts = random.Random(threshold), "abcabcabcabc", set()
    while len(texts) < 90:
        b = list(base)
        for _ in range(rnd.randint(0, threshold + 1)):
            at = rnd.randrange(len(b))
            b[at : at + rnd.randint(0, 1)] = [rnd.choice("abcx")] * rnd.randint(0, 1)
        texts.add("".join(b))
    texts = sorted(texts, key=lambda x: rnd.random())

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    near = {i for i, x in enumerate(texts) if any(min(len(x), len(y)) >= least and distance(x, y) <= threshold for y in texts[:i])}
    got = {r.doc_id for r in lines.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), threshold, least).where("n_near > 0").collect()}
    assert got == near


@pytest.mark.parametrize(("threshold", "a", "b", "near"), [(2, "xy{}", "z{}w", 0), (1, "{}", "{}x", 1)])
def test_ended_crowded_keys_are_verified(spark, monkeypatch, threshold, a, b, near):
    """Every key is crowded: what is left may have stood at shifted places, or be a character that follows an empty segment."""
    monkeypatch.setattr(lines, "CROWD", 0)
    docs = [(k, x.format("abcdefghijklmno")) for k, x in enumerate((a, b))]
    assert lines.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), threshold, 8).agg(F.sum("n_near")).first()[0] == near
