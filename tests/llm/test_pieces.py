"""Piece ids and decoded texts against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gablework.llm import pieces, tokens
from gablework.llm.queries import op11_sentence_pieces
from tests.llm.test_edges import DOCS, SCHEMA

MODEL = tokens.public_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(MODEL)


def same(own, library, texts):
    ids, ends = own(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        want = library.encode(text or "")
        assert ids[ends[k] : ends[k + 1]].tolist() == want
        assert own.decode(ids[ends[k] : ends[k + 1]]) == library.decode(want)


def test_blanks_line_ends_and_characters_of_no_piece(own, library):
    same(own, library, [None, "", "a", " a", "\n", "a\nb", "▁", "▁▁a", "x▁y", "\x00a\x00", "日本語テスト", "😀😀x", "<s></s><unk><0x0A>", "  \xa0"])
    same(own, library, [" " * n + x for n in range(1, 70) for x in ("", "a", "\t", "?")])
    same(own, library, ["x" + " " * 5000 + "y" + " " * 47 + "\n"])
    assert own.blank == 16


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab sugarSnte▁\n0é的"), max_size=80), max_size=8))
def test_texts_of_few_letters(own, library, texts):
    same(own, library, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(own, library, texts):
    same(own, library, texts)


def test_words_of_many_pieces_without_a_cut(own, library):
    rng = random.Random(5)
    voc = [p for p in (library.id_to_piece(i) for i in range(300, 31_000)) if "▁" not in p]
    same(own, library, ["".join(rng.choices(voc, k=rng.randint(1, 80))) for _ in range(2000)])
    same(own, library, ["".join(rng.choices("ABCDEFGHIJabcdefghij0123456789+/", k=200_000)), "ab" * 50_000, "a" * 100_000])


def test_all_code_points(own, library):
    known = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    same(own, library, ["".join(known[k : k + 500]) for k in range(0, len(known), 500)])


def test_long_texts_and_forgetting(own, library, monkeypatch):
    monkeypatch.setattr(tokens, "RUN", 4000)
    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    monkeypatch.setattr(pieces, "DECODED", 100)
    rng = random.Random(2)
    words = ["".join(rng.choices("etaoinshrdlü\n", k=rng.randint(1, 9))) for _ in range(3000)]
    same(own, library, [" ".join(rng.choices(words, k=20_000)), "short", " ".join(rng.choices(words, k=50))])


def test_query(spark, tmp_path, library):
    docs = spark.createDataFrame(DOCS, SCHEMA).withColumns({c: F.lit(1) for c in ("ids", "n_tokens")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for doc_id, text, *_ in DOCS:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    got = [tuple(r) for r in op11_sentence_pieces(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert pieces.encode(docs.limit(0), MODEL).count() == 0


def test_rounds_equal_one_merge_at_a_time(own):
    """The flat rounds against the plain method: the best pair of a word, the leftmost of equals, one by one."""
    rng = np.random.default_rng(1)
    table = {int(k): (int(r), int(m)) for k, r, m in zip(own.keys, own.ranks, own.makes, strict=False)}
    letters = own.single[own.kinds[[ord(c) for c in "sugar eatin"]]]
    words = [rng.choice(letters, rng.integers(1, 40)).astype(np.int32) for _ in range(300)]
    ids, sizes = own.merge(np.concatenate(words), np.array([len(w) for w in words]))
    want = []
    for w in words:
        left = w.tolist()
        while True:
            found = [(*table[a << 32 | b], k) for k, (a, b) in enumerate(zip(left, left[1:], strict=False)) if a << 32 | b in table]
            if not found:
                break
            _, made, k = min(found, key=lambda x: (x[0], x[2]))
            left[k : k + 2] = [made]
        want.append(left)
    assert ids.tolist() == [x for w in want for x in w]
    assert sizes.tolist() == [len(w) for w in want]
