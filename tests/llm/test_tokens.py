"""How much of the tokenizers library's work op4's encoder asks for."""

import numpy as np
import pyarrow as pa

from gablework.llm import repair, tokens

WORDS = tokens.public_path("word_bpe_49k.json")


class Counted:
    """A library object whose calls are counted."""

    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def __getattr__(self, name):
        def call(*values, **named):
            self.calls += 1
            return getattr(self.inner, name)(*values, **named)

        return call


def _texts(n, seed):
    """Texts of n words, nearly all of them different, with other letters, signs, numbers and blanks between."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDÄÖÜßéñǅŁ"))
    words = ["".join(letters[rng.integers(0, len(letters), k)]) for k in rng.integers(3, 11, n)]
    between = np.array([" ", " ", " ", "\n", " ", ", ", "*** ", " 42 ", "'s ", " </w> ", "–"])[rng.integers(0, 11, n)]
    return ["".join(w + b for w, b in zip(words[k : k + 500], between[k : k + 500], strict=True)) for k in range(0, n, 500)]


def test_new_words_are_merged_many_at_once():
    """40,000 words, new to the encoder, take the library a few hundred calls (one each before), and equal its own ids."""
    texts = _texts(40_000, 5) + ["", "  \n", "É"]
    own = tokens.Encoder(WORDS, False)
    held = [name for name, x in vars(own).items() if type(x).__module__.startswith("tokenizers") and name != "model"]
    for name in held:
        setattr(own, name, Counted(getattr(own, name)))
    ids, rows = own(pa.array(texts))
    print("calls", {name: getattr(own, name).calls for name in held})
    assert 0 < sum(getattr(own, name).calls for name in held) < 1000
    whole = own.model.encode_batch_fast(texts, add_special_tokens=False)
    assert [x.ids for x in whole] == [ids[rows[k] : rows[k + 1]].tolist() for k in range(len(texts))]


def test_token_files_remember_more_words(monkeypatch):
    """In op4's room three times as many words as CACHE_PIECES are remembered; the second time none of them is merged. In a room of one, most are."""
    monkeypatch.setattr(tokens, "CACHE_PIECES", 10_000)
    monkeypatch.setattr(tokens, "RUN", 1 << 16)
    column, again = pa.array(_texts(30_000, 6)), []
    for room in (repair.ROOM, 1):
        own, new = tokens.Encoder(WORDS, False, room), []
        merged = own._merged
        monkeypatch.setattr(own, "_merged", lambda pieces, new=new, merged=merged: (new.extend(pieces), merged(pieces))[1])
        first = own(column)
        new.clear()
        second = own(column)
        assert all(np.array_equal(a, b) for a, b in zip(first, second, strict=True))
        again.append(len(new))
    print("merged again", again)
    assert again[0] == 0 and again[1] > 10_000
