"""The classifier's statistics against plain Python."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gablework.llm import quality

GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "blank": b" \t", "line_end": b"\n", "stop": b".", "comma": b",;:", "exclaims": b"!?",
    "bar": b"|", "symbol": b"#$%&*@^~+=", "slash": b"/\\<>{}[]_", "quote": b"'\"`()", "dash": b"-",
}


def _kind(b: int) -> str:
    if b >= 128:
        return "high"
    return next((k for k, chars in GROUPS.items() if b in chars), "control" if b < 32 else "other")


def plain(text: str | None) -> list[float]:
    data = (text or "").encode()
    kinds, n = Counter(map(_kind, data)), max(len(data), 1)
    words = [w for w in data.replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if w]
    lines, breaks = [x for x in data.split(b"\n") if x], data.count(b"\n")
    per, sizes = max(len(words), 1), [len(w) for w in words]
    mean = sum(sizes) / per
    repeats = [x for k, x in enumerate(lines) if x in lines[:k]]
    return [
        *(kinds[c] / n for c in quality._CLASSES), math.log1p(len(data)), math.log1p(len(words)), mean, math.sqrt(max(sum(x * x for x in sizes) / per - mean**2, 0)),
        sum(x <= 3 for x in sizes) / per, sum(x >= 12 for x in sizes) / per, len(set(words)) / per, max(Counter(words).values(), default=0) / per, math.log1p(len(lines)),
        len(data) / max(len(lines), 1), (breaks + 1 - len(lines)) / (breaks + 1), len(repeats) / max(len(lines), 1), sum(map(len, repeats)) / n,
        sum(_kind(w[0]) == "upper" for w in words) / per, -sum(c / n * math.log2(c / n) for c in Counter(data).values()),
    ]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=st.sampled_from("aAbZ09 \t\n.,!|#/'-é的\r\x00~"), max_size=60), max_size=6))
def test_statistics_equal_plain_ones(texts):
    got = quality.statistics(pa.array(texts, pa.string()))
    assert got.shape == (len(texts), len(quality.NAMES))
    for row, text in zip(got, texts, strict=True):
        assert row.tolist() == pytest.approx(plain(text), abs=1e-9)


def test_statistics_of_many_rows():
    text = "Line of Words, number 12!\n\nLine of Words, number 12!\n" * 80
    got = quality.statistics(pa.array([text, "x"] * 300))
    assert np.allclose(got[598], plain(text)) and np.allclose(got[599], plain("x"))
