"""Token ids of whole texts by the tokenizers library.

Both public vocabularies cut a text into pre-tokens before merging. Where a run of texts holds common characters only (Latin letters,
digits, punctuation, white space), its pre-tokens follow from the classes of neighbouring characters, so they are cut
for whole runs at once; the library's merges encode every distinct pre-token once, and the runs' ids are put together
by numpy. Texts with any other character, or with the beginning of a special token, are encoded by the library as they are.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa

from gablework.llm.common import ranges, text_buffers

#: Pre-tokens that a worker remembers, and ids that it holds for them; when it is full, those seen in one run alone are forgotten.
CACHE_PIECES, CACHE_IDS = 200_000, 2_000_000
#: Longer pre-tokens are not remembered.
LONGEST = 64
#: Bytes of text that are worked on at a time. A longer text is cut where a single blank or line end stands between
#: plain letters or digits, which ends a pre-token in both vocabularies.
RUN = 1 << 19
_SAFE = re.compile(rb"[0-9A-Za-z][ \n][0-9A-Za-z]")
#: Letters of new pre-tokens that the library merges in one call, where ids tell which of them end a word.
JOINED = 4096

_OTHER, _LETTER, _NUMBER, _SPACE, _ODD = range(5)
_ENCODERS: dict[tuple[str, bool, int], Encoder] = {}


def public_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, blank_counts: bool, room: int = 1) -> Encoder:
    """The worker's encoder of a vocabulary file; blank_counts: the blank before a word is part of its pre-token; room: how many
    times RUN and the memory of pre-tokens it may take."""
    key = path, blank_counts, room
    if key not in _ENCODERS:
        # One vocabulary's memory at a time.
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, blank_counts, room)
    return _ENCODERS[key]


def _classes(keeps_case: bool) -> np.ndarray:
    """Classes of code points; all from the table's length on are odd. Control characters are left to the library, and so is
    the one Latin letter whose lower case isn't a letter alone."""
    table = np.full(0x20B1, _ODD, np.uint8)
    for c in (*range(0x250), *range(0x2010, 0x2028), 0x20AC):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            table[c] = _LETTER
        elif kind[0] == "N":
            table[c] = _NUMBER
        elif c in (9, 10, 13, 32, 0xA0):
            table[c] = _SPACE
        elif kind != "Cc":
            table[c] = _OTHER
    if not keeps_case:
        table[0x130] = _ODD
    return table


class Remembering:
    """Pre-tokens and their ids: ids[start[k] : start[k] + size[k]] for the one at place k. A class that extends it
    encodes runs of rows (_run) and new pre-tokens (_merged)."""

    def __init__(self, room: int = 1):
        self.room = room
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0
        self.start, self.size, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), 0
        #: Runs in which a pre-token was met.
        self.runs = np.zeros(1 << 16, np.int32)
        self.known: dict[bytes, int] = {}

    def _forget(self) -> None:
        least = 2
        while np.count_nonzero(self.runs[list(self.known.values())] >= least) > self.room * CACHE_PIECES // 2:
            least *= 2
        kept = {p: k for p, k in self.known.items() if self.runs[k] >= least}
        at = np.fromiter(kept.values(), np.int64, len(kept))
        ids, sizes, runs = self.ids[ranges(self.start[at], self.size[at])], self.size[at], self.runs[at]
        if len(ids) > self.room * CACHE_IDS // 2:
            kept, ids, sizes, runs = {}, ids[:0], sizes[:0], runs[:0]
        self.used = self.n = 0
        self._store(ids, sizes)
        self.runs[: self.n] = runs // 2
        self.known = {p: k for k, p in enumerate(kept)}

    def _store(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """The place of the first of new pre-tokens."""
        n, k = len(ids), len(sizes)
        while self.used + n > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.n + k > len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
            self.runs = np.concatenate((self.runs, np.zeros_like(self.runs)))
        self.ids[self.used : self.used + n] = ids
        self.start[self.n : self.n + k] = self.used + np.cumsum(sizes) - sizes
        self.size[self.n : self.n + k] = sizes
        self.runs[self.n : self.n + k] = 0
        self.used, self.n = self.used + n, self.n + k
        return self.n - k

    def _places(self, names: list[bytes]) -> np.ndarray:
        places = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        lost = np.flatnonzero(places < 0)
        if len(lost):
            new = [names[k] for k in lost.tolist()]
            first = self._store(*self._merged(new))
            places[lost] = np.arange(first, first + len(new))
            self.known.update((p, first + k) for k, p in enumerate(new) if len(p) <= LONGEST)
        self.runs[places] += 1
        return places

    def _joined(self, data: np.ndarray, starts: np.ndarray, begins: np.ndarray | None, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and row offsets of a run whose pre-tokens begin at the characters starts (bytes begins[starts]); rows: characters."""
        ends = np.append(starts if begins is None else begins[starts], len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        places = self._places(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        index = pieces.indices.to_numpy()
        size = self.size[places][index]
        done = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=done[1:])
        return self.ids[ranges(self.start[places][index], size)], done[np.searchsorted(starts, rows)]

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none), one after the other, and the offsets of the rows."""
        data, offsets = text_buffers(column)
        # Parts of long texts are rows of their own at first.
        cuts = [offsets]
        for k in np.flatnonzero(np.diff(offsets) > RUN).tolist():
            at, end, view = int(offsets[k]) + RUN // 2, int(offsets[k + 1]), memoryview(data)
            while (found := _SAFE.search(view, at, end)) is not None:
                cuts.append(np.array([found.start() + 1]))
                at = found.start() + RUN // 2
        split = np.sort(np.concatenate(cuts)) if len(cuts) > 1 else offsets
        ids, sizes, lo, run, most = [], [], 0, self.room * RUN, self.room * CACHE_PIECES
        while lo < len(split) - 1:
            hi = max(lo + 1, int(np.searchsorted(split, split[lo] + run, "right")) - 1)
            if len(self.known) > most or self.used > self.room * CACHE_IDS or self.n > 2 * most:
                self._forget()
            own, rows = self._run(data[split[lo] : split[hi]], split[lo : hi + 1] - split[lo])
            ids.append(own)
            sizes.append(np.diff(rows))
            lo = hi
        if not ids:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        if len(cuts) == 1:
            return np.concatenate(ids), ends
        # Empty rows at one place take its first boundary, so the last of a row's parts ends where the next row begins.
        kept = np.ones(len(split), bool)
        kept[np.searchsorted(split, np.concatenate(cuts[1:]))] = False
        return np.concatenate(ids), ends[kept]


class Encoder(Remembering):
    """One vocabulary of the tokenizers library."""

    def __init__(self, path: str, blank_counts: bool, room: int = 1):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        super().__init__(room)
        self.model = Tokenizer.from_file(path)
        self.merges = self.model.model
        self.blank = blank_counts
        self.classes = _classes(blank_counts)
        #: Whether an id ends a word, where the vocabulary marks that.
        self.ends = None
        suffix, vocabulary = self.merges.end_of_word_suffix, self.model.get_vocab(False)
        if suffix and not blank_counts and all(chr(x) + y in vocabulary for x in _LETTERS.tolist() if x != 32 for y in ("", suffix)):
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[k for p, k in vocabulary.items() if p.endswith(suffix)]] = True
            self.words = Tokenizer(self.merges)
            self.words.pre_tokenizer = WhitespaceSplit()

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """_merged for a vocabulary that marks the ends of words: the library takes many pre-tokens at once, and its ids tell
        where each ends. None holds the mark itself, as letters and signs are cut apart."""
        shown = np.fromiter((p[0] not in b"\t\n\r " and p[:2] != b"\xc2\xa0" for p in pieces), bool, len(pieces))
        low = b" ".join(compress(pieces, shown.tolist())).decode().lower().encode()
        letters = _LETTERS[np.frombuffer(low, np.uint8)].tobytes().decode("utf-32-le")
        found, lo = [], 0
        while lo < len(letters):
            hi = letters.find(" ", lo + JOINED)
            hi = len(letters) if hi < 0 else hi
            found.append(np.array(self.words.encode_batch_fast([letters[lo:hi]], add_special_tokens=False)[0].ids, np.uint32))
            lo = hi
        ids, sizes = np.concatenate(found) if found else np.zeros(0, np.uint32), np.zeros(len(pieces), np.int32)
        sizes[shown] = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return ids, sizes

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens and how many each has; where blanks don't count, white space has none and letters are in lower case."""
        if self.ends is not None:
            return self._together(pieces)
        merge, blank = self.merges.tokenize, _BYTE_LETTERS[32]
        out = []
        for p in pieces:
            if self.blank:
                letters = blank + p[1:].decode() if p[0] == 32 and p[1:].isalpha() else p.decode("latin-1").translate(_BYTE_LETTERS)
            elif p.isalpha():
                letters = p.lower().decode()
            elif p[0] in b"\t\n\r " or p[:2] == b"\xc2\xa0":
                out.append([])
                continue
            else:
                letters = p.decode().lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
            out.append([x.id for x in merge(letters)])
        sizes = np.fromiter(map(len, out), np.int32, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint32, int(sizes.sum())), sizes

    def _cuts(self, codes: np.ndarray, kinds: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Whether a pre-token begins at each character; heads: where rows begin."""
        n = len(codes)
        cut = np.ones(n, bool)
        np.not_equal(kinds[1:], kinds[:-1], out=cut[1:])
        if self.blank:
            ends = np.flatnonzero((kinds[:-1] == _SPACE) & (kinds[1:] != _SPACE))
            inside = np.ones(n + 1, bool)
            inside[heads] = False
            ends = ends[inside[ends + 1]]
            # The last of white space before a word stands alone; a blank goes with the word.
            cut[ends] = True
            cut[ends[codes[ends] == 32] + 1] = False
        else:
            cut[kinds == _NUMBER] = True
        cut[heads] = True
        # Short forms after an apostrophe that begins a pre-token.
        at = np.flatnonzero(codes == 39)
        at = at[cut[at]]
        if len(at):
            ends = np.append(heads, n)[np.searchsorted(heads, at, "right")]
            wide = np.concatenate((codes, np.zeros(2, codes.dtype)))
            one, two = (np.where(at + k < ends, wide[at + k], 0) for k in (1, 2))
            if not self.blank:
                one, two = (np.where((x >= 65) & (x <= 90), x + 32, x) for x in (one, two))
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            own, size = at[short | long], np.where(long, 3, 2)[short | long]
            cut[own + 1] = False
            after = own + size
            cut[after[after < n]] = True
        return cut

    def _run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and row offsets of a run of rows."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if data.max() < 128:
            codes, begins, rows, kinds = data, None, offsets, self.classes[data]
        else:
            codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            begins = np.flatnonzero((data & 0xC0) != 0x80)
            rows = np.searchsorted(begins, offsets)
            # The table's last class is odd.
            kinds = self.classes[np.minimum(codes, len(self.classes) - 1)]
        odd = np.concatenate((np.flatnonzero(kinds == _ODD), np.flatnonzero((codes[:-1] == 60) & (codes[1:] == 124))))
        if len(odd):
            return self._mixed(data, offsets, np.unique(np.searchsorted(rows, odd, "right") - 1))
        starts = np.flatnonzero(self._cuts(codes, kinds, np.unique(rows[:-1][rows[:-1] < len(codes)])))
        return self._joined(data, starts, begins, rows)

    def _mixed(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows odd by the library, the others together."""
        whole = self.model.encode_batch_fast([data[offsets[k] : offsets[k + 1]].tobytes().decode() for k in odd.tolist()], add_special_tokens=False)
        plain = np.ones(len(offsets) - 1, bool)
        plain[odd] = False
        length = np.diff(offsets)
        ids, rows = self._run(data[np.repeat(plain, length)], np.concatenate(([0], np.cumsum(np.where(plain, length, 0)))))
        parts, lo = [], 0
        for k, x in zip(odd.tolist(), whole, strict=True):
            parts += [ids[rows[lo] : rows[k]], np.asarray(x.ids, np.uint32)]
            lo = k
        parts.append(ids[rows[lo] :])
        sizes = np.diff(rows)
        sizes[odd] = [len(x) for x in whole]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes which don't print."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()
#: Code points of all bytes' letters; a blank stays, to stand between pre-tokens.
_LETTERS = np.array([b if b == 32 else ord(_BYTE_LETTERS.get(b, chr(b))) for b in range(256)], np.uint32)


def with_end(ids: np.ndarray, rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the id end to every row."""
    n = len(rows) - 1
    rows2 = rows + np.arange(n + 1)
    mask = np.ones(len(ids) + n, bool)
    mask[rows2[1:] - 1] = False
    out = np.full(len(mask), end, np.uint32)
    out[mask] = ids
    return out, rows2
