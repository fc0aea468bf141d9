"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

A text is cut between characters that stand side by side in no piece of the vocabulary, so no merge crosses a cut; new words of a
run of texts are encoded together, others are remembered. Their symbols lie in one flat array. A round finds each
word's least pair rank (a segmented minimum), merges the leftmost pairs of that rank in all words at once, looks the new neighbours'
ranks up and compacts the arrays, until no word has a pair left. Within one word several pairs are merged in a round only where that
can't differ from merging them one by one: pieces that no better-ranked piece extends, or pairs too far apart to meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gablework.llm.common import lean, short_batches, text_buffers
from gablework.llm.tokens import Remembering

_NONE = np.int32(2**31 - 1)
_SPACE = "▁"
#: Ids that are decoded by one call of the library.
DECODED = 1 << 16
_ENCODERS: dict[str, Pieces] = {}


def encoder(path: str) -> Pieces:
    """The worker's encoder of a model file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Pieces(path)
    return _ENCODERS[path]


class Pieces(Remembering):
    """A BPE model with byte fallback, a dummy prefix, escaped white space and no other normalisation."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        super().__init__()
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        how, trained = proto.normalizer_spec, proto.trainer_spec
        if trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix or how.precompiled_charsmap or not how.add_dummy_prefix or how.remove_extra_whitespaces or not how.escape_whitespaces:
            raise ValueError(f"{path}: only BPE with byte fallback, a dummy prefix and no normalisation")
        kinds = proto.SentencePiece.Type
        if any(p.type not in (kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN) for p in proto.pieces):
            raise ValueError(f"{path}: user-defined and unused pieces are not supported")
        self.model = SentencePieceProcessor(model_file=path)
        self.names = [str(k).encode() for k in range(len(proto.pieces))]
        score = {p.piece: (p.score, k) for k, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.bytes = np.zeros(256, np.uint32)
        self.is_byte = np.zeros(len(proto.pieces), bool)
        for k, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = k
                self.is_byte[k] = True
        self._characters(score)
        self._pairs(score)
        self.blank = self._blanks(score)
        self.guard = self.model.encode("a")[-1:]

    def _characters(self, score: dict[str, tuple[float, int]]) -> None:
        """Numbers of characters (0: in no piece; the two forms of white space are one) and which stand side by side in a piece."""
        letters = sorted(set("".join(score)))
        if any(c not in score for c in letters):
            raise ValueError("a piece has a character that is no piece itself")
        self.kinds = np.zeros(max(map(ord, letters)) + 2, np.int32)
        self.kinds[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.space = self.kinds[32] = self.kinds[ord(_SPACE)]
        self.single = np.array([0, *(score[c][1] for c in letters)], np.int32)
        self.width = len(letters) + 1
        self.beside = np.zeros(self.width**2, bool)
        number = {c: k for k, c in enumerate(letters, 1)}
        for p in score:
            for a, b in zip(p, p[1:], strict=False):
                self.beside[number[a] * self.width + number[b]] = True
        self.longest = max(map(len, score))

    def _blanks(self, score: dict[str, tuple[float, int]]) -> int:
        """Where pieces of white space (two or more) hold nothing else and share the worst rank, a run of it is merged from the left,
        one longest piece after the other, while at least one more follows. Then a long run can be cut there. 0: it can't."""
        blank = [p for p in score if p[:2] == _SPACE * 2]
        worst = min(s for s, _ in score.values())
        if not blank or any(p != _SPACE * len(p) or score[p][0] != worst for p in blank):
            return 0
        size = max(map(len, blank))
        ids, _ = self.merge(np.full(3 * size + 1, score[_SPACE][1], np.int32), np.array([3 * size + 1]))
        return size if ids.tolist() == [score[_SPACE * size][1]] * 3 + [score[_SPACE][1]] else 0

    def _pairs(self, score: dict[str, tuple[float, int]]) -> None:
        """Pairs of pieces that make a piece, in order of their keys, with its rank and number; which ranks may be merged all at once."""
        order = {s: r for r, s in enumerate(sorted({s for s, _ in score.values()}, reverse=True))}
        rank = {p: order[s] for p, (s, _) in score.items()}
        uses = np.bincount(list(rank.values()), minlength=len(order))
        self.free = uses == 1
        found = []
        for p, (_, k) in score.items():
            for i in range(1, len(p)):
                a, b = p[:i], p[i:]
                if a in score and b in score:
                    found.append((score[a][1] << 32 | score[b][1], rank[p], k))
                    for x in (a, b):
                        if rank[p] <= rank[x]:
                            self.free[rank[x]] = False
        found.sort()
        self.keys = np.array([x[0] for x in found], np.int64)
        self.ranks, self.makes = (np.array([x[j] for x in found] + [fill], np.int32) for j, fill in ((1, _NONE), (2, 0)))

    def _look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of pairs in the table; its end for those that make nothing."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[np.minimum(at, len(self.keys) - 1)] == key, at, len(self.keys))

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words (each of one character or more), one after the other, after all merges, and how many each word has."""
        n, word, place = len(self.keys), np.repeat(np.arange(len(sizes)), sizes), np.arange(len(symbols))
        pair = np.full(len(symbols), n)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pair[inside] = self._look_up(symbols[inside], symbols[inside + 1])
        done, owner = [], []
        while len(symbols):
            heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            rank = self.ranks[pair]
            least = np.minimum.reduceat(rank, heads)
            count = np.diff(np.append(heads, len(symbols)))
            ended = least == _NONE
            if ended.any():
                out = np.repeat(ended, count)
                done.append(symbols[out])
                owner.append(word[out])
                symbols, word, place, pair, rank = (x[~out] for x in (symbols, word, place, pair, rank))
                least, count = least[~ended], count[~ended]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, count))
            own, near = word[hit], np.ones(len(hit), bool)
            near[0] = False
            same = own[1:] == own[:-1]
            near[1:] = same & (place[hit[1:]] - place[hit[:-1]] < 4 * self.longest)
            # Of pairs that overlap, every second one, from the left.
            touch = np.zeros(len(hit), bool)
            touch[1:] = same & (np.diff(hit) == 1)
            first = np.maximum.accumulate(np.where(touch, 0, np.arange(len(hit))))
            even = (np.arange(len(hit)) - first) % 2 == 0
            chosen = hit[np.where(self.free[rank[hit]], even, ~near)]
            symbols[chosen] = self.makes[pair[chosen]]
            stays = np.ones(len(symbols), bool)
            stays[chosen + 1] = False
            moved = np.cumsum(stays) - 1
            symbols, word, place, pair = (x[stays] for x in (symbols, word, place, pair))
            new = moved[chosen]
            new = np.unique(np.concatenate((new, new[new > 0] - 1)))
            pair[new] = n
            new = new[new + 1 < len(symbols)]
            new = new[word[new] == word[new + 1]]
            pair[new] = self._look_up(symbols[new], symbols[new + 1])
        ids, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done, owner))
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owner, minlength=len(sizes)).astype(np.int32)

    def _read(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Kinds of characters and, unless each is one byte, where they begin."""
        if not len(data) or data.max() < 128:
            return self.kinds[data], None
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        return self.kinds[np.minimum(codes, len(self.kinds) - 1)], np.flatnonzero((data & 0xC0) != 0x80)

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and how many each has. A character of no piece is a word alone and becomes its bytes."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        kinds, begins = self._read(data)
        ends = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        rows = ends if begins is None else np.searchsorted(begins, ends)
        sizes, odd = np.diff(rows), kinds[rows[:-1]] == 0
        known = np.repeat(~odd, sizes)
        ids, counts = self.merge(self.single[kinds[known]], sizes[~odd])
        total = np.zeros(len(pieces), np.int32)
        total[~odd], total[odd] = counts, np.diff(ends)[odd]
        out, of = np.empty(int(total.sum()), np.uint32), np.repeat(odd, total)
        out[~of], out[of] = ids, self.bytes[data[np.repeat(odd, np.diff(ends))]]
        return out, total

    def _run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and row offsets of a run of rows."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        kinds, begins = self._read(data)
        rows = offsets if begins is None else np.searchsorted(begins, offsets)
        cut = np.ones(len(kinds), bool)
        cut[1:] = ~self.beside[kinds[:-1] * self.width + kinds[1:]]
        cut[rows[:-1][rows[:-1] < len(kinds)]] = True
        if self.blank:
            space = np.flatnonzero(kinds == self.space)
            if len(space):
                head = np.ones(len(space), bool)
                head[1:] = (np.diff(space) > 1) | cut[space[1:]]
                count = np.arange(len(space)) - np.maximum.accumulate(np.where(head, np.arange(len(space)), 0))
                cut[space[count % self.blank == 0]] |= count[count % self.blank == 0] > 0
        return self._joined(data, np.flatnonzero(cut), begins, rows)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none), one after the other, and the offsets of the rows."""
        data, offsets = text_buffers(column)
        filled = np.diff(offsets) > 0
        shift = np.concatenate(([0], np.cumsum(filled)))
        wide = np.full(len(data) + int(shift[-1]), 32, np.uint8)
        wide[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
        ends = pa.py_buffer(offsets + shift)
        return super().__call__(pa.Array.from_buffers(pa.large_binary(), len(filled), [None, ends, pa.py_buffer(wide)]))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids by the library, a part at a time; parts end where no byte follows, and a letter before each but the first
        keeps its blank."""
        out, lo = [], 0
        while lo < len(ids):
            hi = lo + DECODED
            while hi < len(ids) and self.is_byte[ids[hi]]:
                hi += 1
            own = ids[lo:hi].tolist()
            out.append(self.model.decode(self.guard + own)[1:] if lo else self.model.decode(own))
            lo = hi
        return "".join(out)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas) and text (decoded from the ids) of every whole text.

    A null or empty text has no ids and decodes to an empty one. Rows, repeated or without an id, are encoded each; other columns are
    ignored, and an empty table gives none. Nothing is shuffled; a task holds an Arrow batch, or one long text, at a time. A
    word without a cut costs a round for each rank that it merges, over its length."""
    short_batches(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids", "text"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(vocabulary)
        for batch in batches:
            ids, ends = pieces(batch.column("text"))
            rows = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            listed = pa.array([b",".join(map(pieces.names.__getitem__, x.tolist())) for x in rows], pa.binary()).cast(pa.string())
            texts = pa.array([pieces.decode(x) for x in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(ends), pa.int64()), listed, texts], names)

    return docs.select("doc_id", "text").mapInArrow(lean(encoded), "doc_id long, n_tokens long, ids string, text string")
