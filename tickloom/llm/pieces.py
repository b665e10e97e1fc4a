"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The distinct words of a batch lie in flat numpy arrays, one symbol after the other. A round takes the
smallest pair rank of each word (the leftmost where it occurs twice), merges those pairs in all words at
once, compacts the arrays and looks up the ranks of the pairs that are new; words without a pair that can
merge leave. Each word thus sees the merges that the library's queue makes, in its order.

In a long word a round also merges every pair that no pair within REACH symbols comes before. The library
makes these merges too, with the same symbols: a merge that touches a symbol less than the longest piece (L
characters) away has all its parts within 2 L characters, and the first of them to be merged would be a pair of
now that comes before. So a round over a word without end merges many pairs, not one.

A word runs from a run of U+2581 (spaces are written as it) to the next. No piece of the vocabulary
has U+2581 after another character, which ``load`` checks, so no merge crosses such a border. Nor does one
cross a border between two characters that are neighbours in no piece, where words are cut further.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .storage import small_batches
from .textkernel import flat, slices, spread

#: Bytes of encoded words, WORD_BYTES and more for each, that a task remembers before it starts anew.
REMEMBERED_BYTES, WORD_BYTES = 96 << 20, 300
_SPACE = "▁"
_ABSENT = np.int64(1) << 62


class Pieces:
    """A BPE vocabulary with byte fallback: symbols are piece ids; characters without a piece get ids from
    ``n`` on while a batch is encoded."""

    def __init__(self, path: str) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = sp.get_piece_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        text = [sp.id_to_piece(i) for i in range(self.n)]
        normal = [i for i in range(self.n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(_SPACE in text[i].lstrip(_SPACE) for i in normal):
            raise ValueError("a piece has a space after another character")
        self.ids = {text[i]: i for i in normal}
        #: A pair that comes first among all within this many symbols on either side is merged at once.
        self.reach = 2 * max(map(len, self.ids)) + 4
        #: Symbol of each code point: its piece, or n + code point.
        self.of_char = self.n + np.arange(0x110000, dtype=np.int64)
        for c, i in self.ids.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        #: Neighbours (left * n + right) in some piece; no merge crosses a border between others.
        inside = {self.ids[a] * self.n + self.ids[b] for x in self.ids for a, b in zip(x, x[1:]) if a in self.ids and b in self.ids}
        self.neighbours = np.array(sorted(inside), np.int64)
        self.byte_id = np.zeros(256, np.int64)
        surface = [b""] * self.n
        self.is_byte = np.zeros(self.n, bool)
        for i in range(self.n):
            if sp.is_byte(i):
                value = int(text[i][3:5], 16)
                self.byte_id[value], surface[i], self.is_byte[i] = i, bytes([value]), True
        for i in normal:
            surface[i] = text[i].replace(_SPACE, " ").encode()
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_at = np.concatenate([[0], np.cumsum([len(x) for x in surface])])
        scores = np.array([sp.get_score(i) for i in range(self.n)])
        rank = np.unique(-scores, return_inverse=True)[1]
        pairs: dict[int, tuple[int, int]] = {}
        for i in normal:
            for cut in range(1, len(text[i])):
                a, b = self.ids.get(text[i][:cut]), self.ids.get(text[i][cut:])
                if a is not None and b is not None:
                    pairs[a * self.n + b] = (int(rank[i]), i)
        keys = np.array(sorted(pairs), np.int64)
        self.pair_key = keys
        self.pair_rank = np.array([pairs[k][0] for k in keys.tolist()], np.int64)
        self.pair_to = np.array([pairs[k][1] for k in keys.tolist()], np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of each pair; rank _ABSENT where there is none."""
        key = np.where((left < self.n) & (right < self.n), left * self.n + right, -1)
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = self.pair_key[at] == key
        return np.where(hit, self.pair_rank[at], _ABSENT), self.pair_to[at]

    def first_within(self, order: np.ndarray) -> np.ndarray:
        """Positions whose ``order`` is the smallest within ``reach`` on both sides and not _ABSENT."""
        padded = np.full(len(order) + 2 * self.reach, _ABSENT)
        padded[self.reach : self.reach + len(order)] = order
        least, width = padded, 1
        while width < 2 * self.reach + 1:
            step = min(width, 2 * self.reach + 1 - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        return np.flatnonzero((order == least) & (order < _ABSENT))

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their (ascending) words after all merges."""
        done_symbol, done_word = [symbols[:0]], [word[:0]]
        n = len(symbols)
        rank, to = np.full(n, _ABSENT), np.zeros(n, np.int64)  # of the pair of a symbol and the next one
        fresh = np.arange(n - 1)
        while n:
            fresh = fresh[word[fresh] == word[fresh + 1]]
            rank[fresh], to[fresh] = self.look(symbols[fresh], symbols[fresh + 1])
            order = np.where(rank < _ABSENT, (rank << 32) | np.arange(n), _ABSENT)
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(start, n))
            least = np.minimum.reduceat(order, start)
            live = least < _ABSENT
            best = least[live] & 0xFFFFFFFF
            if size.max() > self.reach:
                best = np.union1d(best, self.first_within(order))
            stay = np.repeat(live, size)
            done_symbol.append(symbols[~stay])
            done_word.append(word[~stay])
            symbols[best] = to[best]
            stay[best + 1] = False
            at = np.cumsum(stay)[best] - 1
            rank[best] = _ABSENT
            symbols, word, rank, to = symbols[stay], word[stay], rank[stay], to[stay]
            n = len(symbols)
            fresh = np.unique(np.concatenate([at - 1, at]))
            fresh = fresh[(fresh >= 0) & (fresh < n - 1)]
            rank[fresh] = _ABSENT
        symbols, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (UTF-8, not empty)."""
        if not words:
            return []
        joined = b"".join(words)
        bounds = np.cumsum([0, *map(len, words[:-1])])
        size = np.add.reduceat(((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80).astype(np.int64), bounds)
        points = np.frombuffer(joined.decode().replace(" ", _SPACE).encode("utf-32-le"), "<u4")
        symbols, word = self.of_char[points], np.repeat(np.arange(len(words)), size)
        key = symbols[:-1] * self.n + symbols[1:]
        met = self.neighbours[np.minimum(np.searchsorted(self.neighbours, key), len(self.neighbours) - 1)] == key
        border = (word[1:] != word[:-1]) | ~met | (symbols[:-1] >= self.n) | (symbols[1:] >= self.n)
        part = np.concatenate([[0], np.cumsum(border)])
        merged, part_of = self.merge(symbols, part)
        word = word[np.searchsorted(part, part_of)]
        if (merged >= self.n).any():  # characters without a piece become bytes
            extra = np.unique(merged[merged >= self.n])
            lists = [self.byte_id[list(chr(c).encode())] for c in (extra - self.n).tolist()]
            values = np.concatenate([np.arange(self.n), *lists])
            offsets = np.concatenate([np.arange(self.n + 1), self.n + np.cumsum([len(x) for x in lists])])
            merged, count = spread(offsets, values, np.where(merged < self.n, merged, self.n + np.searchsorted(extra, merged)))
            word = np.repeat(word, count)
        cuts = np.searchsorted(word, np.arange(len(words) + 1))
        merged = merged.astype(np.uint32)
        return [merged[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts of the id lists ``ids[bounds[d]:bounds[d + 1]]``: the pieces' characters without the first
        space, bytes as UTF-8 with U+FFFD for each byte that is in no character."""
        raw, size = spread(self.surface_at, self.surface, ids)
        at = np.concatenate([[0], np.cumsum(size)])[bounds].tolist()
        whole = raw.tobytes()
        return [whole[a + (whole[a : a + 1] == b" " and a < b) : b] for a, b in zip(at[:-1], at[1:], strict=True)]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _word_bounds(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte positions where a word begins, documents' starts included: at a space (or U+2581) after anything else."""
    n = len(raw)
    is_space = raw == 32
    mark = np.zeros(n, bool)
    if n >= 3:
        mark[:-2] = (raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)
    head = is_space | mark
    tail = is_space.copy()
    tail[2:] |= mark[:-2]
    begin = head.copy()
    begin[1:] &= ~tail[:-1]
    return np.unique(np.concatenate([np.flatnonzero(begin), off[:-1][off[:-1] < n]]))


def _encode(path: str, carry: tuple[str, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        known: dict[bytes, np.ndarray] = {}
        held = 0
        for batch in batches:
            for part in slices(batch, "text"):
                raw, off = flat(part.column("text"))
                begin = _word_bounds(raw, off)
                ends = np.concatenate([begin[1:], [len(raw)]])
                first = np.zeros(len(raw) + 1, bool)
                first[off] = True
                opens = first[begin]
                at = pa.array(np.append(begin, len(raw)), pa.int64())
                words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, at.buffers()[1], pa.py_buffer(raw.tobytes())])
                # the first word of a text has a space before it
                coded = words.dictionary_encode()
                index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                size = len(coded.dictionary)
                key = index + size * opens
                used, key = np.unique(key, return_inverse=True)
                names = coded.dictionary.to_pylist()
                bodies = [(b" " if u >= size else b"") + names[u % size] for u in used.tolist()]
                fresh = [b for b in bodies if b not in known]
                known.update(zip(fresh, model.encode_words(fresh), strict=True))
                lists = [known[b] for b in bodies]
                held += sum(WORD_BYTES + 5 * len(b) for b in fresh)
                if held > REMEMBERED_BYTES:
                    known, held = {}, 0
                flat_ids = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
                ids, count = spread(bounds, flat_ids, key)
                per_doc = np.diff(np.concatenate([[0], np.cumsum(count)])[np.searchsorted(begin, off)])
                inner = np.concatenate([[0], np.cumsum(per_doc + 2)])
                out = np.empty(int(inner[-1]), "<u4")
                edge = np.zeros(len(out), bool)
                edge[inner[:-1]] = edge[inner[1:] - 1] = True
                out[~edge] = ids
                out[inner[:-1]], out[inner[1:] - 1] = model.bos, model.eos
                blob = out.tobytes()
                packed = [blob[4 * a : 4 * b] for a, b in zip(inner[:-1].tolist(), inner[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(part.column, carry), pa.array(per_doc + 2, pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", *carry, "n_tokens", "ids"])
                del ends

    return run


def _decode(path: str, carry: tuple[str, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for part in slices(batch, "ids"):
                raw, off = flat(part.column("ids"))
                texts = model.decode(np.frombuffer(raw.tobytes(), "<u4").astype(np.int64), off // 4)
                yield pa.RecordBatch.from_arrays([*map(part.column, ("doc_id", *carry, "n_tokens", "ids")), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], names=["doc_id", *carry, "n_tokens", "ids", "decoded"])

    return run


def _carried(df: DataFrame, carry: tuple[str, ...]) -> str:
    return "".join(f"{c} {df.schema[c].dataType.simpleString()}, " for c in carry)


def encode(docs: DataFrame, model_path: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_tokens, ids`` for each row of ``docs`` (doc_id, text): ids with begin and end id, as
    little-endian unsigned 32-bit integers. The columns ``carry`` of ``docs`` stay, after doc_id.

    Every whole text is encoded as the sentencepiece library does without sampling. Null counts as
    empty, an empty text has the two outer ids. Repeated rows repeat; other columns are ignored.
    """
    return small_batches(docs).select("doc_id", *carry, "text").mapInArrow(_encode(model_path, carry), f"doc_id long, {_carried(docs, carry)}n_tokens long, ids binary")


def decode(encoded: DataFrame, model_path: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids; null or empty ids give an empty text."""
    return small_batches(encoded).select("doc_id", *carry, "n_tokens", "ids").mapInArrow(_decode(model_path, carry), f"doc_id long, {_carried(encoded, carry)}n_tokens long, ids binary, decoded string")


def encode_and_decode(docs: DataFrame, model_path: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """What ``decode`` makes of ``encode``, by one Python process a task in place of two: each one holds the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode(model_path, carry)(_encode(model_path, carry)(batches))

    return small_batches(docs).select("doc_id", *carry, "text").mapInArrow(run, f"doc_id long, {_carried(docs, carry)}n_tokens long, ids binary, decoded string")
