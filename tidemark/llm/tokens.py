"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

Byte-level BPE never merges across the words of its pre-tokenizer, and a blank
before a visible character always begins a new word. A text is therefore cut
at those blanks (and at line ends between visible characters) and the ids of a
text are gathered from its pieces; the library's model encodes every distinct
word once. The strings of the file's added tokens are ordinary text, unless
``added_tokens`` is set: then a text that holds one goes through the library
whole, and the ids equal those of ``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import ranges

MEMO_PIECES = 500_000
MEMO_CHARS = 24_000_000
VISIBLE_AFTER_SPACE = re.compile(r" (?=\S)")


def _byte_names() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memo(dict):
    """Piece -> row number; a piece not seen before gets the next row."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        row = self[piece] = len(self)
        self.new.append(piece)
        return row


class _Words(dict):
    """Word of the pre-tokenizer -> its ids as bytes, encoded by the library when first met."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenize, self.names = tokenizer.model.tokenize, _byte_names()

    def __missing__(self, word: str) -> bytes:
        named = word.encode().decode("latin1").translate(self.names)
        got = self[word] = array("I", [t.id for t in self.tokenize(named)]).tobytes()
        return got


class _Pieces:
    """Ids of the pieces met so far; forgets everything when it outgrows its bounds."""

    def __init__(self, encode, literal):
        self.encode, self.literal = encode, literal
        self.clear()

    def clear(self) -> None:
        self.memo, self.chars = _Memo(), 0
        self.start = np.zeros(1024, np.int64)
        self.length = np.zeros(1024, np.int64)
        self.odd = np.zeros(1024, bool)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def tidy(self) -> None:
        if len(self.memo) > MEMO_PIECES or self.chars > MEMO_CHARS:
            self.clear()

    def rows(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))

    def learn(self) -> None:
        """Encode the pieces met since the last call."""
        new, self.memo.new = self.memo.new, []
        if not new:
            return
        first, total = len(self.memo) - len(new), len(self.memo)
        if total > len(self.start):
            self.start, self.length, self.odd = (np.resize(x, 2 * total) for x in (self.start, self.length, self.odd))
        texts = [self.literal(p) for p in new]
        self.chars += sum(map(len, new))
        got = [self.encode(t) if t else b"" for t in texts]
        lengths = np.fromiter(map(len, got), np.int64, len(got)) // 4
        ids = np.frombuffer(b"".join(got), np.uint32)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.odd[first:total] = [t is None for t in texts]
        self.length[first:total] = lengths
        self.start[first:total] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)

    def gather(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, number of ids of each run of ``sizes`` rows)."""
        lengths = self.length[rows]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(sizes)
        return self.ids[ranges(self.start[rows], lengths)], upto[ends] - upto[ends - sizes]


def _plain_literal(piece: str) -> str | None:
    """The text of a piece cut at blanks and line ends; None where that cut may not be made.

    A leading line end stands for itself; any other piece follows one blank.
    """
    body = piece[1:] if piece[:1] == "\n" else piece
    if body.split() != [body]:
        return None
    return piece if piece[:1] == "\n" else " " + piece


class Encoder:
    """Ids of many texts at a time; keeps the words it has met, within fixed bounds."""

    def __init__(self, path: str, added_tokens: bool = False):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content] if added_tokens else []
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.plain = _Pieces(self._encode_piece, _plain_literal)
        self.spaced = _Pieces(self._encode_piece, lambda piece: piece)

    def forget(self) -> None:
        """Let go of all words met so far."""
        for store in (self.plain, self.spaced, self.words):
            store.clear()

    def _encode_piece(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.cut(text)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, number of ids of each text); a null is an empty text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for store in (self.plain, self.spaced):
            store.tidy()
        if len(self.words) > MEMO_PIECES:
            self.words.clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.added:
            held = np.zeros(len(texts), bool)
            for content in self.added:
                held |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
            if held.any():
                return self._with_added(texts, held)
        return self._encode_ordinary(texts)

    def _with_added(self, texts: pa.Array, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold an added token go through the library, each in one call; the others as ever."""
        more = [np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32) for i in np.flatnonzero(held)]
        rest, counts = self._encode_ordinary(texts.filter(pa.array(~held)))
        total = np.zeros(len(texts), np.int64)
        total[~held], total[held] = counts, [len(x) for x in more]
        out = np.empty(int(total.sum()), np.uint32)
        is_held = np.repeat(held, total)
        out[is_held], out[~is_held] = np.concatenate(more), rest
        return out, total

    def _encode_ordinary(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without nulls, added tokens' strings as ordinary text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        # a line end in front makes the first piece one like those after line ends; its id goes again below
        line_end, nothing = (pa.scalar(x, pa.large_string()) for x in ("\n", ""))
        framed = pc.binary_join_element_wise(line_end, pc.replace_substring(texts, "\n", " \n"), nothing)
        cuts = pc.split_pattern(framed, " ")
        sizes = np.diff(cuts.offsets.to_numpy())
        coded = cuts.values.dictionary_encode()
        rows = self.plain.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        self.plain.learn()
        of_text = np.repeat(np.arange(len(texts)), sizes)
        odd = np.zeros(len(texts), bool)
        odd[of_text[self.plain.odd[rows]]] = True
        ids, counts = self.plain.gather(rows[~odd[of_text]], np.where(odd, 0, sizes))
        heads = (np.cumsum(counts) - counts)[~odd]
        ids, counts = np.delete(ids, heads), counts - ~odd
        return self._with_spaced(texts, odd, ids, counts) if odd.any() else (ids, counts)

    def _with_spaced(self, texts, odd, ids, counts):
        """Add the texts with other white space: cut only at a blank before a visible character."""
        where = np.flatnonzero(odd)
        cuts = []
        for i in where:
            first, *rest = VISIBLE_AFTER_SPACE.split(texts[int(i)].as_py())
            cuts.append([first, *(" " + p for p in rest)])
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        rows = self.spaced.rows([p for pieces in cuts for p in pieces])
        self.spaced.learn()
        more, more_counts = self.spaced.gather(rows, sizes)
        total = counts.copy()
        total[where] = more_counts
        out = np.empty(int(total.sum()), np.uint32)
        is_odd = np.repeat(odd, total)
        out[is_odd], out[~is_odd] = more, ids
        return out, total


@lru_cache(maxsize=2)
def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path, added_tokens)


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
