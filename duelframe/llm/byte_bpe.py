"""Byte-level BPE: exact encoding by backtracking over longest matches, and decoding.

A text is cut by the tokenizer's pattern; each piece is encoded on its own.
Within a piece the encoder walks from left to right and always tries the
longest vocabulary entry first, which an Aho-Corasick automaton finds in the
bytes mapped to Latin-1 characters.  A token may follow its predecessor only
if the two are *compatible*: merging the bytes of both by rank gives exactly
these two tokens back.  A sequence whose neighbours are all compatible is the
sequence that the merges produce, so when an entry does not fit, the next
shorter one is tried, and after the last the walk steps back over a token.  A
position that was proved a dead end is never entered again, which bounds the
work by the piece length times the number of entries that start at one place.

Defined results: a null text is the empty text; an empty text has no tokens;
repeated rows are encoded alike; other columns pass through untouched, but for those of
the new columns' names, which are refused until these get other names.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import in_arrow

CACHED_PIECES = 100_000  # per generation of a Python worker's memo
CACHED_PIECE_CHARS = 64
#: A space between two characters that are no white space: a piece always starts at it.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
CROWDED_SPACE = re.compile(r"^ | $| \s|\s ")
CACHED_PAIRS = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class BytePairCoder:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cut_at_spaces: bool = False):
        self.ranks = ranks
        self.cut_at_spaces = cut_at_spaces
        self.split = regex.compile(pattern).findall
        self.longest_entry = max(map(len, ranks))
        self.length_of = {rank: len(token) for token, rank in ranks.items()}
        self.bytes_of = dict(zip(ranks.values(), ranks))
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.shorter_of: dict[int, int] = {}
        self.pairs: dict[tuple[int | None, int], bool] = {}
        self.pieces = _Memo(lambda piece: np.array(self.encode_piece(piece.encode("utf-8")), "<u4").tobytes())
        self.spaced = _Memo(lambda word: self.encode_pieces(" " + word))

    def merged(self, data: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """The merges by definition (the pair of least rank, leftmost first) and the last merge."""
        parts, last = [data[i:i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, len(self.ranks)), i)
                          for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            last = self.ranks[parts[i]], self.ranks[parts[i + 1]]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts], last

    def split_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte (memoised)."""
        if token not in self.halves:
            self.halves[token] = self.merged(self.bytes_of[token])[1]
        return self.halves[token]

    def compatible(self, left: int | None, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side (memoised).

        With None for ``left``: whether they make ``right`` from its bytes,
        without which it is compatible with nothing.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = (
                self.merged(self.bytes_of[right])[0] == [right] if left is None
                else self.compatible(None, right) and self._stay_apart(left, right))
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens, latest first, down to bytes.

        At each moment of that history the tokens touching the boundary must
        not form an entry that would have been merged before the next undone
        step: of lower rank, or of equal rank and further left.
        """
        before = len(self.ranks)
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < before:
                return False
            of_left, of_right = self.split_of(left), self.split_of(right)
            if of_left and (left > right or not of_right):
                before, left = left, of_left[1]
            elif of_right:
                before, right = right + 1, of_right[0]
            else:
                return True

    def longest(self, chars: str, at: int) -> int:
        return next(self.automaton.iter_long(chars[at:at + self.longest_entry]))[1]

    def shorter(self, token: int) -> int:
        """The longest entry that is a proper prefix of ``token``; -1 if none (memoised)."""
        known = self.shorter_of.get(token)
        if known is None:
            data = self.bytes_of[token]
            known = next((self.ranks[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.ranks), -1)
            self.shorter_of[token] = known
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        """Token ids of one piece."""
        if data in self.ranks:
            return [self.ranks[data]]
        chars, size = data.decode("latin-1"), len(data)
        known, compatible, length = self.pairs.get, self.compatible, self.length_of
        tokens, last = [], None
        for _, token in self.automaton.iter_long(chars):
            fits = known((last, token))
            if not (compatible(last, token) if fits is None else fits):
                break
            tokens.append(token)
            last = token
        else:
            return tokens  # the longest matches fit together at once
        at = sum(length[t] for t in tokens)
        dead = bytearray(size + 1)
        while at < size:
            last = tokens[-1] if tokens else None
            while token >= 0:
                if not dead[at + length[token]]:
                    fits = known((last, token))
                    if compatible(last, token) if fits is None else fits:
                        break
                token = self.shorter(token)
            if token >= 0:
                tokens.append(token)
                at += length[token]
                token = self.longest(chars, at) if at < size else -1
            elif tokens:  # nothing fits here: step back, never to return
                dead[at] = 1
                token = tokens.pop()
                at -= length[token]
            else:
                raise ValueError("the vocabulary cannot spell this piece")
        return tokens

    def encode_pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        """Token ids of a text, as little-endian unsigned 32-bit integers.

        With ``cut_at_spaces`` the caller states that every lone space begins a
        match of the pattern, so that the text can be cut there first and the
        memo works on whole words.
        """
        if not self.cut_at_spaces:
            return self.encode_pieces(text)
        first, *words = LONE_SPACE.split(text) if CROWDED_SPACE.search(text) else text.split(" ")
        return self.encode_pieces(first) + b"".join(map(self.spaced.__getitem__, words))

    def decode(self, packed: bytes) -> bytes:
        return decoded(packed, self.bytes_of)


def decoded(packed: bytes, bytes_of: dict[int, bytes]) -> bytes:
    return b"".join(map(bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


class _Memo(dict):
    """Bounded memo, string -> packed ids, in two generations.

    When the young one is full, it becomes the old one and the former old one
    is dropped; what is still in use moves back into the young one.
    """

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        packed = self.old.get(key)
        if packed is None:
            packed = self.make(key)
        if len(key) <= CACHED_PIECE_CHARS:
            if len(self) >= CACHED_PIECES:
                self.old = dict(self)
                self.clear()
            self[key] = packed
        return packed


_CODERS: dict[tuple[str, str, bool], BytePairCoder] = {}


def coder(path: str, pattern: str, cut_at_spaces: bool = False) -> BytePairCoder:
    """One coder per Python worker and vocabulary."""
    if (path, pattern, cut_at_spaces) not in _CODERS:
        _CODERS[path, pattern, cut_at_spaces] = BytePairCoder(load_ranks(path), pattern, cut_at_spaces)
    return _CODERS[path, pattern, cut_at_spaces]


def _refuse(columns: list[str], new: list[str]) -> None:
    if clash := {n.lower() for n in new} & {c.lower() for c in columns}:
        raise ValueError(f"the input already has {sorted(clash)}: pass other names")


def encode(df: DataFrame, vocab_path: str, pattern: str, text: str = "text",
           ids: str = "token_ids", decoded_as: str | None = None, cut_at_spaces: bool = False) -> DataFrame:
    """Replace column ``text`` by its packed token ids.

    With ``decoded_as`` that column gets what the ids decode to, in the same
    pass and Python process.  ``vocab_path`` is read on the executors, where
    the tokenizer's files are installed.  Rows are independent, so nothing is
    shuffled.  ``cut_at_spaces`` is faster, for patterns that begin a match at
    every lone space (``BytePairCoder.encode``).
    """
    new = [ids] if decoded_as is None else [ids, decoded_as]
    own = [f for f in df.schema.fields if f.name != text]
    _refuse([f.name for f in own], new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocab_path, pattern, cut_at_spaces)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            rest = [i for i in range(batch.num_columns) if i != at]
            packed = [bpe.encode(t.as_py() or "") for t in batch.column(at)]
            made = [packed] if decoded_as is None else [packed, [bpe.decode(p) for p in packed]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest] + [pa.array(m, pa.binary()) for m in made],
                [batch.schema.names[i] for i in rest] + new)

    return in_arrow(df, run, T.StructType(own + [T.StructField(n, T.BinaryType()) for n in new]))


@lru_cache(maxsize=4)
def _entries(path: str) -> dict[int, bytes]:
    """What each token stands for; decoding needs nothing else in memory."""
    return {rank: token for token, rank in load_ranks(path).items()}


def decode(df: DataFrame, vocab_path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Append the bytes that the packed ids in ``ids`` stand for."""
    _refuse(df.columns, [out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = _entries(vocab_path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            back = pa.array([decoded(p.as_py() or b"", bytes_of) for p in column], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, back], [*batch.schema.names, out])

    return in_arrow(df, run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))
