"""Token ids of whole batches by public tokenizers.

A byte-level BPE encodes the pieces of a text one by one, and a batch has far
fewer distinct pieces than pieces. So a batch is cut into pieces with numpy, as
the tokenizer's own pattern cuts it, the distinct pieces are encoded by the
tokenizer, and their ids are laid out again. The character classes the pattern
refers to are asked of the tokenizer, character by character as they occur.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from martflow.llm.words import strings, text_buffers

# The pattern: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SUFFIXES = ("s", "t", "m", "d", "re", "ve", "ll")
LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
QUOTE, BLANK = ord("'"), ord(" ")
PIECES_AT_ONCE = 20_000
KNOWN_PIECES = 1_000_000


def is_inner(data: np.ndarray) -> np.ndarray:
    """Bytes that go on with a character."""
    return (data & 0xC0) == 0x80


def code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points and sizes of the characters beyond ASCII that begin at the bytes ``at``."""
    first = data[at]
    sizes = 2 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
    points = first.astype(np.uint32) & (np.uint32(0x7F) >> sizes.astype(np.uint32))
    for k in range(1, 4):
        more = np.flatnonzero(sizes > k)
        points[more] = (points[more] << 6) | (data[at[more] + k] & 0x3F)
    return points, sizes


class Pieces:
    """Cuts texts at the pattern's pieces; ``split`` gives the pieces of a string."""

    def __init__(self, split: Callable[[str], list[str]]):
        self.split = split
        self.classes = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self.classes[:128] = [self._class(point) for point in range(128)]

    def _class(self, point: int) -> int:
        char = chr(point)
        for probe, found in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(self.split(f"{probe}{char}{probe}")) == 1:
                return found
        return SPACE

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """The class of the character each byte belongs to."""
        kinds = self.classes[:256][data]
        at = np.flatnonzero(data >= 0xC0)
        points, sizes = code_points(data, at)
        found = self.classes[points]
        for point in np.unique(points[found == UNKNOWN]):
            self.classes[point] = self._class(int(point))
        found = self.classes[points]
        for k in range(4):
            more = sizes > k
            kinds[at[more] + k] = found[more]
        return kinds

    def starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The byte each piece begins at."""
        n = len(data)
        kinds = self._kinds(data)
        opens = np.zeros(n + 1, dtype=bool)  # where a text begins, and the end
        opens[bounds] = True
        begins = opens.copy()
        changes = kinds[1:] != kinds[:-1]
        begins[1:n] |= changes
        # White space before a word: its last character stands alone, or leads the word if it is a blank.
        led = 1 + np.flatnonzero(changes & (kinds[:-1] == SPACE))
        led = led[~opens[led]]
        last = led - 1
        while (inner := is_inner(data[last])).any():
            last = last - inner
        begins[last] = True
        begins[led[data[last] == BLANK]] = False
        self._cut_suffixes(data, kinds, opens, begins)
        return np.flatnonzero(begins[:n])

    @staticmethod
    def _cut_suffixes(data: np.ndarray, kinds: np.ndarray, opens: np.ndarray, begins: np.ndarray) -> None:
        n = len(data)
        quotes = np.flatnonzero(data == QUOTE)
        quotes = quotes[begins[quotes] & (quotes + 1 < n)]
        quotes = quotes[(kinds[quotes + 1] == LETTER) & ~opens[quotes + 1]]
        for suffix in SUFFIXES:
            fits = quotes[quotes + len(suffix) < n]
            for k, char in enumerate(suffix, 1):
                fits = fits[(data[fits + k] == ord(char)) & ~opens[fits + k]]
            begins[fits + 1] = False
            begins[fits + 1 + len(suffix)] = True


class Encoder:
    """Ids of texts. ``encode`` gives the ids of a list of pieces.

    Remembers up to ``KNOWN_PIECES`` pieces from batch to batch.
    """

    def __init__(self, pieces: Pieces, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.pieces, self.encode = pieces, encode
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], type=pa.large_binary())
        self.flat = np.zeros(0, dtype=np.uint32)
        self.lengths = np.zeros(0, dtype=np.int64)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another as uint32, and each text's first and the end. Null is empty."""
        numbers, bounds = self._numbers(texts)
        sizes = self.lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.cumsum(self.lengths) - self.lengths
        places = np.arange(ends[-1]) + np.repeat(starts[numbers] - ends[:-1], sizes)
        return self.flat[places], ends[bounds]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        numbers, bounds = self._numbers(texts)
        ends = np.concatenate([[0], np.cumsum(self.lengths[numbers])])
        return np.diff(ends[bounds])

    def _numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The place of each piece of the texts among the known, and each text's first piece and the end."""
        data, bounds = text_buffers(texts)
        starts = self.pieces.starts(data, bounds)
        encoded = strings(data, np.diff(starts, append=len(data))).dictionary_encode()
        distinct = encoded.dictionary
        if len(self.known) + len(distinct) > KNOWN_PIECES:
            self._forget()
        at = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(at.is_null())
        if len(new):
            flat, lengths = self.encode(new.to_pylist())
            at = at.to_numpy(zero_copy_only=False)
            missing = np.isnan(at)
            at[missing] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.flat = np.concatenate([self.flat, flat])
            self.lengths = np.concatenate([self.lengths, lengths])
        else:
            at = at.to_numpy(zero_copy_only=False)
        numbers = at.astype(np.int64)[encoded.indices.to_numpy(zero_copy_only=False)]
        return numbers, np.searchsorted(starts, bounds)


def _one_by_one(encode: Callable[[str], list[int]]) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    def run(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [encode(p.decode()) for p in pieces]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum())), lengths

    return run


def _in_lines(encode: Callable[[str], list[int]]) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """Encodes many pieces as the lines of one string: a line break is a piece, and an id, of its own."""
    (line_break,) = encode("\n")
    alone = _one_by_one(encode)

    def run(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, lengths = [], []
        for k in range(0, len(pieces), PIECES_AT_ONCE):
            part = pieces[k : k + PIECES_AT_ONCE]
            # Pieces of white space alone would run into the breaks.
            plain = np.array([p.strip() == p or p[:1] == b" " and p[1:].strip() == p[1:] != b"" for p in part])
            plain &= np.array([p.decode().strip() != "" for p in part])
            lines = [p for p, ok in zip(part, plain, strict=True) if ok]
            ids = np.array(encode(b"\n".join([*lines, b""]).decode()), dtype=np.uint32)
            stops = np.flatnonzero(ids == line_break)
            if len(stops) != len(lines):
                ids, sizes = alone(part)
                flat.append(ids)
                lengths.append(sizes)
                continue
            sizes = np.zeros(len(part), dtype=np.int64)
            sizes[plain] = np.diff(stops, prepend=-1) - 1
            odd_ids, odd_sizes = alone([p for p, ok in zip(part, plain, strict=True) if not ok])
            sizes[~plain] = odd_sizes
            out = np.zeros(int(sizes.sum()), dtype=np.uint32)
            of_odd = np.repeat(~plain, sizes)
            out[of_odd] = odd_ids
            out[~of_odd] = ids[ids != line_break]
            flat.append(out)
            lengths.append(sizes)
        return np.concatenate(flat), np.concatenate(lengths)

    return run


@lru_cache(maxsize=4)
def json_encoder(vocabulary: bytes) -> Encoder:
    """From the file of a byte-level BPE for ``tokenizers``. The names of special tokens are ordinary text."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(vocabulary)
    tokenizer.encode_special_tokens = True
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    return Encoder(
        Pieces(lambda text: [piece for piece, _ in split(text)]),
        _in_lines(lambda text: tokenizer.encode(text, add_special_tokens=False).ids),
    )


@lru_cache(maxsize=4)
def ranks_encoder(vocabulary: bytes, pattern: str) -> Encoder:
    """From a file of base64 tokens and ranks for ``tiktoken`` with the pattern above."""
    import regex
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Encoder(Pieces(regex.compile(pattern).findall), _in_lines(encoding.encode_ordinary))
