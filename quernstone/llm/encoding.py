"""Token ids of whole texts by a public byte-level tokenizer (problem 7).

Method: a streaming transducer with bounded lookahead, in two stages.

``Encoder`` reads a text in blocks and cuts it into the pieces of the tokenizer's pattern.  A
piece is settled as soon as a character follows it (two after an apostrophe), so only the last
one of a block waits; a piece that grows beyond ``LONG`` isn't kept but handed on byte by byte.

``PieceTransducer`` reads the bytes of one piece.  For each position it keeps the last token of
the encoding of the bytes up to there; which one that is follows from the merge list alone, as
neighbours in an encoding must be what the merges make of their bytes side by side.  A later
token can only begin where the bytes read since are the beginning of some token.  What the
encodings up to all such places share can't change any more and is emitted.  ``Vocabulary.lookahead``,
worked out from the merge list, bounds how many bytes after a token can decide about it, so
the memory needed doesn't depend on the length of the text.

Ids of short pieces are remembered (``REMEMBERED`` of them), as words recur.  ``Decoder`` is the
inverse: a byte-to-text state machine that holds back an unfinished character.

Defined results: null and empty texts have no ids (an empty list); white space is encoded as
any other text; special tokens are never produced, their spelling is ordinary text.
"""

from __future__ import annotations

import base64
import codecs
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of one block; characters beyond which an open piece is streamed; pieces whose ids are remembered, and their length.
BLOCK, LONG, REMEMBERED, SHORT = 1 << 16, 1024, 200_000, 64


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a public vocabulary file: the installed package of tokenizers, else /opt/tokenizers."""
    spec = importlib.util.find_spec("public_tokenizers")
    folder = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(folder, name)


# Fixed value: the published splitting pattern of this family of byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: How a run of characters goes on, by the kind of its last one.
_RUNS = tuple(regex.compile(run) for run in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+"))
_SPACES = _RUNS[2]


class Vocabulary:
    """The merge list with what the transducer needs of it."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.longest = max(map(len, self.ranks))
        self.ends: dict[bytes, int] = {}  # every end of a token -> its rank, or -1 if only longer tokens end so
        goes_on: dict[bytes, int] = {}  # every beginning of a token -> how many bytes the longest such token has after it
        for token in self.ranks:
            for k in range(1, len(token)):
                self.ends.setdefault(token[k:], -1)
                begin = token[:k]
                if goes_on.get(begin, 0) < len(token) - k:
                    goes_on[begin] = len(token) - k
        self.ends.update(self.ranks)
        self.begins = frozenset(goes_on)
        # a token is decided once no token that begins inside it can reach beyond what was read
        self.lookahead = max((goes_on[end] for end in self.ends if end in goes_on), default=0)
        self._fits: dict[tuple[int, int], bool] = {}
        self._ids: dict[str, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The merges applied to a few bytes, the lowest rank first, of equal ones the leftmost."""
        ranks = self.ranks
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[part] for part in parts]

    def fits(self, first: int, second: int) -> bool:
        """Whether the two tokens side by side are what the merge list makes of their bytes; ``first`` is -1 at the beginning of a piece."""
        known = self._fits.get((first, second))
        if known is None:
            if len(self._fits) > 1_000_000:
                self._fits.clear()
            pair = [second] if first < 0 else [first, second]
            known = self._fits[first, second] = self.merged(b"".join(self.tokens[t] for t in pair)) == pair
        return known

    def ids(self, piece: str) -> tuple[int, ...]:
        """Ids of a whole piece."""
        known = self._ids.get(piece)
        if known is None:
            data = piece.encode()
            stream = PieceTransducer(self)
            known = tuple(stream.feed(data) + stream.finish())
            if len(piece) <= SHORT:
                if len(self._ids) >= REMEMBERED:
                    self._ids.clear()
                self._ids[piece] = known
        return known


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PieceTransducer:
    """Ids of one piece fed byte by byte; ``feed`` returns those that no later byte can change."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.tail = b""  # the last bytes, as many as the longest token has
        self.at = self.done = 0  # bytes read and bytes emitted
        self.last: dict[int, tuple[int, int]] = {0: (-1, 0)}  # position -> (last token of the encoding up to it, where it begins)

    def feed(self, data: bytes) -> list[int]:
        words, last, out = self.words, self.last, []
        ends, fits = words.ends, words.fits
        seen, shift = self.tail + data, self.at - len(self.tail)
        for at in range(self.at + 1, self.at + len(data) + 1):
            end = at - shift
            begin = end - 1
            while begin >= 0:
                token = ends.get(seen[begin:end])
                if token is None:
                    break
                if token >= 0:
                    before = last.get(begin + shift)
                    if before is not None and fits(before[0], token):
                        last[at] = (token, begin + shift)
                        break
                begin -= 1
            if at - self.done >= 4 * words.longest and at % words.longest == 0:
                out += self._settled(seen[:end], at)
                last = self.last
        self.at += len(data)
        self.tail = seen[-words.longest :]
        return out

    def _chain(self, position: int) -> list[int]:
        """The tokens from what was emitted up to ``position``."""
        tokens = []
        while position > self.done:
            token, position = self.last[position]
            tokens.append(token)
        return tokens[::-1]

    def _settled(self, seen: bytes, at: int) -> list[int]:
        """Emit what the encodings up to every place where a later token can begin share."""
        begins = self.words.begins
        open_ends = {at}
        for size in range(1, min(self.words.longest, len(seen), at - self.done) + 1):
            if seen[-size:] in begins:
                open_ends.add(at - size)
        while len(open_ends) > 1:  # the last place that all of them pass
            most = max(open_ends)
            open_ends.remove(most)
            open_ends.add(self.last[most][1])
        (shared,) = open_ends
        out = self._chain(shared)
        self.done = shared
        # later tokens begin within the longest token's reach, or where all encodings pass
        floor = min(shared, at - self.words.longest)
        self.last = {p: x for p, x in self.last.items() if p >= floor and (p >= shared or p > at - self.words.longest)}
        return out

    def finish(self) -> list[int]:
        return self._chain(self.at)


class Encoder:
    """Ids of a text fed in blocks."""

    def __init__(self, words: Vocabulary):
        self.words, self.rest = words, ""
        self.open: PieceTransducer | None = None  # a piece too long to be kept
        self.run = _SPACES  # how it goes on

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        if self.open is not None:
            text = self._go_on(text, out)
            if self.open is not None:
                return out
        pieces = self.words.split(self.rest + text)
        held = pieces[-1:]
        del pieces[-1:]
        while pieces and pieces[-1][0] == "'" and len(pieces[-1]) + sum(map(len, held)) < 3:
            held.insert(0, pieces.pop())
        self._known(pieces, out)
        self.rest = "".join(held)
        if len(self.rest) > LONG:
            self.run = next(run for run in _RUNS if run.match(self.rest[-1]))
            ready, self.rest = (self.rest[:-1], self.rest[-1:]) if self.run is _SPACES else (self.rest, "")
            self.open = PieceTransducer(self.words)
            out += self.open.feed(ready.encode())
        return out

    def finish(self) -> list[int]:
        out: list[int] = []
        if self.open is not None:
            out += self.open.feed(self.rest.encode()) + self.open.finish()
        else:
            self._known(self.words.split(self.rest), out)
        self.rest, self.open = "", None
        return out

    def _known(self, pieces: list[str], out: list[int]) -> None:
        remembered, ids = self.words._ids.get, self.words.ids
        for piece in pieces:
            out.extend(remembered(piece) or ids(piece))

    def _go_on(self, text: str, out: list[int]) -> str:
        """Feed the open piece; returns the text after it, with the last of its white space if that begins the next piece."""
        found = self.run.match(text)
        size = found.end() if found else 0
        if self.run is _SPACES:
            ready = self.rest + text[:size]
            if size:
                out += self.open.feed(ready[:-1].encode())
                self.rest = ready[-1:]
        elif size:
            out += self.open.feed(text[:size].encode())
        if size < len(text):
            out += self.open.finish()
            self.open = None
        return text[size:]


class Decoder:
    """Text of ids fed in parts; bytes of an unfinished character wait for the next part."""

    def __init__(self, words: Vocabulary):
        self.words, self.state = words, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(self.words.tokens[k] for k in ids))

    def finish(self) -> str:
        return self.state.decode(b"", True)


def stream(text: str | None, words: Vocabulary) -> Iterator[list[int]]:
    """The ids of a text, as they are settled."""
    if text:
        encoder = Encoder(words)
        for k in range(0, len(text), BLOCK):
            yield encoder.feed(text[k : k + BLOCK])
        yield encoder.finish()


def encode(text: str | None, words: Vocabulary) -> list[int]:
    out: list[int] = []
    for ids in stream(text, words):
        out += ids
    return out


def n_tokens(text: str | None, words: Vocabulary) -> int:
    """How many ids a text has, none of which are kept."""
    return sum(map(len, stream(text, words)))


def with_ids(df: DataFrame, column: str = "text", into: str = "ids", path: str | None = None, count_only: bool = False) -> DataFrame:
    """``df`` with the token ids of ``column`` in ``into`` (or their number, with ``count_only``) in place of ``column``."""
    path = path or vocabulary_path()
    kept = [f for f in df.schema.fields if f.name not in (column, into)]
    schema = T.StructType(kept + [T.StructField(into, T.IntegerType() if count_only else T.ArrayType(T.IntegerType()))])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        work, kind = (n_tokens, pa.int32()) if count_only else (encode, pa.list_(pa.int32()))
        for batch in batches:
            made = pa.array([work(text, words) for text in batch.column(column).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], names=[*names, into])

    return df.select(*(F.col(n) for n in names), column).mapInArrow(run, schema)
