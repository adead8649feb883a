"""Byte-level BPE by dynamic programming over prefixes.

Two tokens may stand side by side if merging their joined bytes gives these two again.
A sequence in which all neighbours may do so is the encoding of its bytes: merges happen
in the order of ranks, and the first one across a border would also happen between the two
tokens alone.  So each prefix of a piece has one last token: the token that ends there and
may follow the last token of the prefix before it.  These last tokens are all the state:
appended bytes extend it, and after an edit it is computed anew only until as many last
tokens as the longest token has bytes agree with the old ones.

Texts are cut into pieces by a pattern; pieces that occur often are encoded once a worker.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from dataclasses import dataclass
from functools import partial
from itertools import islice
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.session import ship_package

MAX_VOCABULARY_BYTES = 64 << 20  # of a file of ranks, which goes to every worker
HELD_PIECES = 1 << 18  # pieces of up to HELD_CHARS characters whose ids a worker keeps
HELD_CHARS = 48
HELD_PAIRS = 1 << 20  # pairs of tokens whose verdict a worker keeps
BATCH_TEXTS = 200
LONG_TEXT = 1 << 20  # characters from which pieces are not listed all at once


class Vocabulary:
    """Ranks of byte strings, and the pattern that cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        lost = [b for b in range(256) if bytes([b]) not in ranks]
        if lost:
            raise ValueError(f"the vocabulary lacks single bytes: {lost[:5]}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, ranks))
        self.ending = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.ending.add_word(token.decode("latin-1"), (len(token), rank))
        self.ending.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.held: dict[str, bytes] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging: the adjacent pair of lowest rank first, the leftmost of equal ones."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank, none = self.ranks.get, 1 << 62
        order = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while order and (least := min(order)) < none:
            at = order.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del order[at]
            if at:
                order[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(order):
                order[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def may_follow(self, before: int, token: int) -> bool:
        """Whether ``token`` may stand behind ``before``; behind -1, at the start of a piece."""
        both = [self.bytes_of[t] for t in (before, token) if t >= 0]
        joined = b"".join(both)
        fits = (before < 0 or joined not in self.ranks) and self.merged(joined) == both
        if len(self.pairs) >= HELD_PAIRS:
            self.pairs.clear()
        self.pairs[before, token] = fits
        return fits

    def last_tokens(self, data: bytes, known: list[int] | None = None, old: list[int] | None = None, same_from: int = 0) -> list[int]:
        """The last token of each prefix of ``data``, of which the first ``known`` are given.

        ``old``: last tokens of other bytes that end like ``data`` from ``same_from`` on.
        """
        last = list(known or ())
        n = len(last)
        base, shift, run, verdict = max(0, n - self.longest + 1), len(old or ()) - len(data), 0, self.pairs.get
        for end, (length, token) in self.ending.iter(data[base:].decode("latin-1")):
            end += base
            if end < n:
                continue
            before = last[end - length] if end >= length else -1
            fits = verdict((before, token))
            if fits is None:
                fits = self.may_follow(before, token)
            if not fits:
                continue
            last.append(token)
            n += 1
            if old is not None and end >= same_from:
                run = run + 1 if old[end + shift] == token else 0
                if run == self.longest:
                    return last + old[end + shift + 1 :]
        if n != len(data):
            raise ValueError(f"no token ends at byte {n}")
        return last

    def tokens(self, data: bytes, last: list[int]) -> list[int]:
        """The encoding, read from the last tokens; bytes that are a token are that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        found, at = [], len(last)
        while at:
            found.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return found[::-1]

    def piece(self, text: str) -> bytes:
        """Ids of one piece, four bytes each, little-endian."""
        data = text.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self.tokens(data, self.last_tokens(data))
        packed = np.array(ids, "<u4").tobytes()
        if len(text) <= HELD_CHARS:
            if len(self.held) >= HELD_PIECES:
                self.held.clear()
            self.held[text] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text, four bytes each, little-endian."""
        held, piece, out = self.held.get, self.piece, []
        matches = None if len(text) < LONG_TEXT else self.pattern.finditer(text)
        while pieces := self.pattern.findall(text) if matches is None else [m[0] for m in islice(matches, 1 << 16)]:
            out.append(b"".join([held(p) or piece(p) for p in pieces]))
            if matches is None:
                break
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids; an id without a token is an error."""
        return b"".join([self.bytes_of[t] for t in np.frombuffer(packed, "<u4").tolist()])


@dataclass
class EncodedText:
    """A text with the state of its pieces: ends in characters, bytes, last tokens."""

    vocabulary: Vocabulary
    text: str
    ends: list[int]
    pieces: list[bytes]
    last: list[list[int]]

    @classmethod
    def of(cls, vocabulary: Vocabulary, text: str) -> EncodedText:
        whole = cls(vocabulary, "", [], [], [])
        whole.replace(0, 0, text)
        return whole

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in place of the characters ``start`` to ``end``; returns how many pieces were encoded.

        Pieces that end before the edit stay.  Later ones are cut anew until a border
        beyond the edit is an old one: from there on, the same pieces follow.
        """
        if not 0 <= start <= end <= len(self.text):
            raise ValueError("the edit is not within the text")
        text = self.text[:start] + new + self.text[end:]
        first, shift = bisect_left(self.ends, start), len(new) - (end - start)
        at = self.ends[first - 1] if first else 0
        old_starts = {e: k + 1 for k, e in enumerate(self.ends) if e >= end}
        ends, pieces, last, rest = [], [], [], len(self.ends)
        for match in self.vocabulary.pattern.finditer(text, at):
            if match.start() >= start + len(new) and match.start() - shift in old_starts:
                rest = old_starts[match.start() - shift]
                break
            data = match[0].encode("utf-8", "surrogatepass")
            k = first + len(ends)
            begin = self.ends[k - 1] if 0 < k <= len(self.ends) else 0
            near = k < len(self.ends) and begin == match.start()
            ends.append(match.end())
            pieces.append(data)
            last.append(self._respelt(self.pieces[k], self.last[k], data) if near else self.vocabulary.last_tokens(data))
        self.text = text
        self.ends[first:] = ends + [e + shift for e in self.ends[rest:]]
        self.pieces[first:] = pieces + self.pieces[rest:]
        self.last[first:] = last + self.last[rest:]
        return len(ends)

    def _respelt(self, old: bytes, last: list[int], new: bytes) -> list[int]:
        """Last tokens of ``new`` from those of ``old``, by their common beginning and end."""
        short = min(len(old), len(new))
        head = next((i for i in range(short) if old[i] != new[i]), short)
        tail = next((i for i in range(short - head) if old[-1 - i] != new[-1 - i]), short - head)
        return self.vocabulary.last_tokens(new, last[:head], last, len(new) - tail)

    def ids(self) -> list[int]:
        return [t for data, last in zip(self.pieces, self.last, strict=True) for t in self.vocabulary.tokens(data, last)]


def read_ranks(path: str) -> bytes:
    """A file of lines ``base64 rank``, as it is; its size is bounded, as every worker gets it."""
    data = Path(path).read_bytes()
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary has {len(data)} bytes, more than {MAX_VOCABULARY_BYTES}")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


_open: dict[tuple[int, str], Vocabulary] = {}  # the last one of this worker


def _vocabulary(shared, pattern: str) -> Vocabulary:
    ranks = shared.value
    key = (hash(ranks), pattern)
    if key not in _open:
        _open.clear()
        _open[key] = Vocabulary(parse_ranks(ranks), pattern)
    return _open[key]


def share(spark: SparkSession, path: str):
    """Hand the ranks to the workers; the file is read by the driver only."""
    ship_package(spark)
    return spark.sparkContext.broadcast(read_ranks(path))


def _encoded(shared, pattern: str, kept: list[str], batches):
    vocabulary = _vocabulary(shared, pattern)
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_TEXTS):
            part = batch.slice(at, BATCH_TEXTS)
            ids = [vocabulary.encode(t) if t else b"" for t in part.column(part.num_columns - 1).to_pylist()]
            columns = [part.column(i) for i in range(len(kept))]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.record_batch([*columns, counts, pa.array(ids, pa.binary())], names=[*kept, "n_tokens", "ids"])


def encode(docs: DataFrame, shared, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids`` of every row; ``ids`` are packed, four bytes each, little-endian.

    ``shared``: ranks from :func:`share`.  Each match of ``pattern`` is encoded by itself;
    characters that it does not match are left out; no special tokens.  Null counts as
    empty and has no ids; null ids and repeated rows are kept; other columns are not read.
    An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(partial(_encoded, shared, pattern, [id_col]), f"`{id_col}` {kind}, n_tokens bigint, ids binary")


def _decoded(shared, batches):
    bytes_of = {rank: token for token, rank in parse_ranks(shared.value).items()}
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_TEXTS):
            part = batch.slice(at, BATCH_TEXTS)
            texts = [b"".join([bytes_of[t] for t in np.frombuffer(x or b"", "<u4").tolist()]) for x in part.column("ids").to_pylist()]
            yield pa.record_batch([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])


def decode(encoded: DataFrame, shared) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``; null counts as empty, an unknown id is an error."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(partial(_decoded, shared), f"{columns}, decoded binary")

