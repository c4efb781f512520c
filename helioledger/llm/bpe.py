"""Byte-level BPE in linear time, and back.

Bytes are mapped to Latin-1 characters, so that one pass of an Aho-Corasick automaton finds every vocabulary
token at every place of a piece.  The encoder takes the longest token that starts at the current place and may
stand beside the token before it; where none may, the place is closed for good and the token before it is
replaced by the next shorter one.  Two tokens may stand side by side if the merges of their joint bytes would
not cross the border; that is remembered per pair.  A place is closed once at most, which keeps the search linear.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.llm.tables import read, ship

#: Entries kept per worker, of pieces with their ids and of pairs with their verdicts; beyond, a table becomes the old
#: one, whose entries come back when they are asked for.
REMEMBERED = 300_000
#: Longer pieces are encoded each time.
REMEMBERED_BYTES = 64
NEVER = 1 << 40


def ranks_of(lines: bytes) -> dict[bytes, int]:
    """Token bytes and ranks from a file of base64 tokens, each with its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line.strip())}


class Remembered(dict):
    """A bounded table that fills itself."""

    def __init__(self, make, keep=lambda key: True):
        self.make, self.keep, self.old = make, keep, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if self.keep(key):
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


#: The code points that Unicode 16 added as letters or numbers, first and last of each range.
UNICODE_16 = """
1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d40-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b-1138b 1138e-1138e
11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 116d0-116e3 11bc0-11be0 11bf0-11bf9 13460-143fa 16100-1611d
16130-16139 16d40-16d6c 16d70-16d79 18cff-18cff 1ccf0-1ccf9 1e5d0-1e5ed 1e5f0-1e5fa
"""


def later_letters() -> str:
    """Letters and numbers that the pattern library knows but Unicode 16, by which texts are split, doesn't; as ranges."""
    known = {c for span in UNICODE_16.split() for c in range(int(span.split("-")[0], 16), int(span.split("-")[1], 16) + 1)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ranges: list[list[int]] = []
    for c in map(ord, "".join(regex.findall(r"[\p{L}\p{N}]+", every))):
        if unicodedata.category(chr(c)) == "Cn" and c not in known:
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"{chr(first)}-{chr(last)}" for first, last in ranges)


class Splitter:
    """All matches of a pattern in a text, in order."""

    def __init__(self, pattern: str):
        later = later_letters()
        self.plain = regex.compile(pattern).findall
        self.later = re.compile(f"[{later}]").search if later else lambda text: None
        without = pattern.replace(r"\p{L}", rf"[\p{{L}}--[{later}]]").replace(r"\p{N}", rf"[\p{{N}}--[{later}]]")
        self.without = regex.compile(f"(?V1){without}").findall if later else self.plain
        # The same for texts in ASCII, by the faster standard library.
        ascii_only = pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(r"\s", " \t\n\r\v\f")
        for inside in ("A-Za-z", "0-9", " \t\n\r\v\f"):
            ascii_only = re.sub(rf"(\[[^\]]*\])|{re.escape(inside)}", lambda m: m[1] or f"[{inside}]", ascii_only)  # noqa: B023
        ascii_only = ascii_only.replace(r"\S", "[^ \t\n\r\v\f]")
        self.ascii = self.plain if r"\p" in ascii_only else re.compile(ascii_only).findall

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.later(text):
                return self.without(text)
        return self.plain(text)


class Codec:
    """Encodes and decodes whole texts by one vocabulary, which must hold all 256 single bytes."""

    def __init__(self, lines: bytes, pattern: str):
        self.ranks = ranks_of(lines)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.length = {rank: len(token) for rank, token in self.bytes_of.items()}
        self.pieces = Splitter(pattern)
        halves = {rank: self._halves(token) for rank, token in self.bytes_of.items()}
        self.automaton = ahocorasick.Automaton()
        for rank, half in halves.items():
            if half is not None:
                self.automaton.add_word(self.bytes_of[rank].decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.right_edge = {rank: self._edge(rank, halves, 1) for rank in halves}
        self.left_edge = {rank: self._edge(rank, halves, 0) for rank in halves}
        self.fits = Remembered(self._fits)
        self.ids_of = Remembered(self._ids, lambda piece: len(piece) <= REMEMBERED_BYTES)

    def _halves(self, token: bytes) -> tuple[int, ...] | None:
        """The two tokens that the last merge of a token's bytes joins; none if merges don't lead to this token."""
        parts, last = [token[i : i + 1] for i in range(len(token))], ()
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                return None
            last = (self.ranks[parts[at]], self.ranks[parts[at + 1]])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return last

    @staticmethod
    def _edge(rank: int, halves: dict, side: int) -> tuple[int, ...]:
        """What stands at one end of a token while it is merged, from its outermost byte to the token itself."""
        edge = [rank]
        while halves[edge[-1]]:
            edge.append(halves[edge[-1]][side])
        return tuple(reversed(edge))

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Replay the merges at both sides of the border in order of rank: does one across it come first?"""
        left, right = self.right_edge[pair[0]], self.left_edge[pair[1]]
        i = j = 0
        while True:
            across = self.ranks.get(self.bytes_of[left[i]] + self.bytes_of[right[j]], NEVER)
            next_left = left[i + 1] if i + 1 < len(left) else NEVER
            next_right = right[j + 1] if j + 1 < len(right) else NEVER
            if across < next_left and across <= next_right:  # of equal merges the leftmost comes first
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece; a piece that is a token is that token."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        length, fits, size = self.length, self.fits, len(piece)
        text = piece.decode("latin-1")
        longest = [rank for _, rank in self.automaton.iter_long(text)]
        if all(map(fits.__getitem__, zip(longest, longest[1:], strict=False))) and sum(map(length.__getitem__, longest)) == size:
            return longest
        starting: list[list[int]] = [[] for _ in piece]  # from short to long
        for end, rank in self.automaton.iter(text):
            starting[end + 1 - length[rank]].append(rank)
        ids: list[int] = []
        choices: list[int] = []
        closed = bytearray(size + 1)
        at, choice = 0, len(starting[0]) if piece else 0
        while at < size:
            here, before = starting[at], ids[-1] if ids else None
            while choice:
                choice -= 1
                rank = here[choice]
                end = at + length[rank]
                if not closed[end] and (before is None or fits[before, rank]):
                    ids.append(rank)
                    choices.append(choice)
                    at, choice = end, len(starting[end]) if end < size else 0
                    break
            else:
                closed[at] = 1
                at, choice = at - length[ids.pop()], choices.pop()
        return ids

    def _ids(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece.encode()), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.ids_of.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(lines: bytes, pattern: str) -> Codec:
    """Built once per worker."""
    key = (hashlib.sha256(lines).hexdigest(), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(lines, pattern)
    return _codecs[key]


def vocabulary(path: str) -> bytes:
    """The rank file, read on the driver and sent to the tasks: its size is that of the vocabulary, whatever the input."""
    with open(path, "rb") as file:
        return file.read()


def encode_texts(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (binary).

    Null texts are empty; empty texts have no ids.  Repeated rows and keys are encoded each on their own, null keys
    stay null.  Texts are never cut, however long.  Columns other than key and text are not read.
    """
    ship(docs.sparkSession)
    lines = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(lines.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # small steps: a batch of long texts needn't be held thrice
                part = batch.slice(at, 64)
                ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(map(own.decode, ids), pa.binary())], [key, "n_tokens", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids binary, decoded binary")


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """The ids and the decoded bytes as SHA-256."""
    return encoded.select(key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def public_vocabulary() -> tuple[str, str]:
    """Path and pattern of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op10_byte_level_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded."""
    path, pattern = public_vocabulary()
    return digests(encode_texts(read(spark, sf_dir, "documents", "doc_id", "text"), path, pattern))
