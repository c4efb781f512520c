"""Secret scans: patterns find candidates, and decoding confirms what a pattern alone can't.

Three base kinds are patterns with a least length: assignments, access ids and hex runs.  Two kinds are
confirmed by structure.  ``key`` is a base64 or hex run, with or without PEM lines around it, that decodes to a
DER sequence of nested lengths that fit exactly and begins as a key does, or to an OpenSSH key.  A base64 run may be
broken into lines, also with escaped line ends, and with what quotes or comments put around its lines.  ``jwt`` is three
base64url parts whose first is a JSON header that names its algorithm and whose second is a JSON object.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from helioledger.llm.tables import read, ship

Span = tuple[str, int, int]

#: Base kinds in their order; each has its pattern, the group whose length counts, and that length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),  # the same as longer runs picked from all runs
)
KINDS = ("assign", "access", "hex", "key", "jwt")
#: Candidates for decoding.  Lines of one base64 block may be broken; a run of hex digits is tried as hex, too.
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----BEGIN )[\s\S])*?)-----END \1-----")
#: A line end, also escaped, with what quotes, comments and string literals put around it.
_ESCAPED = r"(?:(?:\\+r)?\\+n|\\+r)"
_PREFIX = r"""(?:[\x20\t>#*;|]|//[\x20\t]|--[\x20\t])*["']?"""
_CLOSED = r"""["'][\x20\t]*+[+,]?"""
#: Blanks are read from their first one only, so that long runs of them take no more than one look each.
BREAK = re.compile(rf"""(?:{_ESCAPED}(?:{_CLOSED})?|{_CLOSED}|(?<![\x20\t]))[\x20\t]*+\\?(?:\r?\n|\r){_PREFIX}|{_ESCAPED}""")
#: Where a run begins: not within another, but also after an escaped line end.
_START = r"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\)(?![nr])|(?<=\\[nr]))"
RUN = re.compile(_START + r"[A-Za-z0-9+/_-]{44,}={0,2}")
HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:\x20.*")
#: Lines of base64, from 16 letters in the first, with the same put around each.
LINES = re.compile(
    rf"{_START}[A-Za-z0-9+/_-]{{16,}}(?:(?:{BREAK.pattern})[A-Za-z0-9+/_-]+)+={{0,2}}"
)
HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
SEQUENCE, INTEGER, BIT_STRING, OCTET_STRING, OBJECT_ID = 0x30, 0x02, 0x03, 0x04, 0x06


def unpack(run: str) -> bytes | None:
    """Bytes of a base64 run in either alphabet, with or without padding."""
    plain = run.rstrip("=").translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of DER elements that fill the bytes exactly; None if their lengths don't fit."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            wide = size & 0x7F
            if not 1 <= wide <= 4 or at + wide > len(data):
                return None
            size = int.from_bytes(data[at : at + wide], "big")
            at += wide
        if at + size > len(data):
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


def is_key(data: bytes | None) -> bool:
    """A DER key (private keys of any form, also encrypted, or public with its algorithm) or an OpenSSH key."""
    if not data or len(data) < 32:
        return False
    if data.startswith(b"openssh-key-v1\0"):
        return True
    if data[:4] == b"\0\0\0\x07" and data[4:8] == b"ssh-":  # length, name, and more fields with their lengths
        at = 0
        while at + 4 <= len(data):
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at == len(data)
    outer = elements(data) if data[0] == SEQUENCE else None
    if not outer or len(outer) != 1:
        return False
    inner = elements(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    tags = [tag for tag, _ in inner]
    if tags[0] == INTEGER and inner[0][1] in (b"\0", b"\1"):
        if len(tags) >= 9 and set(tags[1:9]) == {INTEGER}:  # all numbers of an RSA key
            return True
        if len(tags) == 6 and set(tags) == {INTEGER}:  # those of a DSA key
            return True
        if tags[1] == SEQUENCE and OCTET_STRING in tags[2:3]:  # algorithm and wrapped key
            return _names_algorithm(inner[1][1])
        return tags[1] == OCTET_STRING and len(inner[1][1]) >= 16  # an elliptic curve's number
    if tags == [SEQUENCE, OCTET_STRING]:  # algorithm and encrypted key
        return len(inner[1][1]) >= 16 and _names_algorithm(inner[0][1])
    return tags == [SEQUENCE, BIT_STRING] and _names_algorithm(inner[0][1])


def _names_algorithm(content: bytes) -> bool:
    parts = elements(content)
    return bool(parts) and parts[0][0] == OBJECT_ID


def is_signed_token(head: str, body: str, signature: str) -> bool:
    try:
        header, claims = json.loads(unpack(head) or b""), json.loads(unpack(body) or b"")
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or not isinstance(header.get("alg"), str):
        return False
    return bool(signature) or header["alg"].lower() == "none"


def base_spans(text: str) -> list[Span]:
    return [
        (kind, m.start(), m.end()) for kind, pattern, group, least in BASE for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least
    ]


def pem_body(text: str) -> tuple[str, bool]:
    """The base64 text between PEM lines without line ends, prefixes and headers, and whether headers say it is encrypted."""
    lines = [line.strip(" \t\"',\\") for line in BREAK.split(text)]
    for mark in ("+", "//", "--"):  # of changed or commented lines, where all have it
        if len(lines) > 2 and all(line.startswith(mark) for line in lines[1:-1]):
            lines = [line.removeprefix(mark) for line in lines]
    headers = [line for line in lines if HEADER.fullmatch(line)]
    last = max((i for i, line in enumerate(lines) if ":" in line), default=-1) + 1
    if headers and "" in lines[last:]:  # a header may go on in the next line; an empty one ends them
        last = lines.index("", last)
    return "".join("".join(lines[last if headers else 0 :]).split()), any("ENCRYPTED" in h for h in headers)


def is_pem_key(text: str) -> bool:
    body, encrypted = pem_body(text)
    data = unpack(body)
    if encrypted:  # no structure shows in an encrypted body; its headers, its alphabet and its whole blocks do
        return data is not None and len(data) >= 32 and len(data) % 8 == 0
    return is_key(data)


def line_keys(text: str) -> list[Span]:
    """Keys in base64 lines of one width with at most a shorter last one, which may begin after and end before other lines."""
    found = []
    for m in LINES.finditer(text):
        parts, at = [], m.start()
        for gap in BREAK.finditer(text, m.start(), m.end()):
            parts.append((at, gap.start()))
            at = gap.end()
        parts.append((at, m.end()))
        lines = [text[slice(*part)] for part in parts]
        same = [1] * len(lines)  # how many lines from here have one width, with a shorter last one
        for i in range(len(lines) - 2, -1, -1):
            width, after = len(lines[i]), len(lines[i + 1].rstrip("="))
            same[i] = 1 + (same[i + 1] if len(lines[i + 1]) == width else after < width)
        begin = 0
        while begin < len(parts):
            n = _key_lines(lines, begin, same[begin])
            if n:
                found.append(("key", parts[begin][0], parts[begin + n - 1][1]))
            begin += n or 1
    return found


def _key_lines(lines: list[str], begin: int, most: int) -> int:
    """How many of the lines make a key, 2 at least; 0 if none do.  A sequence says by its first bytes where it ends."""
    head = unpack("".join(lines[begin : begin + min(most, 32)])[:32]) or b""
    if most < 2 or len(head) < 2:
        return 0
    if head[0] == SEQUENCE:
        wide = head[1] & 0x7F if head[1] & 0x80 else 0
        if wide > 4 or head[2 + wide : 3 + wide] not in (b"\x02", b"\x30"):  # an integer or a sequence, if it is there at all
            return 0
        size = 2 + wide + (int.from_bytes(head[2 : 2 + wide], "big") if wide else head[1])
        sizes = [-(-(-(-size * 4 // 3)) // len(lines[begin]))]
    elif head.startswith((b"openssh-key-v1\0", b"\0\0\0\x07ssh-")):
        sizes = [most, most - 1]  # a shorter line after the last full one may be no part of it
    else:
        return 0
    return next((n for n in sizes if 2 <= n <= most and is_key(unpack("".join(lines[begin : begin + n])))), 0)


def confirmed_spans(text: str) -> list[Span]:
    """Spans that structure confirms; of spans of one kind that overlap the first stays, and of those that begin together the longest."""
    keys = [("key", *m.span()) for m in PEM.finditer(text) if is_pem_key(m[2])] + line_keys(text)
    for pattern, decode in ((HEX, bytes.fromhex), (RUN, unpack)):
        keys += [("key", *m.span()) for m in pattern.finditer(text) if is_key(decode(m[0]))]
    apart: list[Span] = []
    for span in sorted(keys, key=lambda s: (s[1], -s[2])):
        if not apart or span[1] >= apart[-1][2]:
            apart.append(span)
    return apart + [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(*m.groups())]


def spans(text: str | None) -> list[Span]:
    """All spans in code points, end exclusive, by start and then by kind."""
    text = text or ""
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(found: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans of every document.

    Null and empty texts have no spans, and the digest of an empty list.  Equal rows get equal results.
    Texts are scanned whole.  Only doc_id and text are read, so other columns can't clash.
    """
    ship(docs.sparkSession)
    base = [kind for kind, *_ in BASE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t) for t in batch.column(1).to_pylist()]
            own = [[s for s in one if s[0] in base] for one in found]
            counts = [pa.array([sum(s[0] == kind for s in one) for one in own], pa.int64()) for kind in base]
            digests = pa.array([hashlib.sha256(_joined(one).encode()).hexdigest() for one in own], pa.string())
            every = pa.array(map(_joined, found), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, every], ["doc_id", *[f"n_{k}" for k in base], "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


MASK = "[SECRET]"


def masked(text: str) -> str:
    """The text with every span, or run of spans that overlap, replaced."""
    out, end = [], 0
    merged: list[list[int]] = []
    for _, start, stop in spans(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([start, stop])
    for start, stop in merged:
        out += [text[end:start], MASK]
        end = stop
    return "".join([*out, text[end:]])


def mask_documents(docs: DataFrame) -> DataFrame:
    """All documents with their columns; secrets in ``text`` are masked and ``n_chars`` of those texts follows.

    No document is dropped; null texts stay null.
    """
    ship(docs.sparkSession)
    at, size = docs.columns.index("text"), docs.columns.index("n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [t and masked(t) for t in texts]
            sizes = [n if a == b else len(b) for a, b, n in zip(texts, new, batch.column(size).to_pylist(), strict=True)]
            columns = batch.columns
            columns[at] = pa.array(new, batch.schema.field(at).type)
            columns[size] = pa.array(sizes, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op9_structural_confirmation(spark, sf_dir: str) -> DataFrame:
    """Every whole document, with its spans."""
    return scan_documents(read(spark, sf_dir, "documents", "doc_id", "text"))
