"""Documents as token ids, cut to pieces and packed into sequences by the sum-of-squares rule.

A piece goes where the sum of the squared counts of open sequences per residual gap becomes smallest: a perfect fit takes
an open sequence away, and otherwise gaps are kept as varied as they can be, so that later pieces find one that suits.

Pieces are dealt into groups of a few thousand, each packed by one task from lengths alone: what a group wastes is about
one sequence.  A group is packed twice, as it comes with new sequences opened where the rule says so, and from the longest
piece down with a new sequence only where nothing fits; the packing with fewer sequences stays.  Ids never meet in a task
but those of one sequence.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from helioledger.llm.tables import land, read, ship

#: Tokens of a sequence, and the id after every document.
MOST, END = 4096, 1
#: Pieces packed by one task, about.
GROUP = 4096
#: Words remembered by a worker and merged at once; texts and ids held at once.
REMEMBERED, WORDS_AT_ONCE, AT_ONCE, IDS_AT_ONCE = 1 << 19, 1 << 14, 512, 1 << 20


def public_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


# How the public tokenizer cleans a text and parts it into words, as its file states it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

#: Letters beyond ASCII here are composed, have one lower-case form, and need no rule of their own.
LETTERS = "\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN_TEXT = re.compile(f"[\x20-\x7e\t-\r{LETTERS}]*")
PLAIN_CHUNK = re.compile(f"[\x21-\x7e{LETTERS}]+")
PLAIN_WORDS = re.compile(f"[a-z{LETTERS}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^ \t-\ra-z0-9{LETTERS}]+")


def _parts_words(settings: dict) -> bool:
    """Whether the tokenizer cleans and parts texts as this module does for plain ones."""
    normalizers = (settings["normalizer"] or {}).get("normalizers", [])
    splits = (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        [n["type"] for n in normalizers] == ["NFC", "Replace", "Lowercase"]
        and [p["type"] for p in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"] == {"Regex": PATTERN}
        and (splits[0]["behavior"], splits[0]["invert"]) == ("Removed", True)
        and not (splits[1]["add_prefix_space"] or splits[1]["use_regex"])
        and settings["model"]["end_of_word_suffix"] == WORD_END
    )


class TextEncoder:
    """Ids of whole texts, with the ids of words remembered.

    Plain texts, of ASCII and Latin letters, are parted into words here, and new words merged by the tokenizer's own model,
    many at a time.  In other texts each run without white space that isn't plain is left to the tokenizer.  A tokenizer of
    other rules encodes every text whole.
    """

    def __init__(self, vocabulary: str):
        self._whole = Tokenizer.from_file(vocabulary)
        self._whole.encode_special_tokens = True  # their strings are ordinary text
        self._parts = _parts_words(json.loads(self._whole.to_str()))
        self._model = Tokenizer.from_file(vocabulary)
        self._model.encode_special_tokens = True
        self._model.normalizer = None
        split = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self._model.pre_tokenizer = pre_tokenizers.Sequence(split)
        words = self._whole.get_vocab()
        self._ends = np.zeros(max(words.values(), default=0) + 1, bool)
        self._ends[[i for word, i in words.items() if word.endswith(WORD_END)]] = True
        self._forget()

    @staticmethod
    def _words(text: str) -> list[str]:
        """Words, and with a blank before them runs that the tokenizer has to part."""
        if PLAIN_TEXT.fullmatch(text):
            return PLAIN_WORDS.findall(text.lower())
        found = []
        for chunk in map(bytes.decode, text.encode().split()):
            if PLAIN_CHUNK.fullmatch(chunk):
                found += PLAIN_WORDS.findall(chunk.lower())
            else:
                found.append(" " + chunk)
        return found

    def _add(self, word: str, ids: list[int]) -> None:
        self._known[word] = len(self._starts) - 1
        self._flat.extend(ids)
        self._starts.append(len(self._flat))

    def _learn(self, words: list[str]) -> None:
        odd, plain = [w for w in words if w[0] == " "], [w for w in words if w[0] != " "]
        for word, found in zip(odd, self._whole.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            self._add(word, found.ids)
        for at in range(0, len(plain), WORDS_AT_ONCE):
            some = plain[at : at + WORDS_AT_ONCE]
            ids = np.array(self._model.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(some) or ends[-1] != len(ids):
                raise RuntimeError("the tokenizer doesn't end words as stated")
            self._known.update(zip(some, range(len(self._starts) - 1, len(self._starts) - 1 + len(some)), strict=True))
            self._starts.frombytes((ends + len(self._flat)).astype(np.int64).tobytes())
            self._flat.frombytes(ids.tobytes())

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        #: Ids of the known words one after the other, and where each word's begin.
        self._flat, self._starts = array("i"), array("q", [0])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not self._parts:
            return [np.array(e.ids, np.int32) for e in self._whole.encode_batch_fast(texts, add_special_tokens=False)]
        if not texts:
            return []
        parted = [self._words(t) for t in texts]
        counts = np.fromiter(map(len, parted), np.int64, len(parted))
        words = list(chain.from_iterable(parted))
        places = np.fromiter(map(self._known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(places < 0)
        missing = [words[i] for i in new.tolist()]
        self._learn(list(dict.fromkeys(missing)))
        places[new] = np.fromiter(map(self._known.__getitem__, missing), np.int64, len(missing))
        starts, flat = np.array(self._starts, np.int64), np.array(self._flat, np.int32)
        first, sizes = starts[places], np.diff(starts)[places]
        ends = np.concatenate([[0], sizes.cumsum()])
        found = flat[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])]
        if len(self._known) > REMEMBERED:
            self._forget()
        return np.split(found, ends[counts.cumsum()[:-1]])


_encoders: dict[str, TextEncoder] = {}


def encoder(vocabulary: str) -> TextEncoder:
    """One encoder for each worker and vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = TextEncoder(vocabulary)
    return _encoders[vocabulary]


def pieces(docs: DataFrame, vocabulary: str, most: int = MOST, end: int = END) -> DataFrame:
    """Written: ``_piece`` (a number of its own), doc_id, ``piece`` (from 0), ``start``, ``length`` and ``ids`` of every piece.

    Ids are packed, as little-endian unsigned 32-bit integers: ``numpy.frombuffer(ids, "<u4")``.

    A document is the ids of its whole text and ``end``; it is cut only if it has more than ``most``.  A null or empty text
    is ``end`` alone.  Repeated rows and null ids are documents each; an empty table gives none; other columns are not read.
    """
    if most < 1:
        raise ValueError("a sequence holds one token at least")
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids"]

    def flush(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        kinds = [columns.pop()[0], pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held, size = encoder(vocabulary), [], 0
        for batch in batches:
            type_ = batch.column(0).type
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encode.ids(texts), strict=True):
                    whole = np.append(ids, end).astype("<u4")
                    for n, start in enumerate(range(0, len(whole), most)):
                        part_ids = whole[start : start + most]
                        held.append((doc, n, start, len(part_ids), part_ids.tobytes(), type_))
                        size += len(part_ids)
                        if size >= IDS_AT_ONCE:
                            yield flush(held)
                            held, size = [], 0
        if held:
            yield flush(held)

    made = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")
    return land(made.withColumn("_piece", F.monotonically_increasing_id()), "pieces")


def place(lengths: np.ndarray, most: int, eager: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of every piece in the order given, and the number of sequences.

    Of open sequences that fit, one whose gap makes the sum of squares smallest is taken, the smaller gap of equals.  If
    ``eager``, a new one is opened where that makes the sum smaller; otherwise only where none fits.
    """
    counts = np.zeros(most + 1, np.int64)
    opened: list[list[int]] = [[] for _ in range(most + 1)]  # sequences by gap
    sequence, offset, number = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for at, size in enumerate(lengths.tolist()):
        change, gap = None, most
        if size < most:
            here = counts[size:most]
            # One fewer of a gap, one more of what remains of it; what is full is no longer open.
            changes = 2 * (counts[: most - size] - here) + 2
            changes[0] = 1 - 2 * here[0]
            fits = np.flatnonzero(here)
            if len(fits):
                best = fits[changes[fits].argmin()]
                change, gap = int(changes[best]), int(best) + size
        if change is None or eager and change > 2 * counts[most - size] + 1:
            taken, gap = number, most
            number += 1
        else:
            taken = opened[gap].pop()
            counts[gap] -= 1
        sequence[at], offset[at] = taken, most - gap
        if gap > size:
            opened[gap - size].append(taken)
            counts[gap - size] += 1
    return sequence, offset, number


def pack(pieces: DataFrame, most: int = MOST) -> DataFrame:
    """Written: ``_piece``, ``sequence_id`` and ``offset`` of every piece of a written table with ``_piece`` and ``length``.

    Lengths are from 1 to ``most``.  Pieces of ``most`` tokens are sequences by themselves.
    """
    ship(pieces.sparkSession)
    narrow = pieces.select("_piece", "length")
    short = narrow.filter(F.col("length") < most)
    groups = max(1, -(-short.count() // GROUP))

    def run(table: pa.Table) -> pa.Table:
        numbers, lengths = table.column("_piece").to_numpy(), table.column("length").to_numpy()
        # By number first, so that a task that runs again packs alike.
        came = np.argsort(numbers, kind="stable")
        found = [(order, *place(lengths[order], most, eager)) for order, eager in ((came, True), (came[np.argsort(-lengths[came], kind="stable")], False))]
        order, sequence, offset, _ = min(found, key=lambda f: f[3])
        group = table.column("_group")[0].as_py()
        return pa.table({"_piece": numbers[order], "sequence_id": (group << 32) + sequence, "offset": offset})

    dealt = short.withColumn("_group", F.pmod(F.xxhash64("_piece"), F.lit(groups)))
    placed = dealt.groupBy("_group").applyInArrow(run, "_piece long, sequence_id long, offset long")
    whole = narrow.filter(F.col("length") == most).select("_piece", (-1 - F.col("_piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return land(placed.unionByName(whole), "packed")


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """``sequence_id``, its ``ids`` and the ``parts`` it is made of: doc_id, piece, offset and length, in order."""
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    whole = pieces.join(packed, "_piece").groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    shown = F.transform("_parts", lambda p: F.struct(p.doc_id.alias("doc_id"), p.piece.alias("piece"), p.offset.alias("offset"), p.length.alias("length")))
    ids = F.reduce("_parts", F.lit(b""), lambda found, p: F.concat(found, p.ids))
    return whole.select("sequence_id", ids.alias("ids"), shown.alias("parts"))


def op11_sum_of_squares_packing(spark, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 4096 tokens."""
    made = pieces(read(spark, sf_dir, "documents", "doc_id", "text"), public_vocabulary())
    digests = made.select("_piece", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digests.join(pack(made), "_piece").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
