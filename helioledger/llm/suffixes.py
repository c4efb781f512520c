"""Removal of word sequences that repeat, by suffix trees over groups of suffixes.

A window is ``WINDOW`` words of a document.  A window that starts anywhere else, too, is a node at that depth of the
suffix tree of all documents with two leaves or more; a tree of that depth is all that is needed.  The tree is cut
into subtrees that fit memory:

* The suffixes of a document go in runs.  A run shares its anchor, the gram of ``GRAM`` words with the least hash among
  those of a window, so equal windows have equal anchors at equal places.  A run is sent once, with its words.
* A suffix whose anchor is found once in all documents has no equal and isn't sent at all.
* Runs meet by anchor.  There, prefixes are lengthened step by step: a suffix that is alone with its prefix goes, and
  what is still together at the depth of a window is a deep node, and all its leaves repeat.
* Of texts that are equal word for word one goes into the tree; all of them repeat whole.
* Runs that are equal word for word repeat as a whole, and only one of them goes on into the tree.
* An anchor found more than ``GROUP`` times is too large for one subtree.  Its equal runs are counted by a digest of
  128 bits where they are found, before they meet; the suffixes of what differs are then dealt by the longest prefix,
  the whole window, in the same way.

Texts are dealt by row once and kept in buckets, so that neither the second nor the third pass moves them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.llm.tables import land, read, ship

WINDOW, GRAM, GROUP = 35, 8, 1000
#: Stands for all windows of a text.
EVERY = (1 << 31) - 1
#: Lengths of prefix at which suffixes that are alone go; a window's length follows.
STEPS = (4, 9, 18)
#: Rows of a few thousand words that a task holds at a time.
AT_ONCE = 256


def gram_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, the same on every machine."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(0, len(words) - size + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def runs(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window of each run, place of its anchor, and the anchor's hash; none in texts below one window."""
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = min(GRAM, window)
    hashes = gram_hashes(words, gram)
    among = window - gram + 1
    places = np.lib.stride_tricks.sliding_window_view(hashes, among).argmin(axis=1) + np.arange(len(hashes) - among + 1)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    return first, places[first], hashes[places[first]]


def _texts(docs: DataFrame) -> DataFrame:
    """``_row``, doc_id, a digest of the words and the packed text, in buckets by row in the warehouse."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            digests = [_halves(b" ".join(t.split())) for t in texts]
            columns = [pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)]
            packed = pa.array(map(packer.compress, texts), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, packed], ["_row", "doc_id", "high", "low", "packed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    packed = rows.mapInArrow(run, f"_row long, doc_id {kind}, high long, low long, packed binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_texts_{uuid.uuid4().hex}"
    packed.repartition(buckets, "_row").write.bucketBy(buckets, "_row").format("parquet").saveAsTable(name)
    return spark.table(name)


def _words(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split()


def _anchors(texts: DataFrame, window: int) -> DataFrame:
    """``_row``, ``run`` (its number in the text) and ``anchor``, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                found = [runs(_words(p), window)[2] for p in part.column(1).to_pylist()]
                sizes = [len(f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(part.column(0).to_pylist(), np.int64), sizes)),
                        pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])),
                        pa.array(np.concatenate(found).view(np.int64)),
                    ],
                    ["_row", "run", "anchor"],
                )

    return land(texts.select("_row", "packed").mapInArrow(run, "_row long, run int, anchor long"), "anchors")


def _batch(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


def _halves(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _sent(window: int):
    """Of each text the runs whose anchor repeats: first window, number of windows, words before the anchor, all words."""
    long, short = pa.int64(), pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                out: list[tuple] = []
                for row, packed, chosen in zip(*[c.to_pylist() for c in batch.slice(at, AT_ONCE).columns], strict=True):
                    words = _words(packed)
                    first, place, hashes = runs(words, window)
                    ends = np.append(first[1:], len(words) - window + 1)
                    anchors = hashes.view(np.int64)
                    for one in chosen:
                        i = one["run"]
                        start, end, left = int(first[i]), int(ends[i]), int(place[i] - first[i])
                        text = b" ".join(words[start : end + window - 1])
                        halves = _halves(b"%d " % left + text) if one["large"] else (None, None)
                        out.append((int(anchors[i]), *halves, row, start, end - start, left, text))
                yield _batch(out, anchor=long, high=long, low=long, _row=long, start=short, windows=short, left=short, words=pa.binary())

    return run


def _windows(window: int):
    """Every window of a run as a digest, with the run's own digest."""
    long = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                out = []
                for high, low, alone, text in zip(*[c.to_pylist() for c in batch.slice(at, AT_ONCE).columns], strict=True):
                    words = text.split(b" ")
                    out += [(*_halves(b" ".join(words[j : j + window])), high, low, alone, j) for j in range(len(words) - window + 1)]
                yield _batch(out, key=long, more=long, high=long, low=long, alone=pa.bool_(), shift=pa.int32())

    return run


def deep_leaves(group: list[tuple[int, int, int, list[bytes]]], window: int) -> list[tuple[int, int]]:
    """(row, start) of every suffix that shares a node at the depth of a window; group: row, start, left, words of each run.

    Suffixes are sorted apart by ever longer prefixes; a suffix alone with its prefix can't repeat.  The distance of
    suffix and anchor comes first, as equal windows have it in common.
    """
    nodes, before = [[(i, j) for i, (*_, words) in enumerate(group) for j in range(len(words) - window + 1)]], 0
    for depth in (*[s for s in STEPS if s < window], window):
        deeper = []
        for node in nodes:
            children: dict[tuple, list[tuple[int, int]]] = {}
            for i, j in node:
                _, _, left, words = group[i]
                children.setdefault((left - j, *words[j + before : j + depth]), []).append((i, j))
            deeper += [child for child in children.values() if len(child) > 1]
        nodes, before = deeper, depth
    return [(group[i][0], group[i][1] + j) for node in nodes for i, j in node]


def leaves(group: list[tuple[int, int, int, int, bytes]], window: int) -> list[tuple[int, int, int]]:
    """(row, start, windows) of all that repeats in a group of (row, start, windows, left, words); equal runs as a whole."""
    equal: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
    for row, start, windows, left, words in group:
        equal.setdefault((left, words), []).append((row, start, windows))
    out = [place for places in equal.values() if len(places) > 1 for place in places]
    if len(equal) > 1 or group[0][2] > 1:
        different = [(i, 0, left, words.split(b" ")) for i, (left, words) in enumerate(equal)]
        places = list(equal.values())
        for i, shift in deep_leaves(different, window):
            if len(places[i]) == 1:
                row, start, _ = places[i][0]
                out.append((row, start + shift, 1))
    return out


def _subtrees(window: int):
    """Reads runs sorted by anchor and handles one anchor after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, group = None, []
        for batch in _with_end(batches):
            out: list[tuple[int, int, int]] = []
            if batch is None:
                out += leaves(group, window) if group else []
            else:
                for key, *one in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if key != anchor:
                        out += leaves(group, window) if group else []
                        anchor, group = key, []
                    group.append(one)
            yield _batch(out, _row=pa.int64(), start=pa.int32(), windows=pa.int32())

    return run


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """(_row, start, windows): all windows whose words start anywhere else, too, in runs of one or more."""
    anchors = _anchors(texts, window)
    again = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", (F.col("n") > GROUP).alias("large"))
    chosen = anchors.join(again, "anchor").groupBy("_row").agg(F.collect_list(F.struct("run", "large")).alias("chosen"))
    ddl = "anchor long, high long, low long, _row long, start int, windows int, left int, words binary"
    sent = land(texts.join(chosen, "_row").select("_row", "packed", "chosen").mapInArrow(_sent(window), ddl), "runs")
    place = ["_row", "start", "windows"]
    small = sent.filter("high IS NULL").select("anchor", *place, "left", "words")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deep = small.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(_subtrees(window), "_row long, start int, windows int")
    large = sent.filter("high IS NOT NULL")
    run = ["high", "low"]
    different = land(large.groupBy(*run).agg(F.count("*").alias("n"), F.min("words").alias("words")), "different-runs")
    whole = large.join(different.filter("n > 1").select(*run), run, "left_semi").select(*place)
    suffixes = different.select(*run, F.expr("n = 1").alias("alone"), "words").mapInArrow(
        _windows(window), "key long, more long, high long, low long, alone boolean, shift int"
    )
    nodes = suffixes.groupBy("key", "more").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    single = suffixes.filter("alone").join(nodes, ["key", "more"], "left_semi").select(*run, "shift")
    parted = single.join(large.select(*run, "_row", "start"), run)
    parted = parted.select("_row", (F.col("start") + F.col("shift")).alias("start"), F.lit(1).alias("windows"))
    return deep.unionByName(whole).unionByName(parted)


def _removed(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, removed, texts = [], [], [], []
            for id_, packed, starts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = _words(packed)
                kept = np.ones(len(words), bool)
                for one in (starts or ()) if len(words) >= window else ():
                    kept[one["start"] : one["start"] + one["windows"] + window - 1] = False
                ids.append(id_)
                counts.append(len(words))
                removed.append(int(len(words) - kept.sum()))
                texts.append(b" ".join(words[i] for i in np.flatnonzero(kept)).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, ``n_words``, ``n_removed`` and ``kept``, the words that stay, joined by one space, of every document.

    Every copy of a repeated window goes, the first as well, within a text or across texts.  Null and empty texts have
    no words; texts shorter than a window stay; repeated rows and ids are documents each, so copies of at least a
    window lose all words.  Only doc_id and text are read.
    """
    ship(docs.sparkSession)
    texts = _texts(docs)
    digest = ["high", "low"]
    copies = land(texts.groupBy(*digest).agg(F.count("*").alias("n"), F.min("_row").alias("_row")), "copies")
    copied = texts.select("_row", *digest).join(copies.filter("n > 1").select(*digest), digest, "left_semi")
    copied = copied.select("_row", F.lit(0).alias("start"), F.lit(EVERY).alias("windows"))
    different = texts.join(copies.select("_row"), "_row", "left_semi")
    found = repeated_windows(different, window).unionByName(copied).groupBy("_row").agg(F.collect_list(F.struct("start", "windows")).alias("starts"))
    joined = texts.join(found, "_row", "left").select("doc_id", "packed", "starts")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_removed(window), f"doc_id {kind}, n_words long, n_removed long, kept string")


def op6_prefix_partitioned_suffixes(spark, sf_dir: str) -> DataFrame:
    """Every whole document without its repeated windows, as a digest."""
    return remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


OP6_SQL = """
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT row, i AS start, md5(array_to_string(words[i + 1 : i + 35], ' ')) AS span
  FROM (SELECT row, words, unnest(range(len(words) - 34)) AS i FROM w WHERE len(words) >= 35)
), repeats AS (
  SELECT span FROM windows GROUP BY span HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT row, unnest(range(start, start + 35)) AS i FROM windows SEMI JOIN repeats USING (span)
), lists AS (
  SELECT row, list(i) AS places FROM gone GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT coalesce(list_contains(places, i - 1), false)), ' ')) AS kept_sha256
FROM w LEFT JOIN lists USING (row)
"""
