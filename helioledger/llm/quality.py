"""Quality rules: how far a text's character classes and common words are from those of the languages.

Reference histograms are made from all documents: for each language the median share of each character class
(no junk below half of the documents moves a median) and the summed counts of its common words, which are those found
in most of its documents.  A document is compared by Jensen-Shannon distance, the square root of the divergence to
base 2, so between 0 and 1.  It is compared with every language and the nearest counts, so a tag of another of these
languages harms no clean text.  A language with too few documents has no reference, and its documents aren't judged.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from helioledger.llm.tables import SPACE, land, read, ship

#: Frequent words that tell texts of these languages where the documents give no reference for them.
COMMON = {
    "de": "aber als am an auch auf aus bei das dem den der des die ein eine einer es für hat ich im in ist mit nach nicht oder sich sie sind und von war werden wie wird zu zum zur".split(),
    "en": "a an and are as at be but by for from had has have he his i in is it not of on or that the their they this to was were which will with you".split(),
    "es": "a al como con de del el en es esta fue ha la las lo los más no o para pero por que se ser sin sobre su sus también un una y".split(),
    "fr": "à au aux avec ce cette dans de des du elle en est et il la le les mais ne nous ou par pas plus pour qui que se sont sur un une".split(),
}
SYMBOLS = "#*$%&|<>"
#: Base rules.
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20
#: Only texts of so many characters make references, and only languages with so many of these have one.
GUARD_CHARS, LEAST_DOCS = 200, 10
#: So many words of a language are common, if they are in this share of its documents.  Every word is counted in every
#: document; what is not among the common words is one more class of the histogram.
MOST_COMMON, COMMON_SHARE = 45, 0.1
#: Languages whose common words make up less (such as those written without spaces) have no reference for words.
LEAST_COMMON = 0.05
#: Texts with this share of frequent words of a language that has no reference aren't judged by words.
FREQUENT_SHARE = 0.08
#: Largest distance of classes that is kept, for texts of ``GUARD_CHARS`` or more; it widens as the root of what shorter texts lack.
CLASS_LIMIT = 0.17
#: Largest distance of words that is kept, as a share of the distance of a text without common words; to its square comes
#: what the draw of so few words adds, by this factor.
WORD_SHARE, WORD_NOISE = 0.8, 1.0

#: Numbers count as plain letters: prose with many figures is still prose.
CLASSES = ("plain", "upper", "letter", "mark", "space", "pause", "stress", "quote", "symbol", "other")
_BY_CATEGORY = {"Ll": 0, "N": 0, "Lu": 1, "Lt": 1, "Lo": 2, "Lm": 2, "M": 3, "Z": 4, "Pd": 7, "Ps": 7, "Pe": 7, "Pi": 7, "Pf": 7, "P": 8, "S": 8}


@cache
def _class_table() -> np.ndarray:
    def of(c: int) -> int:
        for place, members in ((4, SPACE), (5, ".,;:"), (6, "!?¡¿"), (7, "'\"()-")):
            if chr(c) in members:
                return place
        kind = unicodedata.category(chr(c))
        return _BY_CATEGORY.get(kind, _BY_CATEGORY.get(kind[0], 9))

    return np.fromiter(map(of, range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def class_counts(text: str) -> np.ndarray:
    """Code points by class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(_class_table()[points], minlength=len(CLASSES))


def word_counts(text: str) -> Counter[str]:
    """Counts of all words, whatever their case."""
    return Counter(text.lower().split())


def repeated_words(words: list[bytes]) -> int:
    """Words in windows that are found twice or more."""
    if len(words) < 2 * REPEAT_WINDOW - (REPEAT_WINDOW - 1):
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - REPEAT_WINDOW + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(REPEAT_WINDOW):
        mixed = (mixed ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    if len(np.unique(mixed)) == n:  # equal windows have equal hashes
        return 0
    windows = list(zip(*[words[i:] for i in range(REPEAT_WINDOW)], strict=False))
    times, end, repeated = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            repeated += i + REPEAT_WINDOW - max(i, end)
            end = i + REPEAT_WINDOW
    return repeated


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    words = text.encode().split()  # splits at the six characters between words and no others
    word_chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n_words


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances, row by row, of histograms whose rows sum to 1."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / middle), 0) + np.where(q > 0, q * np.log2(q / middle), 0)
    return np.sqrt(np.maximum(parts.sum(axis=1) / 2, 0))


def references(docs: DataFrame) -> list[Row]:
    """One row per language with enough documents: median share of each class, its common words, their counts and that of all words.

    All documents above the guard count.  One row per language comes to the driver, whatever the input.  The class
    shares of each document are written on the way, as they are a small part of its text.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, shares = [], []
            times: dict[str, Counter] = {}
            within: dict[str, Counter] = {}
            texts: Counter[str] = Counter()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(text or "") < GUARD_CHARS:
                    continue
                langs.append(lang)
                shares.append((class_counts(text) / len(text)).tolist())
                words = word_counts(text)
                times.setdefault(lang, Counter()).update(words)
                within.setdefault(lang, Counter()).update(words.keys())
                texts[lang] += 1
            rows = [(lang, None, word, n, times[lang][word]) for lang, found in within.items() for word, n in found.items()]
            rows += [(lang, None, None, n, times[lang].total()) for lang, n in texts.items()]
            every = [(lang, share, None, None, None) for lang, share in zip(langs, shares, strict=True)] + rows
            columns = list(zip(*every, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.list_(pa.float64()), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["lang", "shares", "word", "texts", "n"])

    tagged = docs.select("text", F.coalesce("lang", F.lit("")).alias("lang"))
    found = land(tagged.mapInArrow(run, "lang string, shares array<double>, word string, texts long, n long"), "histograms")
    counts = found.filter("shares IS NULL").groupBy("lang", "word").agg(F.sum("texts").alias("texts"), F.sum("n").alias("n"))
    totals = counts.filter("word IS NULL").select("lang", F.col("texts").alias("docs"), F.col("n").alias("total"))
    totals = totals.filter(F.col("docs") >= LEAST_DOCS)
    common = counts.filter("word IS NOT NULL").join(totals, "lang").filter(F.col("texts") >= COMMON_SHARE * F.col("docs"))
    ranked = F.slice(F.sort_array(F.collect_list(F.struct("texts", "n", "word")), asc=False), 1, MOST_COMMON)
    common = common.groupBy("lang").agg(ranked.alias("common"))
    medians = [F.percentile_approx(F.col("shares")[i], 0.5, 1000) for i in range(len(CLASSES))]
    shares = found.filter("shares IS NOT NULL").groupBy("lang").agg(F.array(*medians).alias("shares"))
    return shares.join(totals, "lang").join(common, "lang", "left").orderBy("lang").collect()


def _parts(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What each pair of shares adds to twice the divergence."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log2(2 * p / (p + q)), 0) + np.where(q > 0, q * np.log2(2 * q / (p + q)), 0)


class Judge:
    """Distances of a text to the nearest reference, and the verdict."""

    def __init__(self, rows: list[Row]):
        self.langs = frozenset(r.lang for r in rows)
        shares = np.array([r.shares for r in rows], float).reshape(-1, len(CLASSES))
        self.classes = shares / shares.sum(axis=1, keepdims=True)
        kept = [(r, r.common) for r in rows if r.common and sum(w.n for w in r.common) >= LEAST_COMMON * r.total]
        self.place = {word: i for i, word in enumerate(sorted({w.word for _, common in kept for w in common}))}
        self.words = np.zeros((len(self.place), len(kept)))  # share of each common word in each language
        for at, (row, common) in enumerate(kept):
            for w in common:
                self.words[self.place[w.word], at] = w.n / row.total
        self.common = self.words.sum(axis=0)
        without = np.sqrt((self.common + _parts(np.ones(len(kept)), 1 - self.common)) / 2)  # distance of a text without them
        self.limits = (WORD_SHARE * without) ** 2
        self.noise = WORD_NOISE * (self.words > 0).sum(axis=0) / (8 * np.log(2))
        self.frequent = [frozenset(words) for lang, words in COMMON.items() if lang not in self.langs]

    def class_distance(self, text: str) -> tuple[float, bool]:
        """The smallest distance, and whether it is within the limit of the text's length."""
        if not text or not len(self.classes):
            return 0.0, True
        least = float(distances(class_counts(text)[None] / len(text), self.classes).min())
        return least, least <= CLASS_LIMIT * max(1.0, GUARD_CHARS / len(text)) ** 0.5

    def word_distance(self, text: str) -> tuple[float, bool]:
        """The smallest distance, and whether that of any language is within its limit for so many words."""
        counts = word_counts(text)
        total = counts.total()
        if not total or not self.words.shape[1]:
            return 0.0, True
        if any(sum(counts[w] for w in words) >= FREQUENT_SHARE * total for words in self.frequent):
            return 0.0, True
        found = [(self.place[w], n) for w, n in counts.items() if w in self.place]
        q = self.words[[at for at, _ in found]]
        p = np.where(q > 0, np.array([n for _, n in found], float)[:, None] / total, 0)
        parts = self.common - q.sum(axis=0) + _parts(p, q).sum(axis=0) + _parts(1 - p.sum(axis=0), 1 - self.common)
        squares = np.maximum(parts / 2, 0)
        return float(np.sqrt(squares.min())), bool((squares <= self.limits + self.noise / total).any())

    def judge(self, text: str | None, lang: str | None) -> tuple:
        text = text or ""
        counts = base_counts(text)
        failed = base_failed(counts[0], counts[4])
        if (lang or "") not in self.langs:
            return (*counts, failed, not failed, 0.0, 0.0)
        classes, words = self.class_distance(text), self.word_distance(text)
        return (*counts, failed, not failed and classes[1] and words[1], classes[0], words[0])


FIELDS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "class_distance": pa.float64(),
    "word_distance": pa.float64(),
}
_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def judge_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, ``base_failed``, ``kept`` and the two distances of every document.

    A null text is an empty one and fails the base rules.  Equal rows get equal verdicts, an empty table none.
    Null is a language like any other; the distances of documents whose language has no reference are 0.  Only doc_id, text and lang are read.
    """
    judge = Judge(references(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge.judge(*r) for r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(FIELDS.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *FIELDS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "lang").mapInArrow(run, f"doc_id {kind}, {_DDL}")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns, in one pass after the references."""
    judge = Judge(references(docs))
    at, tag = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([judge.judge(*r)[6] for r in zip(batch.column(at).to_pylist(), batch.column(tag).to_pylist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_distribution_divergence(spark, sf_dir: str) -> DataFrame:
    """Every whole document, with its verdict."""
    return judge_documents(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))
