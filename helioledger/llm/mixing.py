"""Temperature mixing: source weights by an exponent, realised as budgeted permutations of blocks.

A source with a share p of the tokens gets a weight in proportion to p to the power of an exponent between 0 (all
sources alike) and 1 (as they are).  The exponent is found by bisection, 16 points at a time, each a sum over the
table of sources: the flattest mixture that keeps a limit of repetition, or the one with a wanted entropy.  A source
is then read in as many whole passes as its weight asks for and a last pass up to its budget.  Each pass takes the
blocks of a source in an order of its own, and the records of a block in another.  DataFrame functions only.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioledger.llm.tables import WORD, land, read, running

#: Points per turn and turns: 17 ** 10 steps between 0 and 1.
POINTS, TURNS = 16, 10
MOST_REPEATS = 2.0
#: Tokens in a block, about.
BLOCK_TOKENS = 1 << 20
TINY = 1e-9


def word_tokens(text: Column) -> Column:
    """Words as a measure of tokens; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_totals(rows: DataFrame) -> DataFrame:
    """``_source`` and its ``_tokens``, written: one small row per source, however many there are."""
    return land(rows.groupBy("_source").agg(F.sum("_n").alias("_tokens")), "sources")


def _bisect(sources: DataFrame, enough) -> float:
    """The least exponent in [0, 1] for which ``enough`` holds, or 1; it must hold from some point on.

    ``enough`` makes a boolean aggregate from an exponent.  Only its results come to the driver.
    """
    low, high = 0.0, 1.0
    for _ in range(TURNS):
        points = [low + (high - low) * i / (POINTS + 1) for i in range(POINTS + 2)]
        found = sources.agg(*[enough(x).alias(f"at_{i}") for i, x in enumerate(points)]).first()
        if found[0]:
            return low
        at = next((i for i, holds in enumerate(found) if holds), POINTS + 1)
        low, high = points[at - 1], points[at]
    return high


def exponent_for_repeats(sources: DataFrame, most_repeats: float) -> float:
    """The flattest mixture in which every source is read once at least and none more than ``most_repeats`` times."""
    if most_repeats < 1:
        raise ValueError("a source can't be read less than once")
    counted = sources.filter("_tokens > 0")
    spread = F.max("_tokens") / F.min("_tokens")  # the smallest source is read most often, the largest once
    return _bisect(counted, lambda x: F.coalesce(F.pow(spread, F.lit(1.0 - x)) <= most_repeats + TINY, F.lit(True)))


def exponent_for_entropy(sources: DataFrame, share: float) -> float:
    """The exponent whose weights have an entropy of ``share`` times that of equal weights, as far as 0 to 1 allows."""
    counted = sources.filter("_tokens > 0")
    x = F.col("_tokens") / F.lit(float(counted.agg(F.max("_tokens")).first()[0] or 1))

    def enough(power: float) -> Column:
        weight = F.pow(x, F.lit(power))
        entropy = F.ln(F.sum(weight)) - power * F.sum(weight * F.ln(x)) / F.sum(weight)
        return F.coalesce(entropy <= share * F.ln(F.count("*")) + TINY, F.lit(True))

    return _bisect(counted, enough)


def plan(rows: DataFrame, exponent: float, sources: DataFrame, budget: float | None = None) -> DataFrame:
    """``_source``, ``weight``, ``passes`` (whole ones), ``quota`` (tokens of the last) and ``blocks`` of each source.

    Without a budget of tokens, it is the least for which every source is read once.  A source without tokens has no
    weight and is passed over once.
    """
    power = F.when(F.col("_tokens") > 0, F.pow("_tokens", F.lit(float(exponent)))).otherwise(0.0)
    totals = sources.agg(F.sum(power).alias("_all"), F.max(F.when(F.col("_tokens") > 0, F.col("_tokens") / power)).alias("_whole")).first()
    everything, whole = totals["_all"] or 1.0, totals["_whole"] or 0.0
    scale = whole if budget is None else budget / everything  # tokens that one unit of power pays for
    reads = F.when(F.col("_tokens") > 0, F.lit(scale) * power / F.col("_tokens") + TINY).otherwise(1.0)
    passes = F.floor(reads)
    quota = F.floor((reads - passes) * F.col("_tokens")).cast("long")
    blocks = F.greatest(F.ceil(F.col("_tokens") / BLOCK_TOKENS), F.lit(1)).cast("long")
    return sources.select("_source", (power / everything).alias("weight"), passes.cast("int").alias("passes"), quota.alias("quota"), blocks.alias("blocks"))


def realise(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """One row per record and pass, of rows of ``_source``, ``_n``, ``_key`` and ``_record``: the last, ``weight``, ``epoch``, ``block`` and ``position``.

    A record's block follows from its key.  The last pass ends before the record that would overrun the quota.  Records
    with equal keys share a block and a place in it, in any order among themselves.
    """
    of = F.pmod(F.xxhash64("_key", F.lit("block")), F.col("blocks")).alias("block")
    epochs = F.explode(F.sequence(F.lit(0), F.col("passes") - F.when(F.col("quota") > 0, 0).otherwise(1)))
    some = rows.join(planned, "_source").filter("passes > 0 OR quota > 0")
    passed = some.select(*rows.columns, "weight", "passes", "quota", of, epochs.alias("epoch"))
    orders = {"_block_order": F.xxhash64("_source", "block", "epoch"), "_record_order": F.xxhash64("_key", "epoch")}
    order = ["_block_order", "block", "_record_order", "_key", "_n"]
    placed = running(passed.withColumns(orders), ["_source", "epoch"], order, F.col("_n"))
    kept = placed.filter("epoch < passes OR _before + _n <= quota")
    return kept.select("_record", "weight", "epoch", "block", F.col("_slot").alias("position"))


def mixture(
    rows: DataFrame, key: str, source: str, tokens: str, most_repeats: float = MOST_REPEATS, entropy: float | None = None, budget: float | None = None
) -> DataFrame:
    """The rows as they are read in a mixture, repeated and in order of (source, epoch, position).

    ``rows`` must be a written table with a key, a source and a number of tokens.  A null source is a source of its
    own; null or negative tokens count as 0; repeated rows are records each; an empty table gives none.  Columns named
    as the added ones are replaced.
    """
    added = ("weight", "epoch", "block", "position")
    named = F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    counted = F.greatest(F.coalesce(F.col(tokens), F.lit(0)), F.lit(0)).cast("long")
    kept = F.struct(*[c for c in rows.columns if c.lower() not in added])
    # A record travels as one value, so that none of its names can meet those of the plan.
    clean = rows.select(named.alias("_source"), counted.alias("_n"), F.col(key).alias("_key"), kept.alias("_record"))
    sources = source_totals(clean)
    exponent = exponent_for_repeats(sources, most_repeats) if entropy is None else exponent_for_entropy(sources, entropy)
    return realise(clean, plan(clean, exponent, sources, budget)).select("_record.*", *added)


def mixed_documents(docs: DataFrame, most_repeats: float = MOST_REPEATS) -> DataFrame:
    """Documents with their columns, each as often as the mixture reads it.

    The plan is made from ids alone; texts move once, to meet the number of their passes.
    """
    numbered = land(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*docs.columns).alias("_document")), "numbered-documents")
    words = word_tokens(F.col("_document.text")).alias("_words")
    narrow = land(numbered.select("_row", "_document.doc_id", "_document.source", words), "words")
    times = mixture(narrow, "doc_id", "source", "_words", most_repeats).groupBy("_row").agg(F.count("*").cast("int").alias("_times"))
    again = F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_time")
    return numbered.join(times, "_row").select("_document", again).select("_document.*")


def op3_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents as the mixture of their sources reads them; tokens are words of the whole texts."""
    narrow = land(read(spark, sf_dir, "documents", "doc_id", "source", "text").select("doc_id", "source", word_tokens(F.col("text")).alias("n_tokens")), "words")
    mixed = mixture(narrow, "doc_id", "source", "n_tokens")
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "block", "position", F.round("weight", 9).alias("weight"))


