"""Daily reading files: one JSON array of hourly objects per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioledger.functions.parsing import clock_text, iso_date, tolerant_float
from helioledger.schemas import RAW_READINGS, READING_VALUES
from helioledger.session import scratch_path

# Names of the daily files: as they are named by others, and as Spark names those of our own sink.
DAILY_FILES = "{*_data.json,part-*}"
JSON_FILES = "{*.json,part-*}"


def read_raw_json(spark: SparkSession, path: str, glob: str = JSON_FILES) -> DataFrame:
    """Strict load of every JSON file below ``path``: text columns, error on a broken file.

    A file holds one object or array, or one array on each line.  Anything after it is an error, too.
    """
    pieces = text_reader(spark.read, glob, "auto").load(path).select(F.explode(_array_texts(F.col("value"))).alias("value"))
    text = F.trim(F.col("value"), F.lit(_BLANK))
    listed = F.when(F.startswith(text, F.lit("{")), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    shape = ", ".join(f"{name}: string" for name in RAW_READINGS.names)
    seal, sealed = _sealed(F.col("value"))
    flat = F.from_json(sealed, f"map<string, array<struct<{shape}>>>", {"mode": "FAILFAST"})
    parsed = pieces.select(listed.alias("value")).filter("value <> ''").select("value", seal.alias("seal"), flat.alias("flat"))
    whole = (F.size("flat") == 2) & F.map_contains_key("flat", F.col("seal"))
    broken = F.raise_error(F.concat(F.lit("Malformed JSON after the end of: "), F.substring("value", 1, 80)))
    return parsed.select(F.inline(F.when(whole, F.try_element_at("flat", F.lit("text"))).otherwise(broken)))


def read_daily_json(
    spark: SparkSession,
    path: str,
    glob: str = DAILY_FILES,
    layout: str = "auto",
    keys: dict[str, str] | None = None,
    with_origin: bool = False,
) -> DataFrame:
    """Tolerant load of the files below ``path``.

    A file is one array, or one array on each line.  ``layout="file"`` takes it as one
    array only, ``"lines"`` each line by itself, which lets Spark split large files.
    ``keys`` maps extra fields to types, for files of many sites.  ``with_origin`` adds
    the file, the number of the array in it, and the place in the array.
    """
    text = text_reader(spark.read, glob, layout).load(path)
    return flatten_arrays(text, keys, with_origin, layout)


def text_reader(reader, glob: str, layout: str):
    """Set up a batch or streaming reader for either layout."""
    if layout not in ("auto", "file", "lines"):
        raise ValueError(f"layout must be 'auto', 'file' or 'lines', not {layout!r}")
    reader = reader.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.option("wholetext", layout != "lines")


_BLANK = " \t\r\n"


def _array_texts(text: Column) -> Column:
    """The lines of a text, if there are several and each is an array by its ends; else the text itself."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line, F.lit(_BLANK))), lambda line: line != "")
    arrays = F.forall(lines, lambda line: F.startswith(line, F.lit("[")) & F.endswith(line, F.lit("]")))
    return F.when((F.size(lines) > 1) & arrays, lines).otherwise(F.array(text))


def flatten_arrays(
    text: DataFrame, keys: dict[str, str] | None = None, with_origin: bool = False, layout: str = "auto"
) -> DataFrame:
    """Rows of the objects in each array; other entries, objects and broken text are skipped.

    A field that cannot be read is NULL and its row stays.
    """
    keys = keys or {}
    rows, origin = _entry_rows(text, keys, with_origin, layout)
    return _readings(rows.filter(F.col("entry").isNotNull()), keys, origin)


def _entry_rows(text: DataFrame, keys: dict[str, str], with_origin: bool, layout: str, more: Sequence[Column] = ()) -> tuple[DataFrame, list[str]]:
    """One row per entry, NULL for one that is no object or a text that is no array; and the names of its origin.

    ``more`` are expressions over ``seal``, ``pair`` and ``entries`` of the whole text, which its entries carry.
    """
    origin = ["source_file", "array"] if with_origin else []
    if with_origin and layout == "lines":
        text = text.select(F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().alias("array"), "value")
    elif with_origin:
        text = text.select(F.col("_metadata.file_path").alias("source_file"), "value")
    if layout == "auto":
        text = text.select(*[c for c in text.columns if c != "value"], F.posexplode(_array_texts(F.col("value"))).alias("array", "value"))
    elif layout == "file" and with_origin:
        text = text.withColumn("array", F.lit(0))
    # Each parse is a column of its own, so that whatever asks for it again does not parse again.
    parsed = text.select(*origin, *_parsed(F.col("value"), keys)).select("*", _pair(always=bool(more)).alias("pair"))
    if more:
        parsed = parsed.select(*origin, "seal", "pair", _entries(keys).alias("entries")).select(*origin, "entries", *more)
    else:
        parsed = parsed.select(*origin, _entries(keys).alias("entries"))
    carried = [name for name in parsed.columns if name != "entries"]
    # The outer form keeps the optimizer from adding a null check that would parse twice.
    if with_origin:
        return parsed.select(*carried, F.posexplode_outer("entries").alias("position", "entry")), [*origin, "position"]
    return parsed.select(*carried, F.explode_outer("entries").alias("entry")), origin


def _readings(rows: DataFrame, keys: dict[str, str], origin: Sequence[str]) -> DataFrame:
    """Typed columns of the objects."""
    return rows.select(
        *origin,
        *[F.col(f"entry.{name}").alias(name) for name in keys],
        iso_date(F.col("entry.date")).alias("date"),
        clock_text(F.col("entry.hour")).alias("hour"),
        *[tolerant_float(F.col(f"entry.{name}")).alias(name) for name in READING_VALUES],
    )


def read_with_rejects(
    spark: SparkSession, path: str, glob: str = DAILY_FILES, layout: str = "auto", keys: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The tolerant load and what it skips, as two tables from one parse, which is written once.

    Both tell ``source_file``, ``array`` and ``position``.  A reject's ``reason`` is ``malformed`` (a text that is not one
    JSON value; also a blank one) or ``not an array``, both without a position, or ``not an object`` for an entry of
    an array.  An empty array gives neither readings nor rejects, nor does a file of no bytes, which Spark's readers
    don't list.
    """
    keys = keys or {}
    one_value = F.coalesce(F.try_variant_get(F.col("pair"), "$[1]", "string") == F.col("seal"), F.lit(False))
    reason = F.when(F.col("entries").isNull(), F.when(one_value, "not an array").otherwise("malformed"))
    source = text_reader(spark.read, glob, layout).load(path)
    rows, origin = _entry_rows(source, keys, True, layout, [reason.alias("reason")])
    landed = scratch_path(spark, "entries")
    rows.write.parquet(landed)
    rows = spark.read.schema(rows.schema).parquet(landed)
    skipped = F.coalesce("reason", F.when(F.col("position").isNotNull(), "not an object"))
    rejects = rows.filter("entry IS NULL").select(*origin, skipped.alias("reason")).filter("reason IS NOT NULL")
    return _readings(rows.filter("entry IS NOT NULL"), keys, origin), rejects


# Values whose type a text would hide: truth values, and numbers that look like a compact date.
_TYPED_VALUES = r":\s*(?:true|false|[0-9]{8}\s*[,}])"


def _parsed(text: Column, keys: dict[str, str]) -> list[Column]:
    """The text, its hash, and the text as arrays of flat objects, if it is one.

    A JSON parser stops after the first value.  The text is therefore parsed as one
    value of an object, and a second one, named by a hash of the text, must follow.
    """
    fields = {**keys, **dict.fromkeys(RAW_READINGS.names, "string")}
    shape = ", ".join(f"{name}: {kind}" for name, kind in fields.items())
    seal, sealed = _sealed(text)
    flat = F.from_json(sealed, f"map<string, array<struct<{shape}>>>", {"allowSingleQuotes": "false"})
    # A failed parse costs many times one that succeeds, so what can be no array by its ends is not parsed.
    return [text.alias("text"), seal.alias("seal"), F.when(_begins(text) & _ends(text), flat).alias("flat")]


def _begins(text: Column) -> Column:
    return F.startswith(F.ltrim(text, F.lit(_BLANK)), F.lit("["))


def _ends(text: Column) -> Column:
    return F.endswith(F.rtrim(text, F.lit(_BLANK)), F.lit("]"))


def _sealed(text: Column) -> tuple[Column, Column]:
    seal = F.xxhash64(text).cast("string")
    return seal, F.concat(F.lit('{"text":'), text, F.lit(',"'), seal, F.lit('":[]}'))


def _shape() -> tuple[Column, Column, Column]:
    """Whether a text is an array by its ends, whether that needs the careful parse, and whether the plain one took all of it."""
    text, flat = F.col("text"), F.col("flat")
    is_array = _begins(text) & _ends(text)
    careful = flat.isNull() | text.rlike(_TYPED_VALUES)
    return is_array, careful, (F.size(flat) == 2) & F.map_contains_key(flat, F.col("seal"))


def _pair(always: bool) -> Column:
    """The text and its seal as one variant, where the careful parse is needed, or ``always`` where the plain one gives no entries.

    What begins as an array and does not end as one is broken without a parse.
    """
    is_array, careful, whole = _shape()
    asked = is_array & careful
    if always:
        asked = asked | (is_array & ~F.coalesce(whole, F.lit(False))) | ~_begins(F.col("text"))
    return F.when(asked, F.try_parse_json(F.concat(F.lit("["), F.col("text"), F.lit(","), F.col("seal"), F.lit("]"))))


def _entries(keys: dict[str, str]) -> Column:
    """Objects of exactly one JSON array as structs of text; NULL for other text."""
    is_array, careful, whole = _shape()
    return F.when(is_array & careful, _mixed_entries(keys)).when(is_array & whole, F.try_element_at("flat", F.lit("text")))


def _mixed_entries(keys: dict[str, str]) -> Column:
    """The same for arrays with other entries among the objects, and for typed values."""
    pair = F.col("pair")
    array = F.when(F.try_variant_get(pair, "$[1]", "string") == F.col("seal"), F.try_variant_get(pair, "$[0]", "array<variant>"))

    def flat(entry: Column) -> Column:
        fields = [F.try_variant_get(entry, f"$.{name}", kind).alias(name) for name, kind in keys.items()]
        fields += [_text_only(entry, name).alias(name) for name in ("date", "hour")]
        fields += [_number_text(entry, name).alias(name) for name in READING_VALUES]
        return F.when(F.schema_of_variant(entry).startswith("OBJECT"), F.struct(*fields))

    return F.transform(array, flat)


def _kind(entry: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(entry, f"$.{name}", "variant"))


def _text_only(entry: Column, name: str) -> Column:
    return F.when(_kind(entry, name) == "STRING", F.try_variant_get(entry, f"$.{name}", "string"))


def _number_text(entry: Column, name: str) -> Column:
    number = F.try_variant_get(entry, f"$.{name}", "double").cast("string")
    return F.when(_kind(entry, name) == "BOOLEAN", number).otherwise(F.try_variant_get(entry, f"$.{name}", "string"))


def present_dates(spark: SparkSession, path: str, glob: str = DAILY_FILES) -> DataFrame:
    """Dates that have a file, from the listing alone.

    Understands ``…/2026/01/17/2026-01-17_data.json`` and partition folders
    ``…/year=2026/month=01/day=17/…``.  The content column is pruned, so nothing is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(path_date(F.col("path")).alias("date")).filter("date IS NOT NULL").distinct()


def path_date(path: Column) -> Column:
    """The date in the path of a daily file of either kind; NULL for other paths."""
    name = F.regexp_extract(path, r"/(\d{4}-\d{2}-\d{2})_data\.json$", 1)
    folder = F.regexp_extract(path, r"/year=(\d{4})/month=\d{2}/day=\d{2}/", 0)
    dashed = F.regexp_replace(folder, r"^/year=(\d+)/month=(\d+)/day=(\d+)/$", "$1-$2-$3")
    return F.when(name != "", name).when(folder != "", dashed).try_cast("date")


def present_days(
    spark: SparkSession, path: str, keys: dict[str, str], first: dt.date | Column, last: dt.date | Column
) -> DataFrame:
    """Keys and dates that the files of the days from ``first`` to ``last`` hold; other files are not opened."""
    text = text_reader(spark.read, DAILY_FILES, "auto").load(path)
    bounds = [day if isinstance(day, Column) else F.lit(day) for day in (first, last)]
    near = text.filter(path_date(F.col("_metadata.file_path")).between(*bounds)).select("value")
    return flatten_arrays(near, keys).select(*keys, "date").distinct()
