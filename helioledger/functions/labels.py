"""Label/value tokens of a chart tooltip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The short labels shown on screen and the fields they stand for.
LABELS = {"Grd": "grid", "Sol": "solar", "Bat": "battery", "Hom": "home"}
FIELDS = ("hour", "grid", "solar", "battery", "home")
LABEL_SUFFIX = " : "


def tooltip_fields(tokens: Column) -> Column:
    """Fold an ordered token array to a struct of the five fields.

    A token ending in ``" : "`` names the field of the tokens after it; tokens
    before any label are the hour.  The last value of a field wins.  The fold runs
    inside the row, so nothing is exploded or shuffled.
    """
    mapping = F.create_map(*[F.lit(text) for pair in LABELS.items() for text in pair])

    def marked(token: Column) -> Column:
        """The token, and the field it names if it is a label.  Worked out once, not once per field."""
        name = F.substring(token, F.lit(1), F.length(token) - F.lit(len(LABEL_SUFFIX)))
        label = F.when(F.endswith(token, F.lit(LABEL_SUFFIX)), F.coalesce(F.try_element_at(mapping, name), F.lower(name)))
        return F.struct(label.alias("label"), token.alias("token"))

    def step(seen: Column, mark: Column) -> Column:
        value = F.when(mark["label"].isNull(), mark["token"])
        values = [
            F.when(seen["label"] == field, F.coalesce(value, seen[field])).otherwise(seen[field]).alias(field)
            for field in FIELDS
        ]
        return F.struct(F.coalesce(mark["label"], seen["label"]).alias("label"), *values)

    nothing = F.lit(None).cast("string")
    start = F.struct(F.lit("hour").alias("label"), *[nothing.alias(field) for field in FIELDS])
    return F.aggregate(F.transform(tokens, marked), start, step, lambda end: F.struct(*[end[f].alias(f) for f in FIELDS]))


def unknown_labels(tokens: Column) -> Column:
    """Fields that tokens name beside the five, in the order of their first token; ``tooltip_fields`` leaves them out."""
    known = F.array(*map(F.lit, [*LABELS, *FIELDS]))
    names = F.transform(
        F.filter(tokens, lambda token: F.endswith(token, F.lit(LABEL_SUFFIX))),
        lambda token: F.substring(token, F.lit(1), F.length(token) - F.lit(len(LABEL_SUFFIX))),
    )
    odd = F.filter(names, lambda name: ~F.array_contains(known, name) & ~F.array_contains(known, F.lower(name)))
    return F.array_distinct(F.transform(odd, F.lower))
