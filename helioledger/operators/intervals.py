"""Joins of timed facts to intervals, without nested loops.

Each interval is repeated once per month (or day) it touches, and facts meet it
through an equality on the keys and that slot.  The exact bounds remain as a
residual condition, so the result equals that of the plain range join: overlaps
multiply rows, gaps drop them, and an interval with a missing bound matches nothing.

The interval side is broadcast only after it has been measured.  Beyond the limit
both sides are shuffled on keys and slot.  Groups of facts above ``split_above``
rows are then cut into slices, with the interval side repeated for each slice.

Where intervals are dense no pairs are compared.  Anti joins, also all that are
shuffled, read facts and intervals of a slot together in order of time: a fact is
covered if the latest end so far is not before it.  Inner joins number the different
moments of a slot in order, so that an interval is a run of numbers, and meet facts by
equality on blocks of numbers.  Both take time in proportion to what goes in and comes
out, however many intervals overlap, and only what goes in is moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from helioledger.operators.hot_groups import SLICE, find_hot_groups, repeat_for_slices, slice_rows
from helioledger.session import scratch_path

SLOT = "_slot"
BROADCAST_BYTES = 32 * 1024 * 1024
SPLIT_ABOVE = 10_000_000
# From so many intervals of one key and slot on, facts are not compared with each of them.
DENSE = 256
# Stands for the slot of a missing moment: no interval has it.  A slot that cannot be
# NULL also spares the optimizer from pushing a null check, and with it the parsing
# of the timestamp, a second time below the join.
NO_SLOT = -(2**31)
# An interval over more slots than this is first clipped to the span of the facts,
# which takes a pass over their moments.
LONG_SPAN = 2_400
# Blocks that make up the numbers above ``_low`` through ``_high``: at most two of each size.
_BLOCKS = """flatten(transform(sequence(0, length(bin(_high)) - 1), l -> filter(array(
  struct(l AS _level, shiftright(_low + shiftleft(1L, l) - 1, l) AS _block),
  struct(l AS _level, shiftright(_high, l) - 1 AS _block)),
  (b, i) -> shiftright(_low + shiftleft(1L, l) - 1, l) < shiftright(_high, l)
    AND CASE WHEN i = 0 THEN b._block % 2 = 1 ELSE b._block % 2 = 0 END)))"""
# Facts and intervals that are read together in one task.
TASK_ROWS = 400_000
# Intervals that make so many times their rows are dealt over tasks of about so many rows before they are spread.
DEAL_TIMES, DEAL_ROWS = 4, 200_000


def slot_of(moment: Column, grain: str) -> Column:
    if grain == "month":
        return F.year(moment) * 12 + F.month(moment)
    if grain == "day":
        return F.unix_date(F.to_date(moment))
    raise ValueError(f"grain must be 'month' or 'day', not {grain!r}")


@dataclass(frozen=True)
class Intervals:
    """The interval side: its bounds, the columns it hands over, its measured size."""

    frame: DataFrame
    start: str
    end: str
    payload: tuple[str, ...] = ()
    grain: str = "month"
    keys: tuple[str, ...] = ()
    intervals: int = 0
    rows: int = 0
    size: int = 0
    longest: int = 0
    # Most intervals of one key that touch one slot.
    together: int = 0
    # Whether ``frame`` is costly enough to be written before it is measured and joined.
    condensed: bool = False

    def measure(self, place: int, first: int | None = None, last: int | None = None) -> DataFrame:
        """Intervals, rows and bytes after spreading (within the given slots, if any) and the longest span in slots, as one row.

        Nothing is spread for it and nothing shuffled but a row per task.
        """
        text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in self._used().schema if f.dataType.typeName() == "string"]
        width = sum(text, F.lit(24 + 8 * (len(self._used().columns) + 1)))
        low, high = self._within(first, last)
        span = (high - low + 1).cast("long")
        bounds = self._used().filter(self._valid()).select(span.alias("_span"), width.alias("_width")).filter("_span > 0")
        found = {"intervals": F.count("*"), "rows": F.sum("_span"), "size": F.sum(F.col("_span") * F.col("_width")), "longest": F.max("_span")}
        return bounds.agg(F.lit(place).alias("place"), *[F.coalesce(value, F.lit(0)).alias(name) for name, value in found.items()])

    def densest(self, place: int, first: int | None = None, last: int | None = None) -> DataFrame:
        """Most intervals of one key that touch one slot, as one row: counted where intervals begin and end, without spreading them."""
        names = [f"_key_{key}" for key in self.keys]
        low, high = self._within(first, last)
        bounds = self._used().filter(self._valid()).select(*[F.col(key).alias(name) for key, name in zip(self.keys, names)], low.alias("_low"), high.alias("_high"))
        ends = [F.struct(F.col("_low").alias(SLOT), F.lit(1).alias("_step")), F.struct((F.col("_high") + 1).alias(SLOT), F.lit(-1).alias("_step"))]
        steps = bounds.filter("_low <= _high").select(*names, F.inline(F.array(*ends)))
        changes = steps.groupBy(*names, SLOT).agg(F.sum("_step").alias("_step"))
        so_far = Window.partitionBy(*(names or [F.lit(0)])).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = changes.select(F.sum("_step").over(so_far).alias("_n"))
        return running.agg(F.lit(place).alias("place"), F.coalesce(F.max("_n"), F.lit(0)).alias("together"))

    def spread(self, first: int | Column | None = None, last: int | Column | None = None) -> DataFrame:
        """One row per interval and slot, within the given slots if any."""
        valid, (low, high) = self._valid(), self._within(first, last)
        if first is not None:
            valid = valid & (low <= high)
        columns = [F.col(key).alias(f"_key_{key}") for key in self.keys]
        columns += [F.col(self.start).alias("_from"), F.col(self.end).alias("_to")]
        columns += [F.col(name).alias(name) for name in self.payload]
        return self._dealt().select(*columns, F.explode(F.when(valid, F.sequence(low, high))).alias(f"{SLOT}_side"))

    def _dealt(self) -> DataFrame:
        """The intervals, dealt over more tasks if few of them make many rows, as a small table may be a single file."""
        if self.rows < DEAL_TIMES * self.intervals:
            return self.frame
        most = int(self.frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = min(most, self.rows // DEAL_ROWS)
        return self.frame.repartition(parts, *self.keys, self.start, self.end) if parts > 1 else self.frame

    def written(self) -> Intervals:
        """Condensed intervals from the shared folder, so that measuring and joining do not make them again."""
        if not self.condensed:
            return self
        path = scratch_path(self.frame.sparkSession, "intervals")
        self.frame.write.parquet(path)
        return replace(self, frame=self.frame.sparkSession.read.schema(self.frame.schema).parquet(path), condensed=False)

    def _used(self) -> DataFrame:
        return self.frame.select(*self.keys, self.start, self.end, *self.payload)

    def _within(self, first: int | Column | None, last: int | Column | None) -> tuple[Column, Column]:
        """First and last slot, clipped to those given."""
        if first is None:
            return self._first(), self._last()
        first, last = (bound if isinstance(bound, Column) else F.lit(bound) for bound in (first, last))
        return F.greatest(self._first(), first), F.least(self._last(), last)

    def _first(self) -> Column:
        return slot_of(F.col(self.start), self.grain)

    def _last(self) -> Column:
        return slot_of(F.col(self.end), self.grain)

    def _valid(self) -> Column:
        # A missing or reversed bound can match no fact.
        return F.col(self.start) <= F.col(self.end)


@dataclass(frozen=True)
class SlottedFacts:
    """Facts tagged once with slot and slice, so that several joins share one shuffle."""

    frame: DataFrame
    moment: str
    keys: tuple[str, ...]
    grain: str
    hot: DataFrame | None = None
    # How many, where they have been counted.
    rows: int = 0

    @classmethod
    def tag(cls, facts: DataFrame, moment: str, keys: Sequence[str] = (), grain: str = "month") -> SlottedFacts:
        slot = F.coalesce(slot_of(F.col(moment), grain), F.lit(NO_SLOT))
        return cls(facts.withColumn(SLOT, slot), moment, tuple(keys), grain)

    def split_hot(self, split_above: int | None) -> SlottedFacts:
        """Cut groups of more than ``split_above`` facts of one key and slot into slices."""
        group = [*self.keys, SLOT]
        if not split_above:
            return self
        seen = Observation()
        hot = find_hot_groups(self.frame, group, split_above, seen)
        counted = replace(self, rows=seen.get["rows"])
        return counted if hot is None else replace(counted, frame=slice_rows(self.frame, group, hot), hot=hot)

    def join(self, side: Intervals, how: str, low: int | None, high: int | None, broadcast: bool) -> SlottedFacts:
        spread = side.spread(low, high)
        moment = F.col(self.moment)
        if dict(side.frame.dtypes)[side.start] == "date":
            moment = F.to_date(moment)
        # Written so that no null check on the moment follows from it (see NO_SLOT).
        within = F.coalesce(moment.between(F.col("_from"), F.col("_to")), F.lit(False))
        match = (F.col(SLOT) == F.col(f"{SLOT}_side")) & within
        for key in self.keys:
            match = match & (F.col(key) == F.col(f"_key_{key}"))
        if self.hot is not None and not broadcast:
            group = {SLOT: f"{SLOT}_side", **{key: f"_key_{key}" for key in self.keys}}
            spread = repeat_for_slices(spread, group, self.hot, f"{SLICE}_side")
            match = match & (F.col(SLICE) == F.col(f"{SLICE}_side"))
        # The optimizer does not see that spreading multiplies rows, so neither way is left to it.
        spread = F.broadcast(spread) if broadcast else spread.hint("merge")
        joined = self.frame.join(spread, match, how)
        if how != "left_anti":
            joined = joined.select(*self.frame.columns, *side.payload)
        return replace(self, frame=joined)

    def outside(self, side: Intervals, low: int | Column | None, high: int | Column | None) -> SlottedFacts:
        """Facts that no interval covers, from one reading of both in order of time."""
        names, kind = self.frame.columns, self.frame.schema[self.moment].dataType
        place = [*self.keys, SLOT, *([SLICE] if self.hot is not None else [])]
        spread = side.spread(low, high)
        if dict(side.frame.dtypes)[side.start] == "date":
            kind = side.frame.schema[side.start].dataType
        if self.hot is not None:
            group = {SLOT: f"{SLOT}_side", **{key: f"_key_{key}" for key in self.keys}}
            spread = repeat_for_slices(spread, group, self.hot, f"{SLICE}_side")
        for key in self.keys:  # a missing key is no key
            spread = spread.filter(F.col(f"_key_{key}").isNotNull())
        origin = {SLOT: f"{SLOT}_side", SLICE: f"{SLICE}_side", **{key: f"_key_{key}" for key in self.keys}}
        blank = [
            (F.col(origin[name]) if name in place else F.lit(None)).cast(self.frame.schema[name].dataType).alias(name) for name in names
        ]
        facts = self.frame.select("*", F.col(self.moment).cast(kind).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_until"))
        spans = spread.select(*blank, F.col("_from").cast(kind).alias("_at"), F.lit(0).alias("_kind"), F.col("_to").cast(kind).alias("_until"))
        so_far = Window.partitionBy(*place).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        both = facts.unionByName(spans)
        # Tasks of a size that fits memory, however well their rows compress.
        parts = -(-(self.rows + side.rows) // TASK_ROWS)
        both = both.repartition(parts, *place) if self.rows and parts > 1 else both
        marked = both.withColumn("_covered", F.max("_until").over(so_far))
        covered = F.coalesce(F.col("_covered") >= F.col("_at"), F.lit(False))
        return replace(self, frame=marked.filter((F.col("_kind") == 1) & ~covered).select(*names))

    def meeting(self, side: Intervals, low: int | None, high: int | None, split_above: int | None, broadcast_bytes: int) -> SlottedFacts:
        """Facts with every interval that holds them, without comparing pairs and without moving the pairs.

        The moments of a slot are numbered; an interval holds a run of numbers, and is cut into blocks of 1, 2, 4, …
        numbers that begin at a multiple of their size.  A fact is in one block of each size, so both meet by equality.
        If the facts with their blocks are small they are sent to the intervals, which then stay where they are.
        Otherwise groups of more than ``split_above`` intervals are cut into slices, each with all facts of the group.
        """
        group = [*self.keys, SLOT]
        moment, kind = F.col(self.moment), self.frame.schema[self.moment].dataType
        if dict(side.frame.dtypes)[side.start] == "date":
            moment, kind = F.to_date(moment), side.frame.schema[side.start].dataType
        placed = [F.col(f"_key_{key}").alias(key) for key in self.keys] + [F.col(f"{SLOT}_side").alias(SLOT)]
        bounds = [F.col(name).cast(kind).alias(name) for name in ("_from", "_to")]
        handed = F.struct(F.lit(True).alias("_one"), *side.payload).alias("_payload")
        spans = side.spread(low, high).select(*placed, *bounds, handed)
        for key in self.keys:  # a missing key is no key
            spans = spans.filter(F.col(key).isNotNull())

        # How many moments come before each different beginning, and up to each different end.
        moments = self.frame.select(*group, moment.cast(kind).alias("_at")).filter(F.col("_at").isNotNull()).distinct()
        ends = [F.struct(F.col(name).alias("_at"), F.lit(turn).alias("_turn")) for name, turn in (("_from", 0), ("_to", 2))]
        marks = spans.select(*group, F.inline(F.array(*ends))).distinct().unionByName(moments.withColumn("_turn", F.lit(1)))
        so_far = Window.partitionBy(*group).orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        passed = F.sum(F.when(F.col("_turn") == 1, 1).otherwise(0)).over(so_far).alias("_passed")
        path = scratch_path(self.frame.sparkSession, "moments")
        marks.select(*group, "_at", "_turn", passed).write.parquet(path)
        counted = self.frame.sparkSession.read.parquet(path)
        width = 24 + 8 * (len(group) + 2)
        few = counted.count() * width <= broadcast_bytes

        def looked_up(rows: DataFrame, bound: str, turn: int, **found: Column) -> DataFrame:
            sides = {column: f"{column}_mark" for column in group}
            renamed = [F.col(n).alias(m) for n, m in sides.items()]
            numbers = counted.filter(F.col("_turn") == turn).select(*renamed, F.col("_at").alias("_mark"), *[value.alias(name) for name, value in found.items()])
            match = F.col(bound) == F.col("_mark")
            for column, other in sides.items():
                match = match & (F.col(column) == F.col(other))
            return rows.join(F.broadcast(numbers) if few else numbers.hint("merge"), match).select(*rows.columns, *found)

        held = looked_up(looked_up(spans, "_from", 0, _low=F.col("_passed")), "_to", 2, _high=F.col("_passed")).filter("_low < _high")
        blocks = held.select(*group, "_payload", F.inline(F.expr(_BLOCKS)))
        dated = self.frame.withColumn("_moment", moment.cast(kind))
        # The largest block of a slot has no more numbers than the slot.
        most = F.max("_passed").over(Window.partitionBy(*group))
        sized = looked_up(dated, "_moment", 1, _nth=F.col("_passed"), _most=most)
        levels = F.sequence(F.lit(0), F.length(F.bin("_most")) - 1)
        inside = sized.select(*self.frame.columns, "_nth", F.explode(levels).alias("_level"))
        inside = inside.select(*self.frame.columns, "_level", F.expr("shiftright(_nth - 1, _level)").alias("_block"))
        text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in inside.schema if f.dataType.typeName() == "string"]
        weight = sum(text, F.lit(24 + 8 * len(inside.columns)))
        small = few and (inside.agg(F.sum(weight)).first()[0] or 0) <= broadcast_bytes

        place = [*group, "_level", "_block"]
        hot = None if small or not split_above else find_hot_groups(blocks, place, split_above)
        if hot is not None:
            cut = f"{SLICE}_block"
            blocks = slice_rows(blocks, place, hot).withColumnRenamed(SLICE, cut)
            inside = repeat_for_slices(inside, {name: name for name in place}, hot, cut)
            place = [*place, cut]
        sides = [F.col(name).alias(f"{name}_side") for name in place]
        blocks = blocks.select(*sides, "_payload")
        match = reduce(Column.__and__, [F.col(name) == F.col(f"{name}_side") for name in place])
        # The many are read once, the facts of a block are kept at hand.
        joined = blocks.join(F.broadcast(inside) if small else inside.hint("merge"), match)
        return replace(self, frame=joined.select(*self.frame.columns, *[F.col(f"_payload.{name}").alias(name) for name in side.payload]))

    def untagged(self, slotted: bool = False) -> DataFrame:
        return self.frame.drop(SLICE) if slotted else self.frame.drop(SLOT, SLICE)


def join_intervals(
    facts: DataFrame,
    moment: str,
    steps: Sequence[tuple[str, Intervals]],
    keys: Sequence[str] = (),
    grain: str = "month",
    broadcast_bytes: int = BROADCAST_BYTES,
    split_above: int | None = SPLIT_ABOVE,
    live: bool = False,
    slotted_rows: bool = False,
) -> DataFrame:
    """Apply interval joins (``"inner"`` or ``"left_anti"``) to the facts, in order.

    ``live`` makes a plan that holds no number found in today's tables, for views: the
    span of the facts is asked for whenever the view is read, and nothing is broadcast
    or split by a size measured before.  With ``slotted_rows`` they keep their slot, by which a shuffled plan has
    dealt them, so that sums by key, slot and day need no shuffle of their own.
    """
    keys = tuple(keys)
    sides = [replace(side, grain=grain, keys=keys) for _, side in steps]
    slotted = SlottedFacts.tag(facts, moment, keys, grain)
    if live:
        dated = slotted.frame.filter(F.col(SLOT) != NO_SLOT)
        low = dated.agg(F.coalesce(F.min(SLOT), F.lit(1))).scalar()
        high = dated.agg(F.coalesce(F.max(SLOT), F.lit(0))).scalar()
        for (how, _), side in zip(steps, sides):
            slotted = slotted.outside(side, low, high) if how == "left_anti" else slotted.join(side, how, low, high, False)
        return slotted.untagged(slotted_rows)

    sides = _measured([side.written() for side in sides])
    low = high = None
    if any(side.longest > LONG_SPAN for side in sides):
        dated = slotted.frame.filter(F.col(SLOT) != NO_SLOT)
        low, high = dated.agg(F.coalesce(F.min(SLOT), F.lit(1)), F.coalesce(F.max(SLOT), F.lit(0))).first()
        # What clipping leaves of each side is counted again.
        sides = _measured(sides, low, high)

    small = [side.size <= broadcast_bytes for side in sides]
    # Whether pairs are compared depends on it in inner joins and in anti joins that could be broadcast.
    asked = [place for place, (how, _) in enumerate(steps) if sides[place].rows > DENSE and (how != "left_anti" or small[place])]
    if asked:
        for m in reduce(DataFrame.union, [sides[place].densest(place, low, high) for place in asked]).collect():
            sides[m["place"]] = replace(sides[m["place"]], together=m["together"])
    dense = [side.together > DENSE for side in sides]
    # Shuffled anti joins compare no pairs in any case.
    paired = [not d and (how != "left_anti" or fits) for (how, _), d, fits in zip(steps, dense, small)]
    if not all(small) or not all(paired):
        slotted = slotted.split_hot(split_above)
    for (how, _), side, fits, pairs in zip(steps, sides, small, paired):
        if pairs:
            slotted = slotted.join(side, how, low, high, fits)
        elif how == "left_anti":
            slotted = slotted.outside(side, low, high)
        else:
            slotted = slotted.meeting(side, low, high, split_above, broadcast_bytes)
    return slotted.untagged(slotted_rows)


def _measured(sides: list[Intervals], low: int | None = None, high: int | None = None) -> list[Intervals]:
    """The sides with their sizes, from one job."""
    found = reduce(DataFrame.union, [side.measure(place, low, high) for place, side in enumerate(sides)]).collect()
    return [replace(sides[m["place"]], **{n: m[n] for n in ("intervals", "rows", "size", "longest")}) for m in sorted(found, key=lambda m: m["place"])]
