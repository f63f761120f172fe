"""Totals over trailing time frames, without one task per key.

A frame `[t - s, t]` of a key changes only when a row enters (at its own second) or leaves (one
second after it is `s` old). So every total over every frame is a running sum of entries and
exits, which costs the same for a key with ten rows as for one that holds a third of the table:

1. rows are pre-aggregated to one per key and second, with map-side combine;
2. each of these becomes one entry plus one exit per frame length;
3. the running sums are taken inside blocks of `block_days` per key. What is still in a frame when
   a block starts is one more entry, a sum over the totals of the blocks before, of which there is
   one row per key and block that has rows. So the number of events does not depend on the blocks.

No group is larger than the seconds of one block, whatever the row count. Sums are exact
(integers and decimals), so taking rows out again leaves no rounding residue.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

T = "_t"                                   # second of the row
DAY = 86400
_CARRY, _CHANGE, _ROW = 0, 1, 2            # order of the kinds within one second


#: Parts of a currency unit that amounts are counted in: four decimals, as the decimal type of money has.
UNIT = 10_000


def units(amount: str) -> str:
    """An amount in whole ten-thousandths; sums of these are exact and fit a long."""
    return f"cast(rint({amount} * {UNIT}) as bigint)"


class KeyedFrames:
    """Collects the totals wanted for one key, then computes them in a single pass.

    Values and measures are SQL expressions over the input rows. Days are UTC days, so that a
    block holds whole days.
    """

    def __init__(self, key: str, block_days: int = 30):
        self.key = key
        self.block = block_days * DAY
        self._measures: dict[str, str] = {}                     # aggregate -> column
        self._totals: dict[str, tuple[str, str]] = {}           # name -> column, exit time
        self._stays: dict[str, int] = {}                        # exit time -> seconds of the frame, 0 if it ends with the day
        self._distincts: dict[str, tuple[str, int]] = {}
        self._sole: dict[str, tuple[str, int]] = {}
        self._values: dict[str, Callable[[DataFrame], DataFrame]] = {}
        self._previous: str | None = None
        self._first: str | None = None
        self._daily: tuple[str, str, int] | None = None

    # -- what to compute ---------------------------------------------------------------

    def count(self, name: str, seconds: int, of: str = "transaction_id") -> KeyedFrames:
        """Rows in the frame where `of` is not null."""
        return self._add(name, f"count({of})", f"{T} + {seconds + 1}", seconds)

    def total(self, name: str, seconds: int, value: str) -> KeyedFrames:
        """Sum over the frame of an integer or decimal value."""
        return self._add(name, f"sum({value})", f"{T} + {seconds + 1}", seconds)

    def total_today(self, name: str, value: str) -> KeyedFrames:
        """Sum over the calendar day so far."""
        return self._add(name, f"sum({value})", f"{T} - pmod({T}, {DAY}) + {DAY}", 0)

    def _add(self, name: str, aggregate: str, leaves: str, seconds: int) -> KeyedFrames:
        self._stays[leaves] = seconds
        column = self._measures.setdefault(aggregate, f"_m{len(self._measures)}")
        self._totals[name] = (column, leaves)
        return self

    def distinct(self, name: str, seconds: int, value: str) -> KeyedFrames:
        """Exact number of different values in the frame."""
        self._distincts[name] = (value, seconds)
        return self

    def sole_values(self, name: str, seconds: int, value: str) -> KeyedFrames:
        """Array of the values for which the row is the only one in the frame."""
        self._sole[name] = (value, seconds)
        return self

    def previous_row(self, payload: str) -> KeyedFrames:
        """`_prev`: the greatest payload of the last earlier second (payload orders by time)."""
        self._previous = payload
        return self

    def first_second(self, name: str) -> KeyedFrames:
        """Second of the first row of the key."""
        self._first = name
        return self

    def max_day_total(self, name: str, value: str, days: int = 30) -> KeyedFrames:
        """Greatest whole-day total among the days that have a row in the last `days` days.

        Also `_past_days`: the same without the current day.
        """
        self._daily = (name, value, days)
        return self

    def per_second_value(self, name: str, compute: Callable[[DataFrame], DataFrame]) -> KeyedFrames:
        """A column worked out elsewhere as (_key, _t, name), carried along to the same join."""
        self._values[name] = compute
        return self

    # -- how ---------------------------------------------------------------------------

    def compute(self, df: DataFrame) -> DataFrame:
        """One row per key and second: `_key`, `_t` and all requested columns."""
        rows = df.withColumn("_key", F.col(self.key)).where(f"{T} is not null")
        measures = [f"{agg} as {column}" for agg, column in self._measures.items()]
        if self._previous:
            measures.append(f"max({self._previous}) as _last")
        per_second = rows.groupBy("_key", T).agg(*[F.expr(m) for m in measures or ["count(1) as _n"]])

        parts = [self._entries_and_exits(per_second), *self._carried(per_second), *self._sightings(rows)]
        parts += [fn(rows).withColumn("_kind", F.lit(_CHANGE)) for fn in self._values.values()]
        if self._daily:
            parts.append(self._day_markers(rows))
        if self._previous or self._first:
            parts.append(self._ends_of_blocks(rows))
        events = parts[0]
        for other in parts[1:]:
            events = events.unionByName(other, allowMissingColumns=True)
        # What leaves a frame after the last row of the table changes none.
        events = events.where(F.col(T) <= rows.agg(F.max(T)).scalar())
        return self._sweep(events.withColumn("_block", F.expr(f"{T} div {self.block}")))

    def _starts_within(self, leaves: str, longest: int) -> list[tuple[str, str]]:
        """(condition, time) of each block start that a stay from `_t` until `leaves` can cross."""
        first = f"({T} div {self.block} + {{}})".format
        return [(f"({leaves} - 1) div {self.block} >= {first(j)}", f"{first(j)} * {self.block}")
                for j in range(1, -(-longest // self.block) + 1)]

    def attach(self, df: DataFrame, source: DataFrame | None = None, peers: tuple[str, ...] = ()) -> DataFrame:
        """Input rows with the requested columns; a null key is a key like any other.

        The frames are computed from `source` where the rows have been widened since. With `peers`, the order of rows within one second,
        also `_peer`: the payload of the row before this one within its second, looked up where the rows lie for the join.
        """
        found = self.compute(df if source is None else source).withColumnRenamed(T, "_ft")
        if not peers:
            same = F.col(self.key).eqNullSafe(F.col("_key")) & (F.col(T) == F.col("_ft"))
            return df.join(found, same, "left").drop("_key", "_ft")
        # A struct is never null, so the look-up and the join deal the rows out by the same plain columns.
        rows = df.withColumn(self.key, F.struct(F.col(self.key).alias("key"))).withColumn(
            "_peer", F.lag(F.expr(self._previous)).over(Window.partitionBy(T, self.key).orderBy(*peers)))
        found = found.withColumn("_key", F.struct(F.col("_key").alias("key")))
        out = rows.join(found, (F.col(T) == F.col("_ft")) & (F.col(self.key) == F.col("_key")), "left").drop("_key", "_ft")
        return out.withColumn(self.key, F.col(self.key)["key"])

    def _entries_and_exits(self, per_second: DataFrame) -> DataFrame:
        def event(at: str, kind: int, sign: str, leaving: str | None) -> str:
            fields = [f"{at} as {T}", f"{kind} as _kind"]
            for name, (column, leaves) in self._totals.items():
                value = f"{sign}{column}"
                fields.append(f"{value if leaving in (None, leaves) else f'if(false, {value}, null)'} as {name}")
            if self._previous:
                fields.append(f"{'_last' if leaving is None else 'if(false, _last, null)'} as _last")
            return f"struct({', '.join(fields)})"

        events = [event(T, _ROW, "", None)]
        for at in self._stays:
            # A stay that ends where a block starts has not been carried into it.
            events.append(f"if(pmod({at}, {self.block}) = 0, null, {event(at, _CHANGE, '-', at)})")
        return per_second.selectExpr("_key", f"inline(array({', '.join(events)}))").where(f"{T} is not null")

    def _carried(self, per_second: DataFrame) -> list[DataFrame]:
        """At the start of each block of a key: what is still in the frames.

        A frame reaches back over whole blocks and the end of one more, so one row per key and block holds the totals of both.
        """
        stays = {name: (column, *divmod(self._stays[leaves], self.block)) for name, (column, leaves) in self._totals.items() if self._stays[leaves]}
        if not stays:
            return []
        sums = {f"_w{column}": f"sum({column})" for column, whole, _ in stays.values() if whole}
        sums |= {f"_e{column}_{part}": f"sum(if(pmod({T}, {self.block}) >= {self.block - part}, {column}, null))" for column, _, part in stays.values() if part}
        blocks = per_second.groupBy("_key", F.expr(f"{T} div {self.block}").alias("_b")).agg(*[F.expr(e).alias(n) for n, e in sums.items()])
        over = "over (partition by _key order by _b range between {} preceding and {} preceding)".format
        fields = []
        for name, (column, whole, part) in stays.items():
            found = [f"sum(_w{column}) {over(whole, 1)}"] * bool(whole) + [f"sum(_e{column}_{part}) {over(whole + 1, whole + 1)}"] * bool(part)
            both = found if len(found) < 2 else [f"coalesce({found[0]} + {found[1]}, {found[0]}, {found[1]})"]
            fields.append(f"{both[0]} as {name}")
        return [blocks.selectExpr("_key", f"_b * {self.block} as {T}", f"{_CARRY} as _kind", *fields)]

    def _neighbours(self, sightings: DataFrame) -> DataFrame:
        """The sightings with `_before` and `_after`, the ones of the same value next to them.

        Looked up inside blocks; the first and the last sighting of a block are marked in the next blocks that have the value.
        """
        placed = sightings.selectExpr("*", f"{T} div {self.block} as _b", "false as _mark")
        next_to = "over (partition by _key, _value order by _b)"
        edges = placed.groupBy("_key", "_value", "_b").agg(F.min(T).alias("_first"), F.max(T).alias("_last")).selectExpr(
            "_key", "_value", "_b", f"array(lag(_last) {next_to}, lead(_first) {next_to}) as _marks").selectExpr(
            "_key", "_value", "_b", f"explode(_marks) as {T}").where(f"{T} is not null").selectExpr("*", "true as _mark")
        over = f"over (partition by _key, _value, _b order by {T})"
        return (placed.unionByName(edges, allowMissingColumns=True)
                .selectExpr("*", f"lag({T}) {over} as _before", f"lead({T}) {over} as _after").where("not _mark").drop("_b", "_mark"))

    def _sightings(self, rows: DataFrame) -> list[DataFrame]:
        """+1 where a value comes into the frame, -1 where its last sighting leaves it."""
        out = []
        for value in dict.fromkeys(v for v, _ in [*self._distincts.values(), *self._sole.values()]):
            seen = self._neighbours(rows.groupBy("_key", F.expr(value).alias("_value"), T).agg(F.count("transaction_id").alias("_n")))
            for name, (v, seconds) in self._distincts.items():
                if v != value:
                    continue
                comes, goes = f"(_before is null or _before < {T} - {seconds})", f"(_after is null or _after > {T} + {seconds})"
                step = f"if({{}}, struct({{}} as {T}, {{}}L as {name}, {{}} as _kind), null)".format
                steps = [step(comes, T, 1, _CHANGE),
                         step(f"{goes} and pmod({T} + {seconds + 1}, {self.block}) <> 0", f"{T} + {seconds + 1}", -1, _CHANGE)]
                # The next sighting in the frame brings no entry of its own, also if it opens a block.
                until = f"least(coalesce(_after + 1, {T} + {seconds + 1}), {T} + {seconds + 1})"
                steps += [step(crosses, start, 1, _CARRY) for crosses, start in self._starts_within(until, seconds)]
                moves = seen.where("_value is not null").selectExpr("_key", f"inline(array({', '.join(steps)}))").where(f"{T} is not null")
                # One row per second also where very many values come or go within it.
                out.append(moves.groupBy("_key", T, "_kind").agg(F.sum(name).alias(name)))
            for name, (v, seconds) in self._sole.items():
                if v == value:
                    alone = seen.where(f"_n <= 1 and (_before is null or _before < {T} - {seconds})")
                    out.append(alone.groupBy("_key", T).agg(F.collect_set("_value").alias("_values")).selectExpr(
                        "_key", T, f"{_CHANGE} as _kind", f"struct({T} as t, _values as v) as {name}"))
        return out

    def _day_markers(self, rows: DataFrame) -> DataFrame:
        """At the start of each day of a key: the greatest total of the days before it, its own,
        and the one day that a frame reaches only in part."""
        _, value, days = self._daily
        daily = (rows.groupBy("_key", F.expr(f"{T} div {DAY}").alias("_day"))
                 .agg(F.expr(f"max({T}) as _last_t"), F.expr(f"sum({value}) as _total")))
        over = "over (partition by _key order by _day range between {} preceding and {} preceding)".format
        edge = over(days, days)
        return daily.selectExpr(
            "_key", f"_day * {DAY} as {T}", f"{_CHANGE} as _kind",
            f"struct(max(_total) {over(days - 1, 1)} as past, _total as own,"
            f" max(_last_t) {edge} as edge_t, max(_total) {edge} as edge) as _day")

    def _ends_of_blocks(self, rows: DataFrame) -> DataFrame:
        """At the start of each block of a key: the last row and the first second before it."""
        ends = (([f"max({self._previous}) as _last"] * bool(self._previous))
                + ([f"min({T}) as _first"] * bool(self._first)))
        blocks = rows.groupBy("_key", F.expr(f"{T} div {self.block}").alias("_b")).agg(*[F.expr(e) for e in ends])
        earlier = "over (partition by _key order by _b rows between unbounded preceding and 1 preceding)"
        return blocks.selectExpr(
            "_key", f"_b * {self.block} as {T}", f"{_CARRY} as _kind",
            *[f"last(_last, true) {earlier} as _last"] * bool(self._previous),
            *[f"min(_first) {earlier} as _first"] * bool(self._first))

    def _sweep(self, events: DataFrame) -> DataFrame:
        within = f"over (partition by _key, _block order by {T}, _kind rows between unbounded preceding and"
        upto, earlier = f"{within} current row)", f"{within} 1 preceding)"
        cols = [f"sum({c}) {upto} as {c}" for c in self._totals]
        cols += [f"coalesce(sum({c}) {upto}, 0L) as {c}" for c in self._distincts]
        cols += [f"last({c}, true) {upto} as {c}" for c in self._values]
        cols += [f"last({c}, true) {upto} as {c}" for c in self._sole]
        if self._previous:
            cols.append(f"last(_last, true) {earlier} as _prev")
        if self._first:
            cols.append(f"min(if(_kind = {_ROW}, {T}, _first)) {upto} as {self._first}")
        if self._daily:
            cols.append(f"last(_day, true) {upto} as _day")
        out = events.selectExpr("_key", T, "_kind", *cols).where(f"_kind = {_ROW}").drop("_kind")
        for c in self._sole:
            out = out.withColumn(c, F.expr(f"if({c}.t = {T}, {c}.v, null)"))
        if not self._daily:
            return out
        name, _, days = self._daily
        edge = f"if(_day.edge_t >= {T} - {days * DAY}, _day.edge, null)"
        kept = [c for c in out.columns if c != "_day"]
        return out.selectExpr(*kept, f"greatest(_day.past, _day.own, {edge}) as {name}",
                              f"greatest(_day.past, {edge}) as _past_days")
