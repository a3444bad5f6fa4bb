"""Global order without a one-partition window: ranks, tiles and running totals.

A window without PARTITION BY sends every row to one task.  Here, at every size alike:

1. Rows are range-partitioned by (value, unique key) and stored with the number of their
   range.  The key breaks ties, so that a value held by most rows is still cut into even
   ranges.  What is stored cannot move to another range when a task is run again.
2. Ranges are counted (and summed) by a normal aggregation: one row per range, and there are
   as many ranges as the session has shuffle partitions.
3. Ranks and running totals are computed inside each range and shifted by what the ranges
   before it hold.

NTILE needs no ranks: it is decided by comparing each row with the k-1 rows at which a new
tile starts.  Those are found from how many rows each value has: the values are put in order
instead of the rows, and only rows of the values at which a tile starts are ordered by key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from vendlens.session import materialise


@dataclass(frozen=True)
class Ordering:
    """ORDER BY value [DESC] NULLS LAST, key NULLS LAST, with `key` unique.

    Values are numbers (or dates, ascending), keys numbers or strings.
    """

    value: str
    key: str
    descending: bool = False

    def _value_fields(self) -> list[Column]:
        value = F.col(self.value)
        return [
            value.isNull().alias("no_value"),
            (-value if self.descending else value).alias("value"),
        ]

    def value_place(self) -> Column:
        """The place of a row's value among the values."""
        return F.struct(*self._value_fields())

    def place(self) -> Column:
        """A row's place as one comparable value; smaller places come first."""
        key = F.col(self.key)
        return F.struct(*self._value_fields(), key.isNull().alias("no_key"), key.alias("key"))

    def sort_columns(self) -> list[Column]:
        value, key = F.col(self.value), F.col(self.key)
        return [
            value.desc_nulls_last() if self.descending else value.asc_nulls_last(),
            key.asc_nulls_last(),
        ]


def ranged(df: DataFrame, ordering: Ordering) -> DataFrame:
    """`df` stored with its `range`: ranges follow each other in the order.

    Runs a job.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(ranges, *ordering.sort_columns())
    return materialise(cut.withColumn("range", F.spark_partition_id()), "ranges")


@dataclass(frozen=True)
class Points:
    """Some places of an ordering, in order, as literals."""

    ordering: Ordering
    places: list[str]
    schema: str

    def passed(self) -> Column:
        """How many of the places are at or before the row."""
        place = self.ordering.place()
        return reduce(Column.__add__, [
            F.when(place >= F.from_json(F.lit(p), self.schema), 1).otherwise(0)
            for p in self.places
        ], F.lit(0))


def rows_at(stored: DataFrame, ordering: Ordering, ranks_of) -> Points:
    """The places of the rows with certain (1-based) ranks; `stored` comes from `ranged`.

    `ranks_of` gives the ranks for the number of rows.  Only the ranges holding such a rank
    are sorted.  The driver sees one count per range and one row per rank.
    """
    places = stored.select(ordering.place().alias("place"), "range")
    schema = places.schema["place"].dataType.simpleString()
    wanted = _homes(places.groupBy("range").agg(F.count(F.lit(1)).alias("rows")), ranks_of)
    if not wanted:
        return Points(ordering, [], schema)
    local = Window.partitionBy("range").orderBy("place")
    is_wanted = F.struct("range", "rank").isin(
        *[F.struct(F.lit(home), F.lit(rank)) for home, rank in wanted]
    )
    found = (
        places.where(F.col("range").isin(*{home for home, _ in wanted}))
        .withColumn("rank", F.row_number().over(local))
        .where(is_wanted)
        .sort("place")
        .select(F.to_json("place", {"ignoreNullFields": "false"}))
    )
    return Points(ordering, [row[0] for row in found.collect()], schema)


def _homes(held: DataFrame, ranks_of) -> list[tuple[int, int]]:
    """(range, rank inside it) of the wanted ranks, from one row per range."""
    counts = {r["range"]: r["rows"] for r in held.collect()}
    ends = dict(zip(sorted(counts), accumulate(counts[r] for r in sorted(counts))))
    wanted = []
    for rank in ranks_of(sum(counts.values())):
        home = next((r for r, end in ends.items() if rank <= end), None)
        if home is not None:
            wanted.append((home, rank - (ends[home] - counts[home])))
    return wanted


def counted_rows_at(df: DataFrame, ordering: Ordering, ranks_of) -> Points:
    """The places of the rows of `df` with certain (1-based) ranks, by way of counts per value.

    The values and their counts are put in order, then the rows of the few values that hold
    such a rank: `df` is read twice, and never stored as a whole.  Runs jobs; the driver sees
    one count per range and one row per rank.
    """
    rows = df.select(F.col(ordering.value).alias("value"), F.col(ordering.key).alias("key"))
    inner = Ordering("value", "key", ordering.descending)
    values = Ordering("value", "value", ordering.descending)
    schema = rows.select(inner.place().alias("p")).schema["p"].dataType.simpleString()
    counts = ranged(rows.groupBy("value").agg(F.count(F.lit(1)).alias("rows")), values)
    wanted = _homes(counts.groupBy("range").agg(F.sum("rows").alias("rows")), ranks_of)
    if not wanted:
        return Points(ordering, [], schema)
    upwards = Window.partitionBy("range").orderBy(*values.sort_columns()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = F.col("last") - F.col("rows")
    holds = reduce(Column.__or__, [
        (F.col("range") == home) & (before < rank) & (F.col("last") >= rank)
        for home, rank in wanted
    ])
    held = counts.where(F.col("range").isin(*{home for home, _ in wanted})).withColumn(
        "last", F.sum("rows").over(upwards)
    ).where(holds).select(
        "range", "rows", "last",
        F.to_json(inner.value_place(), {"ignoreNullFields": "false"}).alias("place"),
    ).collect()
    held.sort(key=lambda r: (r["range"], r["last"]))
    ranks, passed = [], 0
    for r in held:
        ranks += [passed + rank - (r["last"] - r["rows"]) for home, rank in wanted
                  if home == r["range"] and r["last"] - r["rows"] < rank <= r["last"]]
        passed += r["rows"]
    value_schema = rows.select(inner.value_place().alias("p")).schema["p"].dataType.simpleString()
    is_held = reduce(Column.__or__, [
        inner.value_place() == F.from_json(F.lit(r["place"]), value_schema) for r in held
    ])
    found = rows_at(ranged(rows.where(is_held), inner), inner, lambda _: ranks)
    return Points(ordering, found.places, schema)


def sum_of_first(df: DataFrame, value: str, rows: int) -> DataFrame:
    """The sum of the `rows` largest values (NULLs last) as one row with column `value`.

    From how many rows each value has, so that ties need no order.  Runs a job.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = rank_and_running_sum(counts, Ordering(value, value, descending=True), "_rows")
    before = F.col("running_sum") - F.col("_rows")
    taken = F.least(F.col("_rows"), F.lit(rows) - before)
    return ranked.where(before < rows).agg(F.sum(F.col(value) * taken).alias(value))


def first_rows(df: DataFrame, ordering: Ordering, rows: int) -> DataFrame:
    """The first `rows` rows of `df` in the order, without one task that merges them.

    Rows before the one at which the rest starts; ties are broken by the key.  Runs jobs.
    """
    columns = list(dict.fromkeys([ordering.value, ordering.key]))
    rest = rows_at(
        ranged(df.select(*columns), ordering), ordering,
        lambda total: [rows + 1] if rows < total else [],
    )
    return df.where(rest.passed() == 0)


def ntile(df: DataFrame, tiles: int, ordering: Ordering) -> Column:
    """NTILE(tiles) OVER (ORDER BY ...) over the whole of `df`, as a column of `df`.

    The first `rows % tiles` tiles get one row more than the others.  Runs jobs.
    """

    def starts(rows: int) -> list[int]:
        size, larger = divmod(rows, tiles)
        firsts = [t * size + min(t, larger) + 1 for t in range(1, tiles)]
        return [first for first in firsts if first <= rows]

    return counted_rows_at(df, ordering, starts).passed() + 1


def rank_and_running_sum(df: DataFrame, ordering: Ordering, summed: str) -> DataFrame:
    """`df` with rank, running_sum, total_rows and total_sum over the whole table.

    `summed` must be a whole number (cents), so that sums do not depend on the
    order of addition.  A NULL adds nothing.  Runs a job.
    """
    stored = ranged(df, ordering)
    # One row per range.
    joined = stored.join(F.broadcast(_range_offsets(stored, summed)), "range")
    local = Window.partitionBy("range").orderBy(*ordering.sort_columns())
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here, earlier = F.sum(summed).over(running), F.col("sum_before")
    return (
        joined.withColumn("rank", F.row_number().over(local) + F.col("rows_before"))
        .withColumn("running_sum", F.coalesce(here + earlier, here, earlier))
        .drop("range", "rows_before", "sum_before")
    )


def _range_offsets(stored: DataFrame, summed: str) -> DataFrame:
    """What lies before each range, and the totals: one row per range.

    The windows are over these rows only.
    """
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        stored.groupBy("range")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(summed).alias("s"))
        .select(
            "range",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
            F.sum("s").over(before).alias("sum_before"),
            F.sum("n").over(everything).alias("total_rows"),
            F.sum("s").over(everything).alias("total_sum"),
        )
    )
