"""Exact medians without one task that holds all values.

Spark's ``median`` keeps a value -> count map of the whole group in one buffer: fine for rates of two decimals, not for a
column with a value of its own in nearly every row. Here the middle is selected in three passes over the rows:

1. a sketch of bounded size gives, for each column, two cuts a little below and above its middle;
2. the rows up to each cut are counted exactly, which tells the stretch (below, between or above the cuts) that holds the
   middle ranks;
3. only the values of that stretch, as a rule the share ``2 / slices`` between the cuts, are counted by value (map-side
   first, so a value that a third of the rows share is one row), sorted, and read off by running counts.

The sketch decides only how short the stretch is; ranks come from exact counts, so any cuts give the exact median.

Defined results: nulls are left out; a column without values has a null median; a key without any value keeps its row; keys
may be null; NaN is the largest value, and zero has no sign; no rows at all give one row of nulls without keys, no row with keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The cuts are at shares 1/2 - 1/slices and 1/2 + 1/slices of the rows.
SLICES = 256


def exact_medians(rows: DataFrame, columns: list[str], keys: tuple[str, ...] = (), slices: int = SLICES) -> DataFrame:
    """The median (mean of the middle two) of each column as a double, for each value of ``keys`` or over all rows."""
    # keys as one struct: null keys match each other in joins
    group = F.struct(*[F.col(k) for k in keys] or [F.lit(0).alias("all")]).alias("g")
    values = rows.select(group, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    ids = range(len(columns))

    def each(df: DataFrame) -> DataFrame:
        return df if keys else F.broadcast(df)  # without keys one row

    shares = [0.5 - 1 / slices, 0.5 + 1 / slices]
    cuts = values.groupBy("g").agg(*[F.percentile_approx(f"v{i}", shares, 8 * slices).alias(f"c{i}") for i in ids])
    counted = values.join(each(cuts), "g").groupBy("g").agg(
        *[
            F.struct(
                F.first(f"c{i}").alias("cuts"),
                F.count(f"v{i}").alias("n"),
                F.count_if(F.col(f"v{i}") <= F.col(f"c{i}")[0]).alias("low"),
                F.count_if(F.col(f"v{i}") <= F.col(f"c{i}")[1]).alias("high"),
            ).alias(f"s{i}")
            for i in ids
        ]
    )

    def stretch(rank: Column, s: Column) -> Column:
        """0, 1 or 2: below, between or above the cuts."""
        return (rank >= s["low"]).cast("int") + (rank >= s["high"]).cast("int")

    def place(i: int) -> Column:
        """The middle ranks of a column, the stretches that hold them and the number of rows before those."""
        s = F.col(f"s{i}")
        first, second = F.floor((s["n"] - 1) / 2), F.floor(s["n"] / 2)
        start = stretch(first, s)
        before = F.when(start == 0, 0).when(start == 1, s["low"]).otherwise(s["high"])
        return F.struct(
            s["cuts"].alias("cuts"), first.alias("first"), second.alias("second"), start.alias("start"),
            stretch(second, s).alias("end"), before.cast("long").alias("before"),
        ).alias(f"p{i}")

    places = counted.select("g", *[place(i) for i in ids])

    def cell(i: int) -> Column:
        v, p = F.col(f"v{i}"), F.col(f"p{i}")
        at = (v > p["cuts"][0]).cast("int") + (v > p["cuts"][1]).cast("int")
        return F.when(
            at.between(p["start"], p["end"]),
            F.struct(F.lit(i).alias("c"), v.alias("value"), p["first"].alias("first"), p["second"].alias("second"), p["before"].alias("before")),
        )

    near = values.join(each(places), "g").select("g", F.explode(F.array_compact(F.array(*[cell(i) for i in ids]))).alias("cell"))
    by_value = near.select("g", "cell.*").groupBy("g", "c", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(x).alias(x) for x in ("first", "second", "before")]
    )
    upto = Window.partitionBy("g", "c").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("before") + F.sum("n").over(upto)
    ranked = by_value.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))

    def value_at(i: int, rank: str) -> Column:
        return F.max(F.when((F.col("c") == i) & (F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end")), F.col("value")))

    wide = [(value_at(i, "first") * 0.5 + value_at(i, "second") * 0.5).alias(c) for i, c in enumerate(columns)]
    if not keys:
        return ranked.agg(*wide)
    every_key = places.select("g", *[F.lit(None).cast(ranked.schema[x].dataType).alias(x) for x in ranked.columns if x != "g"])
    return ranked.unionByName(every_key).groupBy("g").agg(*wide).select(*[F.col(f"g.{k}").alias(k) for k in keys], *columns)
