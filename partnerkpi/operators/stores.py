"""Store detail and store scoring: per-store quality over the benchmark window, network medians, flag counts,
severity tiers, worst stores, per-cell classes and per-bucket ranking.

The per-store table has one row per (store name, city) of the partner. Medians use Spark's exact ``median``
(``percentile(0.5)``), whose aggregation buffer holds value->count pairs: the store values are rounded to 2 dp, so the
buffer is bounded by the value domain, not by the number of stores; where ``orders`` has too many values for that,
``distributed_medians`` selects them by slices (``medians.py``). The one-row median struct is attached to the
store rows as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import KpiContext
from ..functions.calendar import ts_half_open
from ..functions.measures import finish_pair, mart, round_half_up
from .buckets import bucketize, city_bucket
from .medians import exact_medians
from .scope import partner_weekly
from .scorecard import Scorecard, _sc, good_or_bad

# Store columns (key, direction, display format); direction 0 = not scored.
STORE_COLS = [
    ("orders", 0, "int"),
    ("dur", -1, "min"),
    ("late", -1, "pct"),
    ("lateprep", -1, "pct"),
    ("failed", -1, "pct"),
    ("bad", -1, "pct"),
    ("replacement", -1, "pct"),
    ("cs", -1, "pct"),
    ("compl", 1, "pct"),
    ("rating", 1, "dec"),
]
STORE_KEYS = [c[0] for c in STORE_COLS]
DIRECTED = [(k, d) for k, d, _ in STORE_COLS if d != 0]

# store rate column <- (monthly rate, in %)
_STORE_RATES = [
    ("dur", "minutes", False),
    ("late", "late", True),
    ("lateprep", "prep", True),
    ("failed", "failed", True),
    ("bad", "bad", True),
    ("cs", "ticket", True),
    ("compl", "completion", True),
    ("rating", "rating", False),
]


def _bench_window(ctx: KpiContext) -> Column:
    p = ctx.params
    return ts_half_open("ts", p.bench_start.replace(day=1), p.bench_end_excl)


def store_quality(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q27: per store (name, city): delivered orders and nine weighted rates over the benchmark months.

    The weekly adjustment rate is pre-aggregated per provider (and scoped to the partner first) before the left
    join, which keeps the grain right; stores with no delivered order are dropped after aggregation.
    """
    return _store_quality_part(ctx, sc).orderBy(F.desc("orders"), "addr", "city")


def _store_quality_part(ctx: KpiContext, sc: Scorecard | None) -> DataFrame:
    return ctx.stage("st_quality", lambda: _store_quality(ctx, _sc(ctx, sc)))


def _store_quality(ctx: KpiContext, sc: Scorecard) -> DataFrame:
    cm = sc.city_map  # one row per partner provider
    adj = (
        partner_weekly(ctx, _bench_window(ctx))
        .groupBy("provider_id")
        .agg(finish_pair(F.sum(F.col("adjustment_value") * F.col("adjustment_weight")),
                         F.sum("adjustment_weight"), pct=True).alias("replacement"))
    )
    rows = ctx.wh.provider_monthly.where(_bench_window(ctx)).join(cm, "provider_id").join(adj, "provider_id", "left")
    return (
        rows.groupBy(F.col("provider_name").alias("addr"), F.col("city_name").alias("city"))
        .agg(*store_measures())
        .where(F.col("orders") > 0)
        .select("addr", "city", *STORE_KEYS)
    )


def store_measures() -> list[Column]:
    """Orders and the nine rates of a store, as aggregates over its monthly rows."""
    aggs = [F.sum("delivered_orders").cast("long").alias("orders")]
    for key, rate, pct in _STORE_RATES:
        aggs.append(
            mart(finish_pair(F.sum(F.col(f"{rate}_value") * F.col(f"{rate}_weight")), F.sum(f"{rate}_weight"), pct))
            .alias(key)
        )
    aggs.append(mart(F.max("replacement")).alias("replacement"))
    return aggs


def store_bucketed(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q36: store rows with their bucket; numeric columns rounded to 2 dp when not NULL."""
    sc = _sc(ctx, sc)

    def build() -> DataFrame:
        s = bucketize(ctx, _store_quality_part(ctx, sc), "city", sc.top)
        return s.select(
            "addr", "city", "bucket", "orders", *[round_half_up(k, 2).alias(k) for k in STORE_KEYS if k != "orders"]
        )

    return ctx.stage("st_bucketed", build)


def store_medians(ctx: KpiContext, stores: DataFrame | None = None) -> DataFrame:
    """Q37: exact median of each store column over non-NULL values (mean of the middle two when even)."""
    if stores is None:
        return ctx.stage("st_medians", lambda: store_medians(ctx, store_bucketed(ctx)))
    return medians_of(ctx, stores)


def medians_of(ctx: KpiContext, stores: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The medians of the store columns, by the run's way of taking medians."""
    if ctx.params.distributed_medians:
        return exact_medians(stores, STORE_KEYS, keys).select(*keys, *[mart(F.col(k)).alias(k) for k in STORE_KEYS])
    exact = [mart(F.median(F.col(k).cast("double"))).alias(k) for k in STORE_KEYS]
    return stores.groupBy(*keys).agg(*exact) if keys else stores.agg(*exact)


def _with_medians(ctx: KpiContext, stores: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Attach the network medians to every store row: one scalar subquery (a one-row struct), no join."""
    med = (store_medians(ctx, stores) if medians is None else medians).select(F.struct(*[F.col(k).alias(f"med_{k}") for k in STORE_KEYS])).scalar()
    return stores.withColumn("_med", med).select("*", "_med.*").drop("_med")


def _worse(value: Column, ref: Column, direction: int) -> Column:
    return value < ref if direction == 1 else value > ref


def store_flags(ctx: KpiContext, stores: DataFrame | None = None) -> DataFrame:
    """Q38: number of directed metrics strictly worse than the network median; NULL never counts."""
    if stores is None:
        return ctx.stage("st_flags", lambda: _store_flags(ctx, store_bucketed(ctx), store_medians(ctx)))
    return _store_flags(ctx, stores, None)


def _store_flags(ctx: KpiContext, stores: DataFrame, medians: DataFrame | None) -> DataFrame:
    j = _with_medians(ctx, stores, medians)
    return j.select("addr", "city", "bucket", *STORE_KEYS, flag_count().alias("flags"))


def flag_count() -> Column:
    """Directed columns strictly worse than their median, from a row with both."""
    flags = None
    for k, d in DIRECTED:
        term = F.when(_worse(F.col(k), F.col(f"med_{k}"), d), 1).otherwise(0)
        flags = term if flags is None else flags + term
    return flags.cast("long")


def worst_stores(ctx: KpiContext, flags: DataFrame | None = None) -> DataFrame:
    """Q39: top N by flags, then late (NULL as 0); later ties by orders, name, city."""
    return (
        (store_flags(ctx) if flags is None else flags)
        .orderBy(F.desc("flags"), F.desc(F.coalesce(F.col("late"), F.lit(0.0))), F.desc("orders"), "addr", "city")
        .limit(ctx.params.worst_stores)
    )


def severity(ctx: KpiContext, flags: Column) -> Column:
    hi, mid = ctx.params.severity_cuts(len(DIRECTED))
    return F.when(flags >= hi, 2).when(flags >= mid, 1).otherwise(0).cast("long")


def store_severity(ctx: KpiContext) -> DataFrame:
    """Q40: tier 2 at >= ceil(0.6 n) flags, 1 at >= ceil(0.35 n), else 0 (n = 9 directed metrics)."""
    f = store_flags(ctx)
    return f.select("addr", "city", "bucket", "flags", severity(ctx, F.col("flags")).alias("severity"))


def store_cell_class(ctx: KpiContext) -> DataFrame:
    """Q41: per store and column, good/bad against the network median (ties are good); NULL when undefined."""
    s = store_bucketed(ctx)
    return cell_classes(_with_medians(ctx, s, store_medians(ctx)))


def cell_classes(stores: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per store and column, from store rows with their medians."""
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).cast("long").alias("col_ord"), F.lit(k).alias("col_key"), F.lit(d).alias("dir"),
                    F.col(k).cast("double").alias("value"), F.col(f"med_{k}").alias("median"),
                )
                for i, (k, d, _) in enumerate(STORE_COLS, start=1)
            ]
        )
    ).alias("c")
    long_df = stores.select(*keys, "addr", "city", "bucket", cells).select(*keys, "addr", "city", "bucket", "c.*")
    cls = good_or_bad(F.col("value"), F.col("median"), F.col("dir"))
    return long_df.select(*keys, "addr", "city", "bucket", "col_ord", "col_key", "value", "median", cls.alias("cell_class"))


#: Rows sampled to cut the stores into slices for ranking.
RANK_SLICES = 255


def store_ranked(ctx: KpiContext, sort_key: str = "flags", descending: bool = True, slices: int = RANK_SLICES) -> DataFrame:
    """Q42: stores ranked inside each bucket by one column; NULLs last in both directions.

    Ties keep the store list order (orders desc, then name, city), as a stable sort of that list would. A bucket may hold
    almost all stores, so none is ranked in one task: the whole order is one struct, a uniform sample of at most
    ``slices`` of its values (those of least hash) cuts each bucket into slices, rows are numbered within their slice, and
    the slices' counts - one row each - give the offsets.
    """
    return ranked(store_flags(ctx), sort_key, descending, slices)


def ranked(stores: DataFrame, sort_key: str = "flags", descending: bool = True, slices: int = RANK_SLICES, keys: tuple[str, ...] = ()) -> DataFrame:
    """``store_ranked`` of the given store rows, within each value of ``keys`` and each bucket."""
    f = stores
    value = F.col(sort_key).cast("double")
    place = F.struct(
        *keys,
        F.col("bucket"),
        value.isNull().alias("none"),
        F.coalesce(-value if descending else value, F.lit(0.0)).alias("value"),
        (-F.coalesce(F.col("orders"), F.lit(-(1 << 62)))).alias("orders"),
        F.col("addr"),
        F.col("city"),
    )
    rows = f.select(*keys, "bucket", "addr", "city", "orders", "flags", place.alias("place"))
    sample = rows.select("place", F.xxhash64(*keys, "addr", "city").alias("h")).orderBy("h", "place").limit(slices)
    cuts = sample.select(F.sort_array(F.collect_list("place"))).scalar()
    sliced = rows.withColumn("_cuts", cuts).withColumn(
        "slice", F.size(F.filter("_cuts", lambda c: c < F.col("place"))).cast("int")
    ).drop("_cuts")
    counts = sliced.groupBy(*keys, "bucket", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys, "bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy(*keys, "bucket", "slice").orderBy("place"))
    return (
        sliced.withColumn("nth", inside)
        .join(F.broadcast(offsets) if not keys else offsets, [*keys, "bucket", "slice"])  # at most slices + buckets rows a key
        .select(*keys, "bucket", (F.col("offset") + F.col("nth")).cast("long").alias("store_rank"), "addr", "city", "orders", "flags")
        .orderBy(*keys, "bucket", "store_rank")
    )


def bucket_store_counts(ctx: KpiContext) -> DataFrame:
    """Q43: stores per bucket, buckets by rank; buckets without stores do not appear."""
    counts = store_bucketed(ctx).groupBy("bucket").agg(F.count(F.lit(1)).alias("stores"))
    rank = F.broadcast(city_bucket(ctx))  # top_cities + 1 rows
    return counts.join(rank, "bucket").select("bucket_ord", "bucket", "stores").orderBy("bucket_ord")


def store_table(ctx: KpiContext) -> DataFrame:
    """Every store with its bucket, its ten numbers, flags and severity."""
    f = store_flags(ctx)
    return f.select("addr", "city", "bucket", *STORE_KEYS, "flags", severity(ctx, F.col("flags")).alias("severity"))


def store_columns(ctx: KpiContext) -> DataFrame:
    """The store columns: place, key, direction and display format."""
    rows = [
        F.struct(F.lit(i).cast("long").alias("col_ord"), F.lit(k).alias("col_key"), F.lit(d).cast("long").alias("dir"), F.lit(m).alias("fmt"))
        for i, (k, d, m) in enumerate(STORE_COLS, start=1)
    ]
    return ctx.spark.range(1).select(F.inline(F.array(*rows)))
