"""Day states: mergeable partial results from which both reports are folded for all partners.

A state is an aggregate of the inputs that holds enough to be summed further, by day or week:

* ``provider_days``: per provider, its names on the orders, and day, all additive measures (money as exact decimals);
* ``user_days``: per partner, peer flag, city, day and bucket of user ids, bitmaps of the users with a delivered order and of
  those with their first one - exact distinct counts that merge by OR (ids are non-negative; the bitmap of a bucket covers
  32,768 ids in 4 KB, so ids should be dense);
* ``reason_days``: per provider, day, reason and actor, resolution rows of non-delivered orders;
* ``provider_names``: per provider and week, the MAX city and name.

Each is one map-side combined aggregation without DISTINCT. ``StatePartners`` folds them into the results of ``AllPartners``:
stores are counted from provider rows, users by OR and bit count, so no plan has an ``Expand`` of distinct columns. The weekly
and monthly metric tables are states of their grain already and are read as they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import KpiContext
from ..functions.calendar import MONTH, WEEK, date_between, date_half_open, month_key, week_key
from ..functions.measures import coalesce_sum, mart
from ..sources.catalog import Warehouse
from ..sources.schema import MERCHANT_SPEND, PLATFORM_SPEND
from .partners import COUNTRY, KEYS, PARTNER, AllPartners, _either
from .scope import is_delivered, not_delivered

_MONEY = ["gross", "gmv", "gmv_eur", "refunded", "discount", "platform_spend", "merchant_spend"]
_COUNTS = ["n_all", "n_delivered", "n_failed", "campaign_orders", "n_honey", "n_bad", "n_late", "n_late_pickup", "minutes_n", "courier_n"]
_SUMS = ["minutes_sum", "courier_sum"]


def week_start(c: str = "order_date") -> Column:
    return F.to_date(F.date_trunc("week", c))


def provider_days(wh: Warehouse, where: Column | None = None) -> DataFrame:
    f = wh.fact_order if where is None else wh.fact_order.where(where)
    dl = is_delivered()
    money = {**{c: F.col(c) for c in _MONEY[:5]}, "platform_spend": coalesce_sum(PLATFORM_SPEND), "merchant_spend": coalesce_sum(MERCHANT_SPEND)}
    counted = {
        "n_all": F.lit(True), "n_delivered": dl, "n_failed": not_delivered(), "campaign_orders": dl & (F.col("discount") > 0),
        "n_honey": dl & F.col("is_honey"), "n_bad": dl & F.col("is_bad"), "n_late": dl & F.col("is_late"),
        "n_late_pickup": dl & F.col("is_late_pickup"), "minutes_n": dl & F.col("delivery_minutes").isNotNull(),
        "courier_n": dl & F.col("courier_minutes").isNotNull(),
    }
    aggs = [F.sum(F.when(dl, c)).alias(n) for n, c in money.items()] + [F.count(F.when(c, 1)).alias(n) for n, c in counted.items()]
    aggs += [F.sum(F.when(dl, F.col(c))).alias(n) for n, c in zip(_SUMS, ("delivery_minutes", "courier_minutes"))]
    return f.groupBy("provider_id", "provider_name", "city_name", "order_date").agg(*aggs).withColumn("week", week_start())


def _attributes(wh: Warehouse) -> DataFrame:
    return wh.dim_provider.select("provider_id", COUNTRY, F.col("group_name").alias(PARTNER), F.coalesce("is_grocery", F.lit(False)).alias("is_grocery"))


def user_days(wh: Warehouse, where: Column | None = None) -> DataFrame:
    cond = is_delivered() & F.col("user_id").isNotNull()
    f = wh.fact_order.where(cond if where is None else where & cond).join(_attributes(wh), "provider_id")
    bit = F.bitmap_bit_position("user_id")
    keys = [*KEYS, "is_grocery", "city_name", "order_date", F.bitmap_bucket_number("user_id").alias("bucket_no")]
    # a NULL position sets no bit: only first orders are in the second bitmap
    users = F.bitmap_construct_agg(bit).alias("users")
    new = F.bitmap_construct_agg(F.when(F.col("is_first"), bit)).alias("new_users")
    return f.groupBy(*keys).agg(users, new).withColumn("week", week_start())


def reason_days(wh: Warehouse, where: Column | None = None) -> DataFrame:
    f = wh.fact_order.where(not_delivered() if where is None else where & not_delivered()).select("order_id", "provider_id", "order_date")
    rows = wh.resolution.join(f, "order_id").groupBy("provider_id", "order_date", "reason", "actor_type").agg(F.count(F.lit(1)).alias("cnt"))
    return rows.withColumn("week", week_start())


def provider_names(wh: Warehouse, where: Column | None = None) -> DataFrame:
    f = wh.fact_order if where is None else wh.fact_order.where(where)
    # the distinct triples first: a MAX over strings has no hash aggregate, its sort should see few rows
    seen = f.select("provider_id", week_start().alias("week"), "city_name", "provider_name").distinct()
    return seen.groupBy("provider_id", "week").agg(F.max("city_name").alias("city_name"), F.max("provider_name").alias("provider_name"))


STATES = {"provider_days": provider_days, "user_days": user_days, "reason_days": reason_days, "provider_names": provider_names}


def state_frames(wh: Warehouse, where: Column | None = None) -> dict[str, DataFrame]:
    """All states as plans over the inputs (``where``: a condition on ``order_date``)."""
    return {name: build(wh, where) for name, build in STATES.items()}


class StatePartners(AllPartners):
    """``AllPartners`` with the order fact replaced by its states."""

    def __init__(self, ctx: KpiContext, states: Mapping[str, DataFrame]):
        super().__init__(ctx)
        self.states = states

    def _orders(self, where: Column | None = None) -> DataFrame:
        raise TypeError("results of states do not read the order fact")

    def _days(self, inside: Column | None = None) -> DataFrame:
        days = self.states["provider_days"]
        return (days if inside is None else days.where(inside)).join(self.providers, "provider_id")

    def _merged(self, days: DataFrame, keys: list) -> DataFrame:
        """Sums of the measures by ``keys``; ``active_stores`` counts the providers with a delivered order."""
        each = days.groupBy(*keys, "provider_id").agg(*[F.sum(c).alias(c) for c in _MONEY + _COUNTS + _SUMS])
        names = [c for c in each.columns if c not in (*_MONEY, *_COUNTS, *_SUMS, "provider_id")]
        total = each.groupBy(*names).agg(
            *[F.sum(c).cast("double").alias(c) for c in _MONEY],
            *[F.sum(c).alias(c) for c in _COUNTS + _SUMS],
            F.count(F.when(F.col("n_delivered") > 0, 1)).alias("active_stores"),
        )
        return total

    @staticmethod
    def _users(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Distinct users and new users by ``keys``: OR of the bitmaps of each id bucket, then bit counts."""
        either = rows.groupBy(*keys, "bucket_no").agg(F.bitmap_or_agg("users").alias("users"), F.bitmap_or_agg("new_users").alias("new_users"))
        names = [c for c in either.columns if c not in ("bucket_no", "users", "new_users")]
        return either.groupBy(*names).agg(F.sum(F.bitmap_count("users")).alias("active_users"), F.sum(F.bitmap_count("new_users")).alias("new_users"))

    def _grain_dates(self) -> tuple[Column, Column]:
        p = self.p
        span = date_between("order_date", min(p.data_start, p.week_start), max(p.data_end, p.week_end))
        grains = self._grains(lambda s, e: date_between("order_date", s, e))
        return span, _either(grains, {MONTH: month_key("order_date"), WEEK: week_key("order_date")})

    @cached_property
    def orders_mart(self) -> DataFrame:
        def build() -> DataFrame:
            span, g = self._grain_dates()
            period = [*KEYS, "g.grain", "g.period"]
            orders = self._merged(self._days(span).withColumn("g", g), period)
            known = F.col(COUNTRY).isNotNull() & F.col(PARTNER).isNotNull()
            users = self._users(self.states["user_days"].where(span & known).withColumn("g", g), period)
            names = [*KEYS, "grain", "period"]
            return orders.join(users.withColumnRenamed("new_users", "users_activated"), names, "left").fillna(0, ["active_users", "users_activated"])

        return self.ctx.stage("st_orders", build)

    def failed_reasons(self) -> DataFrame:
        span, g = self._grain_dates()
        rows = self.states["reason_days"].where(span).join(self.providers, "provider_id").withColumn("g", g)
        return rows.groupBy(*KEYS, "g.grain", "g.period", "reason", "actor_type").agg(F.sum("cnt").alias("cnt"))

    def top_stores_last_month(self) -> DataFrame:
        days = self._days(date_half_open("order_date", self.p.prev_month_start, self.p.prev_month_end_excl)).where("n_delivered > 0")
        stores = days.groupBy(*KEYS, "provider_name", "city_name").agg(
            F.sum("n_delivered").alias("orders"), mart(F.sum("gross").cast("double")).alias("merchant_price")
        )
        place = Window.partitionBy(*KEYS).orderBy(F.desc("merchant_price"), "provider_name", "city_name")
        return stores.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= self.p.top_stores).drop("_n")

    @cached_property
    def city_map(self) -> DataFrame:
        def build() -> DataFrame:
            names = self.states["provider_names"].groupBy("provider_id").agg(
                F.max("city_name").alias("city_name"), F.max("provider_name").alias("provider_name"), F.count(F.lit(1)).alias("n_variants")
            )
            return self.providers.join(names, "provider_id").select(*KEYS, "provider_id", "city_name", "provider_name", "n_variants")

        return self.ctx.stage("st_city_map", build)

    def city_orders_rank(self) -> DataFrame:
        days = self._days(date_between("order_date", self.p.bench_start, self.p.bench_end)).where("n_delivered > 0")
        return days.groupBy(*KEYS, F.col("city_name").alias("city")).agg(F.sum("n_delivered").alias("orders"))

    @staticmethod
    def _business_columns() -> list[Column]:
        count = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("active_users", "new_users")]
        return [F.col("n_delivered").alias("orders"), mart("gmv_eur").alias("gmv_eur"), *count, F.col("active_stores").alias("merchants")]

    @cached_property
    def business(self) -> DataFrame:
        def build() -> DataFrame:
            span = date_between("order_date", self.p.scorecard_start, self.p.scorecard_end)
            cell = [*KEYS, "bucket", "month"]
            month = month_key("order_date")
            orders = self._merged(self._bucketed(self._days(span).withColumn("month", month), "city_name"), cell).where("n_delivered > 0")
            users = self._users(self._bucketed(self.states["user_days"].where(span).withColumn("month", month), "city_name"), cell)
            return orders.join(users, cell, "left").select(*cell, *self._business_columns())

        return self.ctx.stage("st_business", build)

    @cached_property
    def bench_business(self) -> DataFrame:
        def build() -> DataFrame:
            span = date_between("order_date", self.p.bench_start, self.p.bench_end)
            orders = self._merged(self.states["provider_days"].where(span).join(self._peers, "provider_id"), [COUNTRY])
            users = self._users(self.states["user_days"].where(span & F.col("is_grocery")), [COUNTRY])
            found = orders.join(users, COUNTRY, "left").select(COUNTRY, *self._business_columns())
            every = self.partners.select(COUNTRY).distinct().join(found, COUNTRY, "left")
            return every.fillna(0, ["orders", "active_users", "new_users", "merchants"])

        return self.ctx.stage("st_bench_business", build)


#: Results that the states change; all others are as in ``AllPartners``, over these.
FROM_STATES = (
    "financial", "operational", "failed_orders", "campaigns", "failed_reasons", "top_stores_last_month", "provider_city_map",
    "city_orders_rank", "city_bucket", "business_by_bucket_month", "benchmark_business",
)
