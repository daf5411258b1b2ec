"""Schemas of the five warehouse inputs of the partner-KPI workload, and a load-time assertion.

Column types are the ones the workload's queries need: money as DECIMAL (summed exactly), booleans as flags,
dates as DATE, metric stamps as local wall-clock TIMESTAMP_NTZ, rates as (double value, long weight) pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPEND_KINDS = ["am", "liquidity", "marketing", "user_lifecycle", "merchant_lifecycle", "other"]
PLATFORM_SPEND = [f"platform_spend_{k}" for k in SPEND_KINDS]
MERCHANT_SPEND = [f"merchant_spend_{k}" for k in SPEND_KINDS]

MONTHLY_RATES = ["minutes", "late", "prep", "failed", "bad", "ticket", "completion", "rating", "active"]
WEEKLY_RATES = ["adjustment", "replacement", "acceptance", "rating", "active"]

# kinds of columns, checked loosely: decimals of any precision/scale are accepted for money
DECIMAL = "decimal"


def _f(name: str, t) -> T.StructField:
    return T.StructField(name, t if not isinstance(t, str) else T.DecimalType(38, 4), True)


FACT_ORDER = T.StructType(
    [
        _f("order_id", T.LongType()),
        _f("provider_id", T.LongType()),
        _f("provider_name", T.StringType()),
        _f("city_name", T.StringType()),
        _f("user_id", T.LongType()),
        _f("order_date", T.DateType()),
        _f("order_state", T.StringType()),
        _f("gross", DECIMAL),
        _f("gmv", DECIMAL),
        _f("gmv_eur", DECIMAL),
        _f("refunded", DECIMAL),
        _f("discount", DECIMAL),
        _f("is_first", T.BooleanType()),
        _f("is_honey", T.BooleanType()),
        _f("is_bad", T.BooleanType()),
        _f("is_late", T.BooleanType()),
        _f("is_late_pickup", T.BooleanType()),
        _f("delivery_minutes", T.DoubleType()),
        _f("courier_minutes", T.DoubleType()),
    ]
    + [_f(c, DECIMAL) for c in PLATFORM_SPEND + MERCHANT_SPEND]
)

DIM_PROVIDER = T.StructType(
    [
        _f("provider_id", T.LongType()),
        _f("provider_name", T.StringType()),
        _f("city_name", T.StringType()),
        _f("country_code", T.StringType()),
        _f("group_name", T.StringType()),
        _f("is_grocery", T.BooleanType()),
    ]
)


def _pairs(names: list[str]) -> list[T.StructField]:
    out = []
    for n in names:
        out += [_f(f"{n}_value", T.DoubleType()), _f(f"{n}_weight", T.LongType())]
    return out


PROVIDER_MONTHLY = T.StructType(
    [_f("provider_id", T.LongType()), _f("ts", T.TimestampNTZType()), _f("delivered_orders", T.LongType())]
    + _pairs(MONTHLY_RATES)
)
PROVIDER_WEEKLY = T.StructType([_f("provider_id", T.LongType()), _f("ts", T.TimestampNTZType())] + _pairs(WEEKLY_RATES))
RESOLUTION = T.StructType(
    [_f("order_id", T.LongType()), _f("reason", T.StringType()), _f("actor_type", T.StringType())]
)

SCHEMAS = {
    "fact_order": FACT_ORDER,
    "dim_provider": DIM_PROVIDER,
    "provider_monthly": PROVIDER_MONTHLY,
    "provider_weekly": PROVIDER_WEEKLY,
    "resolution": RESOLUTION,
}


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Check that every required column exists with a compatible type; extra columns are allowed."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        t = have.get(f.name)
        if t is None:
            problems.append(f"missing {f.name}")
        elif isinstance(f.dataType, T.DecimalType):
            if not isinstance(t, T.NumericType):
                problems.append(f"{f.name}: {t.simpleString()} is not numeric money")
        elif isinstance(f.dataType, T.TimestampNTZType):
            if not isinstance(t, (T.TimestampNTZType, T.TimestampType)):
                problems.append(f"{f.name}: {t.simpleString()} is not a timestamp")
        elif isinstance(f.dataType, (T.LongType, T.DoubleType)):
            if not isinstance(t, T.NumericType):
                problems.append(f"{f.name}: {t.simpleString()} is not numeric")
        elif type(t) is not type(f.dataType):
            problems.append(f"{f.name}: {t.simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast where the given numeric or timestamp type is not the one that the workload computes with.

    Rates become double, keys, counts and weights long (whole numbers; a fractional weight stays double), money keeps its
    exact type or becomes double.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for f in schema.fields:
        t, want = have[f.name], f.dataType
        if isinstance(want, T.DecimalType) or type(t) is type(want):
            continue
        if isinstance(want, T.LongType) and f.name.endswith("_weight") and isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            want = T.DoubleType() if not (isinstance(t, T.DecimalType) and t.scale == 0) else want
        if isinstance(want, (T.LongType, T.DoubleType, T.TimestampNTZType)):
            changed[f.name] = df[f.name].cast(want)
    return df.withColumns(changed) if changed else df
