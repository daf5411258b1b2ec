"""Hand-made warehouse rows for edge-case tests (no parquet involved)."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import SparkSession

from partnerkpi.context import KpiContext
from partnerkpi.params import FIXTURE_PARAMS, ReportParams
from partnerkpi.sources.catalog import Warehouse
from partnerkpi.sources.schema import (
    DIM_PROVIDER,
    FACT_ORDER,
    MONTHLY_RATES,
    PROVIDER_MONTHLY,
    PROVIDER_WEEKLY,
    RESOLUTION,
    WEEKLY_RATES,
)

PARAMS = FIXTURE_PARAMS.with_(min_month_orders=1)


def provider(pid, name=None, city="C1", country="xa", group="P0", grocery=True):
    return {"provider_id": pid, "provider_name": name or f"S{pid}", "city_name": city, "country_code": country,
            "group_name": group, "is_grocery": grocery}


def order(oid, pid, d, state="delivered", user=None, city="C1", name=None, gross="10.00", gmv="9.00",
          gmv_eur="0.18", refunded="0.00", discount="1.00", first=False, honey=False, bad=False, late=False,
          late_pickup=False, minutes=30.0, courier=20.0, **spend):
    row = {"order_id": oid, "provider_id": pid, "provider_name": name or f"S{pid}", "city_name": city,
           "user_id": user if user is not None else oid, "order_date": d, "order_state": state,
           "gross": _dec(gross), "gmv": _dec(gmv), "gmv_eur": _dec(gmv_eur), "refunded": _dec(refunded),
           "discount": _dec(discount), "is_first": first, "is_honey": honey, "is_bad": bad, "is_late": late,
           "is_late_pickup": late_pickup, "delivery_minutes": minutes, "courier_minutes": courier}
    for f in FACT_ORDER.fields:
        if f.name.startswith(("platform_spend_", "merchant_spend_")):
            row[f.name] = _dec(spend.get(f.name))
    return row


def monthly(pid, ts, delivered=10, **pairs):
    row = {"provider_id": pid, "ts": ts, "delivered_orders": delivered}
    for r in MONTHLY_RATES:
        v, w = pairs.get(r, (0.5, 10))
        row[f"{r}_value"], row[f"{r}_weight"] = v, w
    return row


def weekly(pid, ts, **pairs):
    row = {"provider_id": pid, "ts": ts}
    for r in WEEKLY_RATES:
        v, w = pairs.get(r, (0.5, 10))
        row[f"{r}_value"], row[f"{r}_weight"] = v, w
    return row


def _dec(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.0001"))


def warehouse(spark: SparkSession, providers, orders=(), monthly_rows=(), weekly_rows=(), resolutions=()):
    def df(rows, schema):
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    return Warehouse.from_frames(
        fact_order=df(orders, FACT_ORDER),
        dim_provider=df(providers, DIM_PROVIDER),
        provider_monthly=df(monthly_rows, PROVIDER_MONTHLY),
        provider_weekly=df(weekly_rows, PROVIDER_WEEKLY),
        resolution=df([{"order_id": o, "reason": r, "actor_type": a} for o, r, a in resolutions], RESOLUTION),
    )


def ctx(spark, wh, params: ReportParams = PARAMS, staging: bool = False) -> KpiContext:
    return KpiContext(spark, wh, params, staging)


def d(s: str) -> date:
    return date.fromisoformat(s)


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)
