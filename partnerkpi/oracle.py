"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each statement sees only the raw test tables (``orders lineitem supplier nation``), so it inlines the mapping to the
five warehouse inputs as CTEs, then computes the query in plain SQL. Rounding uses the same decimal half-up helper
as the Spark side; integer aggregates are cast to BIGINT (DuckDB's SUM of integers is HUGEINT).
"""

from __future__ import annotations

from .params import FIXTURE_PARAMS, ReportParams

# Fixed values, written out here apart from the operators that they check (survey 2.9): the metric catalogue (order, key,
# group, direction, format) and the store columns (key, direction).
METRICS = [
    (1, "GMV", "scale", 1, "eur"),
    (2, "Orders", "scale", 1, "int"),
    (3, "Active Users", "scale", 1, "int"),
    (4, "New Users", "scale", 1, "int"),
    (5, "Frequency", "scale", 1, "dec"),
    (6, "Active Merchants", "scale", 1, "int"),
    (7, "AOV", "unit", 1, "eur"),
    (8, "GMV per Merchant", "unit", 1, "eur"),
    (9, "Orders per Merchant", "unit", 1, "int"),
    (10, "Availability", "availability", 1, "pct"),
    (11, "Total Delivery Time", "quality", -1, "min"),
    (12, "Late Delivery 10+", "quality", -1, "pct"),
    (13, "Late Prep 10+", "quality", -1, "pct"),
    (14, "Failed", "quality", -1, "pct"),
    (15, "Bad Order Rate", "quality", -1, "pct"),
    (16, "Replacement", "quality", -1, "pct"),
    (17, "CS Ticket", "quality", -1, "pct"),
    (18, "Completion", "quality", 1, "pct"),
    (19, "Rating", "quality", 1, "dec"),
]
STORE_COLS = [
    ("orders", 0),
    ("dur", -1),
    ("late", -1),
    ("lateprep", -1),
    ("failed", -1),
    ("bad", -1),
    ("replacement", -1),
    ("cs", -1),
    ("compl", 1),
    ("rating", 1),
]
# Of nine directed store columns: severity 2 from ceil(0.6 * 9) = 6 flags, 1 from ceil(0.35 * 9) = 4.
SEVERITY_CUTS = (6, 4)


def rhu(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def mart(x: str) -> str:
    return rhu(x, 6)


def sdiv(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def ts(x) -> str:
    return f"TIMESTAMP '{x.isoformat()}'"


def w2(rate: str, pct: bool) -> str:
    r = sdiv(f"SUM({rate}_value * {rate}_weight)", f"SUM({rate}_weight)")
    return f"{r} * 100" if pct else r


_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_DISC = "CAST(l_discount AS DECIMAL(4,2))"
_RATES = ["minutes", "late", "prep", "failed", "bad", "ticket", "completion", "rating", "active"]
_SPEND = [("am", 1), ("liquidity", 2), ("marketing", 3), ("user_lifecycle", 4), ("merchant_lifecycle", 5)]

MAPPING = f"""
dim_provider AS (
  SELECT s.s_suppkey AS provider_id, s.s_name AS provider_name, n.n_name AS city_name,
         CASE WHEN n.n_regionkey < 3 THEN 'xa' ELSE 'xb' END AS country_code,
         CASE WHEN s.s_suppkey % 2 = 0 THEN 'P0' ELSE 'P1' END AS group_name,
         (s.s_suppkey % 3 <> 0) AS is_grocery
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
order_lines AS (
  SELECT l_orderkey,
         arg_min(l_suppkey, l_linenumber * 1000000 + l_suppkey) AS provider_id,
         SUM({_PRICE}) AS gross,
         SUM({_PRICE} * (1 - {_DISC})) AS net,
         SUM({_PRICE} * {_DISC}) AS incent,
         SUM(CASE WHEN l_returnflag = 'R' THEN {_PRICE} * (1 - {_DISC}) ELSE 0 END) AS refunded,
         MIN(l_shipdate) AS ship,
         COUNT(*) AS n_lines,
         COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) AS n_adj,
         COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_rep
  FROM lineitem GROUP BY l_orderkey
),
first_orders AS (
  SELECT o_custkey AS f_custkey, year(o_orderdate) AS f_year, MIN(o_orderdate) AS first_orderdate
  FROM orders GROUP BY o_custkey, year(o_orderdate)
),
fact_base AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority, ol.*, p.provider_name,
         p.city_name, fo.first_orderdate,
         abs(CAST(ol.ship AS DATE) - CAST(o.o_orderdate AS DATE)) AS dd
  FROM orders o
  JOIN order_lines ol ON o.o_orderkey = ol.l_orderkey
  JOIN first_orders fo ON o.o_custkey = fo.f_custkey AND year(o.o_orderdate) = fo.f_year
  JOIN dim_provider p ON ol.provider_id = p.provider_id
),
fact_order AS (
  SELECT o_orderkey AS order_id, provider_id, provider_name, city_name, o_custkey AS user_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderstatus <> 'P' THEN 'delivered' WHEN o_custkey % 2 = 0 THEN 'rejected'
              ELSE 'cancelled' END AS order_state,
         gross, net AS gmv, net * 0.02 AS gmv_eur, refunded, incent AS discount,
         (o_orderdate = first_orderdate) AS is_first,
         (dd % 60 + 10 <= 25) AS is_honey,
         (dd % 60 + 10 > 50 OR n_rep >= 2) AS is_bad,
         (dd % 60 + 10 > 50) AS is_late,
         (dd % 25 > 15) AS is_late_pickup,
         (o_orderpriority = '1-URGENT') AS is_ticket,
         CAST(dd % 60 + 10 AS DOUBLE) AS delivery_minutes,
         CASE WHEN o_custkey % 10 <> 0 THEN CAST(dd % 60 + 2 AS DOUBLE) END AS courier_minutes,
         {", ".join(f"CASE WHEN substr(o_orderpriority, 1, 1) = '{i}' THEN incent * 0.4 END AS platform_spend_{k}"
                    for k, i in _SPEND)},
         CASE WHEN o_custkey % 7 = 0 THEN net * 0.01 END AS platform_spend_other,
         {", ".join(f"CASE WHEN substr(o_orderpriority, 1, 1) = '{i}' THEN incent * 0.6 END AS merchant_spend_{k}"
                    for k, i in _SPEND)},
         CASE WHEN o_custkey % 11 = 0 THEN net * 0.01 END AS merchant_spend_other,
         n_lines, n_adj, n_rep
  FROM fact_base
),
provider_monthly AS (
  SELECT provider_id, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS ts,
         COUNT(CASE WHEN order_state = 'delivered' THEN 1 END) AS delivered_orders,
         AVG(CASE WHEN order_state = 'delivered' THEN delivery_minutes END) AS minutes_value,
         COUNT(CASE WHEN order_state = 'delivered' THEN 1 END) AS minutes_weight,
         AVG(CASE WHEN is_late THEN 1 ELSE 0 END) AS late_value, COUNT(*) AS late_weight,
         AVG(CASE WHEN is_late_pickup THEN 1 ELSE 0 END) AS prep_value, COUNT(*) AS prep_weight,
         AVG(CASE WHEN NOT (order_state = 'delivered') THEN 1 ELSE 0 END) AS failed_value, COUNT(*) AS failed_weight,
         AVG(CASE WHEN is_bad THEN 1 ELSE 0 END) AS bad_value, COUNT(*) AS bad_weight,
         AVG(CASE WHEN is_ticket THEN 1 ELSE 0 END) AS ticket_value, COUNT(*) AS ticket_weight,
         AVG(CASE WHEN order_state = 'delivered' THEN 1 ELSE 0 END) AS completion_value,
         COUNT(*) AS completion_weight,
         AVG(CASE WHEN user_id % 3 = 0 THEN 1 + user_id % 5 END) AS rating_value,
         COUNT(CASE WHEN user_id % 3 = 0 THEN 1 END) AS rating_weight,
         CAST(90 + provider_id % 10 AS DOUBLE) / 100 AS active_value,
         CAST(720 AS BIGINT) AS active_weight
  FROM fact_order GROUP BY provider_id, CAST(date_trunc('month', order_date) AS TIMESTAMP)
),
provider_weekly AS (
  SELECT provider_id, CAST(date_trunc('week', order_date) AS TIMESTAMP) AS ts,
         {sdiv("SUM(n_adj)", "SUM(n_lines)")} AS adjustment_value,
         CAST(SUM(n_lines) AS BIGINT) AS adjustment_weight,
         {sdiv("SUM(n_rep)", "SUM(n_lines)")} AS replacement_value,
         CAST(SUM(n_lines) AS BIGINT) AS replacement_weight,
         AVG(CASE WHEN order_state <> 'rejected' THEN 1 ELSE 0 END) AS acceptance_value,
         COUNT(*) AS acceptance_weight,
         AVG(CASE WHEN user_id % 3 = 0 THEN 1 + user_id % 5 END) AS rating_value,
         COUNT(CASE WHEN user_id % 3 = 0 THEN 1 END) AS rating_weight,
         CAST(90 + provider_id % 10 AS DOUBLE) / 100 AS active_value,
         CAST(168 AS BIGINT) AS active_weight
  FROM fact_order GROUP BY provider_id, CAST(date_trunc('week', order_date) AS TIMESTAMP)
),
resolution AS (
  SELECT l_orderkey AS order_id,
         CASE l_returnflag WHEN 'R' THEN 'item_unavailable' WHEN 'A' THEN 'partner_closed'
                           WHEN 'N' THEN 'client_cancelled' END AS reason,
         CASE l_linestatus WHEN 'F' THEN 'provider' WHEN 'O' THEN 'client' END AS actor_type
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
)"""


def _metric_def_values() -> str:
    rows = ", ".join(
        f"(CAST({o} AS BIGINT), '{k}', '{g}', CAST({dr} AS BIGINT), '{f}')" for o, k, g, dr, f in METRICS
    )
    return f"metric_def(metric_ord, metric_key, metric_group, dir, fmt) AS (VALUES {rows})"


def _store_cols_values() -> str:
    rows = ", ".join(f"(CAST({i} AS BIGINT), '{k}', {dr})" for i, (k, dr) in enumerate(STORE_COLS, start=1))
    return f"store_cols(col_ord, col_key, dir) AS (VALUES {rows})"


def build(p: ReportParams = FIXTURE_PARAMS) -> dict[str, str]:
    if p.approx_distinct_rsd is not None:
        raise ValueError("the oracle is exact: approximate distinct counts have no oracle")
    scopes = f"""
partner AS (SELECT provider_id FROM dim_provider WHERE country_code = '{p.country}' AND group_name = '{p.partner_group}'),
peers AS (SELECT provider_id FROM dim_provider WHERE country_code = '{p.country}' AND is_grocery
          {"AND NOT coalesce(group_name = '" + p.partner_group + "', false)" if p.peers_exclude_partner else ""}),
pf AS (SELECT f.* FROM fact_order f JOIN partner USING (provider_id)),
pw AS (SELECT w.* FROM provider_weekly w JOIN partner USING (provider_id))"""
    head = f"WITH {MAPPING},{scopes}"
    q: dict[str, str] = {}

    windows = {
        "monthly": (p.data_start, p.data_end, "strftime(order_date, '%Y-%m')", "strftime(ts, '%Y-%m')"),
        "weekly": (p.week_start, p.week_end, "strftime(date_trunc('week', order_date), '%Y-%m-%d')",
                   "strftime(ts, '%Y-%m-%d')"),
    }
    for g, (s, e, okey, tkey) in windows.items():
        owin = f"order_date BETWEEN {d(s)} AND {d(e)}"
        twin = f"ts BETWEEN {ts(s)} AND {ts(e)}"
        q[f"financial_{g}"] = f"""{head}
SELECT {okey} AS period, COUNT(*) AS orders,
  {mart("CAST(SUM(gross) AS DOUBLE)")} AS merchant_price,
  {mart(sdiv("CAST(SUM(gross) AS DOUBLE)", "COUNT(*)"))} AS merchant_price_per_order,
  {mart("CAST(SUM(gmv) AS DOUBLE)")} AS gmv,
  {mart(sdiv("CAST(SUM(gmv) AS DOUBLE)", "COUNT(*)"))} AS aov,
  COUNT(DISTINCT CASE WHEN is_first THEN user_id END) AS users_activated,
  COUNT(DISTINCT user_id) AS active_users,
  {mart(sdiv("CAST(SUM(refunded) AS DOUBLE)", "CAST(SUM(gmv) AS DOUBLE)") + " * 100")} AS refund_rate_pct,
  {mart(sdiv("CAST(SUM(gmv) AS DOUBLE)", "CAST(SUM(gmv_eur) AS DOUBLE)"))} AS fx_rate
FROM pf WHERE order_state = 'delivered' AND {owin}
GROUP BY 1 ORDER BY 1"""

        def share(flag):
            return mart(sdiv(f"SUM(CASE WHEN {flag} THEN 1 ELSE 0 END)", "COUNT(*)") + " * 100")

        q[f"operational_{g}"] = f"""{head}
SELECT {okey} AS period, COUNT(*) AS delivered_orders, COUNT(DISTINCT provider_id) AS active_stores,
  {share("is_honey")} AS honey_order_rate, {share("is_bad")} AS bad_order_rate,
  {share("is_late")} AS late_delivery_rate, {share("is_late_pickup")} AS late_pickup_rate,
  {mart("AVG(delivery_minutes)")} AS avg_delivery_minutes,
  {mart("AVG(courier_minutes)")} AS avg_courier_delivery_min
FROM pf WHERE order_state = 'delivered' AND {owin}
GROUP BY 1 ORDER BY 1"""
        q[f"replacement_adjustment_{g}"] = f"""{head}
SELECT {tkey} AS period,
  {rhu(w2("adjustment", True), 2)} AS adjustment_rate,
  {rhu(w2("replacement", True), 2)} AS replacement_rate
FROM pw WHERE {twin}
GROUP BY 1 ORDER BY 1"""
        fail = "SUM(CASE WHEN order_state <> 'delivered' THEN 1 ELSE 0 END)"
        q[f"failed_orders_{g}"] = f"""{head}
SELECT {okey} AS period, COUNT(*) AS total_placed,
  CAST(SUM(CASE WHEN order_state = 'delivered' THEN 1 ELSE 0 END) AS BIGINT) AS delivered,
  CAST({fail} AS BIGINT) AS failed_total,
  {mart(sdiv(fail, "COUNT(*)") + " * 100")} AS failed_rate_pct
FROM pf WHERE {owin}
GROUP BY 1 ORDER BY 1"""
        q[f"failed_reasons_{g}"] = f"""{head}
SELECT {okey} AS period, r.reason, r.actor_type, COUNT(*) AS cnt
FROM resolution r JOIN pf ON r.order_id = pf.order_id
WHERE {owin} AND pf.order_state <> 'delivered'
GROUP BY 1, 2, 3 ORDER BY 1, cnt DESC, 2, 3"""
        plat = " + ".join(f"COALESCE(platform_spend_{k}, 0)" for k in [s_[0] for s_ in _SPEND] + ["other"])
        merch = " + ".join(f"COALESCE(merchant_spend_{k}, 0)" for k in [s_[0] for s_ in _SPEND] + ["other"])
        q[f"campaigns_{g}"] = f"""{head}
SELECT {okey} AS period,
  {mart("CAST(SUM(discount) AS DOUBLE)")} AS campaigns_discount,
  {mart(f"CAST(SUM({plat}) AS DOUBLE)")} AS platform_spend,
  {mart(f"CAST(SUM({merch}) AS DOUBLE)")} AS merchant_spend,
  COUNT(CASE WHEN discount > 0 THEN 1 END) AS campaign_orders
FROM pf WHERE order_state = 'delivered' AND {owin}
GROUP BY 1 ORDER BY 1"""
        q[f"acceptance_{g}"] = f"""{head}
SELECT {tkey} AS period,
  {rhu(w2("acceptance", True), 1)} AS acceptance_rate,
  {rhu(w2("active", True), 1)} AS availability_rate,
  {rhu(w2("rating", False), 3)} AS avg_rating
FROM pw WHERE {twin}
GROUP BY 1 ORDER BY 1"""

    q["acceptance_current"] = f"""{head}
SELECT {rhu(w2("acceptance", True), 1)} AS acceptance_rate,
  {rhu(w2("active", True), 1)} AS availability_rate,
  {rhu(w2("rating", False), 3)} AS avg_rating
FROM pw WHERE ts >= {ts(p.rolling_start)}"""
    q["top_stores_last_month"] = f"""{head}
SELECT provider_name, city_name, COUNT(*) AS orders, {mart("CAST(SUM(gross) AS DOUBLE)")} AS merchant_price
FROM pf WHERE order_state = 'delivered'
  AND order_date >= {d(p.prev_month_start)} AND order_date < {d(p.prev_month_end_excl)}
GROUP BY 1, 2 ORDER BY merchant_price DESC, provider_name, city_name LIMIT {p.top_stores}"""

    # ---- scorecard ----
    bench_m = f"ts >= {ts(p.bench_start.replace(day=1))} AND ts < {ts(p.bench_end_excl)}"
    score_m = f"ts >= {ts(p.scorecard_start.replace(day=1))} AND ts < {ts(p.scorecard_end_excl)}"
    sc = f"""{head},
{_metric_def_values()},
{_store_cols_values()},
cm AS (SELECT provider_id, MAX(city_name) AS city_name, MAX(provider_name) AS provider_name
       FROM pf GROUP BY provider_id),
city_rank AS (SELECT city_name AS city, COUNT(*) AS orders FROM pf
              WHERE order_state = 'delivered' AND order_date BETWEEN {d(p.bench_start)} AND {d(p.bench_end)}
              GROUP BY 1),
top_cities AS (SELECT city AS bucket, CAST(row_number() OVER (ORDER BY orders DESC, city) AS BIGINT) AS bucket_ord
               FROM (SELECT * FROM city_rank WHERE city IS NOT NULL ORDER BY orders DESC, city LIMIT {p.top_cities})),
buckets AS (SELECT bucket, bucket_ord FROM top_cities
            UNION ALL SELECT '{p.other_bucket}', CAST({p.top_cities + 1} AS BIGINT)),
biz AS (SELECT COALESCE(t.bucket, '{p.other_bucket}') AS bucket, strftime(f.order_date, '%Y-%m') AS month,
          COUNT(*) AS orders, {mart("CAST(SUM(f.gmv_eur) AS DOUBLE)")} AS gmv_eur,
          COUNT(DISTINCT f.user_id) AS active_users,
          COUNT(DISTINCT CASE WHEN f.is_first THEN f.user_id END) AS new_users,
          COUNT(DISTINCT f.provider_id) AS merchants
        FROM pf f LEFT JOIN top_cities t ON f.city_name = t.bucket
        WHERE f.order_state = 'delivered' AND f.order_date BETWEEN {d(p.scorecard_start)} AND {d(p.scorecard_end)}
        GROUP BY 1, 2),
populated AS (SELECT month, CAST(SUM(orders) AS BIGINT) AS orders FROM biz GROUP BY month
              HAVING SUM(orders) >= {p.min_month_orders}),
qual AS (SELECT COALESCE(t.bucket, '{p.other_bucket}') AS bucket, strftime(m.ts, '%Y-%m') AS month,
           {", ".join(f"SUM(m.{r}_value * m.{r}_weight) AS {r}_vw, CAST(SUM(m.{r}_weight) AS BIGINT) AS {r}_w"
                      for r in _RATES)}
         FROM provider_monthly m JOIN cm ON m.provider_id = cm.provider_id
              LEFT JOIN top_cities t ON cm.city_name = t.bucket
         WHERE {score_m} AND strftime(m.ts, '%Y-%m') IN (SELECT month FROM populated)
         GROUP BY 1, 2),
adjm AS (SELECT COALESCE(t.bucket, '{p.other_bucket}') AS bucket, strftime(w.ts, '%Y-%m') AS month,
           SUM(w.adjustment_value * w.adjustment_weight) AS adjustment_vw,
           CAST(SUM(w.adjustment_weight) AS BIGINT) AS adjustment_w
         FROM provider_weekly w JOIN cm ON w.provider_id = cm.provider_id
              LEFT JOIN top_cities t ON cm.city_name = t.bucket
         WHERE {score_m} AND strftime(w.ts, '%Y-%m') IN (SELECT month FROM populated)
         GROUP BY 1, 2),
bb AS (SELECT COUNT(*) AS orders, {mart("CAST(SUM(gmv_eur) AS DOUBLE)")} AS gmv_eur,
         COUNT(DISTINCT user_id) AS active_users, COUNT(DISTINCT CASE WHEN is_first THEN user_id END) AS new_users,
         COUNT(DISTINCT provider_id) AS merchants
       FROM fact_order JOIN peers USING (provider_id)
       WHERE order_state = 'delivered' AND order_date BETWEEN {d(p.bench_start)} AND {d(p.bench_end)}),
bq AS (SELECT {mart(w2("minutes", False))} AS minutes, {mart(w2("late", True))} AS late, {mart(w2("prep", True))} AS prep,
         {mart(w2("failed", True))} AS failed, {mart(w2("bad", True))} AS bad, {mart(w2("ticket", True))} AS ticket,
         {mart(w2("completion", True))} AS completion, {mart(w2("rating", False))} AS rating,
         {mart(w2("active", True))} AS active
       FROM provider_monthly JOIN peers USING (provider_id) WHERE {bench_m}),
ba AS (SELECT {mart(w2("adjustment", True))} AS adjustment FROM provider_weekly JOIN peers USING (provider_id)
       WHERE {bench_m}),
wide AS (SELECT s.bucket, s.bucket_ord, s.month,
           {rhu("biz.gmv_eur", 0)} AS v1, CAST(biz.orders AS DOUBLE) AS v2, CAST(biz.active_users AS DOUBLE) AS v3,
           CAST(biz.new_users AS DOUBLE) AS v4, {rhu(sdiv("biz.orders", "biz.active_users"), 2)} AS v5,
           CAST(biz.merchants AS DOUBLE) AS v6, {rhu(sdiv("biz.gmv_eur", "biz.orders"), 0)} AS v7,
           {rhu(sdiv("biz.gmv_eur", "biz.merchants"), 1)} AS v8, {rhu(sdiv("biz.orders", "biz.merchants"), 1)} AS v9,
           {rhu(sdiv("q.active_vw", "q.active_w") + " * 100", 1)} AS v10,
           {rhu(sdiv("q.minutes_vw", "q.minutes_w"), 2)} AS v11,
           {rhu(sdiv("q.late_vw", "q.late_w") + " * 100", 1)} AS v12,
           {rhu(sdiv("q.prep_vw", "q.prep_w") + " * 100", 1)} AS v13,
           {rhu(sdiv("q.failed_vw", "q.failed_w") + " * 100", 1)} AS v14,
           {rhu(sdiv("q.bad_vw", "q.bad_w") + " * 100", 1)} AS v15,
           {rhu(sdiv("a.adjustment_vw", "a.adjustment_w") + " * 100", 1)} AS v16,
           {rhu(sdiv("q.ticket_vw", "q.ticket_w") + " * 100", 1)} AS v17,
           {rhu(sdiv("q.completion_vw", "q.completion_w") + " * 100", 1)} AS v18,
           {rhu(sdiv("q.rating_vw", "q.rating_w"), 2)} AS v19
         FROM (SELECT b.bucket, b.bucket_ord, pm.month FROM buckets b CROSS JOIN populated pm) s
         LEFT JOIN biz ON biz.bucket = s.bucket AND biz.month = s.month
         LEFT JOIN qual q ON q.bucket = s.bucket AND q.month = s.month
         LEFT JOIN adjm a ON a.bucket = s.bucket AND a.month = s.month),
matrix AS (SELECT md.metric_ord, md.metric_key, w.bucket_ord, w.bucket, w.month,
             CASE md.metric_ord {" ".join(f"WHEN {i} THEN w.v{i}" for i in range(1, 20))} END AS value
           FROM wide w CROSS JOIN metric_def md),
bw AS (SELECT
         {rhu(sdiv(sdiv("bb.gmv_eur", "n.nm"), str(float(p.bench_months))), 1)} AS v1,
         {rhu(sdiv(sdiv("bb.orders", "n.nm"), str(float(p.bench_months))), 1)} AS v2,
         {rhu(sdiv(sdiv("bb.active_users", "n.nm"), str(float(p.bench_months))), 1)} AS v3,
         {rhu(sdiv(sdiv("bb.new_users", "n.nm"), str(float(p.bench_months))), 1)} AS v4,
         {rhu(sdiv("bb.orders", "bb.active_users"), 2)} AS v5,
         CAST(NULL AS DOUBLE) AS v6,
         {rhu(sdiv("bb.gmv_eur", "bb.orders"), 1)} AS v7,
         {rhu(sdiv(sdiv("bb.gmv_eur", "n.nm"), str(float(p.bench_months))), 1)} AS v8,
         {rhu(sdiv(sdiv("bb.orders", "n.nm"), str(float(p.bench_months))), 1)} AS v9,
         {rhu("bq.active", 1)} AS v10, {rhu("bq.minutes", 1)} AS v11, {rhu("bq.late", 1)} AS v12,
         {rhu("bq.prep", 1)} AS v13, {rhu("bq.failed", 1)} AS v14, {rhu("bq.bad", 1)} AS v15,
         CASE WHEN ba.adjustment <> 0 THEN {rhu("ba.adjustment", 1)} END AS v16,
         {rhu("bq.ticket", 1)} AS v17, {rhu("bq.completion", 1)} AS v18, {rhu("bq.rating", 2)} AS v19
       FROM bb CROSS JOIN bq CROSS JOIN ba
       CROSS JOIN (SELECT CASE WHEN COALESCE(merchants, 0) = 0 THEN 1 ELSE merchants END AS nm FROM bb) n),
bench AS (SELECT md.metric_ord, md.metric_key,
            CASE md.metric_ord {" ".join(f"WHEN {i} THEN bw.v{i}" for i in range(1, 20))} END AS bench
          FROM bw CROSS JOIN metric_def md),
means AS (SELECT mx.metric_ord, mx.metric_key, mx.bucket_ord, mx.bucket, AVG(mx.value) AS mean_value,
            b.bench, md.dir, md.fmt, md.metric_group
          FROM matrix mx JOIN bench b ON b.metric_key = mx.metric_key JOIN metric_def md ON md.metric_key = mx.metric_key
          GROUP BY mx.metric_ord, mx.metric_key, mx.bucket_ord, mx.bucket, b.bench, md.dir, md.fmt, md.metric_group),
span AS (SELECT MIN(month) AS m_first, MAX(month) AS m_last FROM populated),
adj_p AS (SELECT provider_id,
            {w2("adjustment", True)} AS replacement
          FROM provider_weekly WHERE {bench_m} AND provider_id IN (SELECT provider_id FROM partner)
          GROUP BY provider_id),
store_quality AS (
  SELECT cm.provider_name AS addr, cm.city_name AS city, CAST(SUM(m.delivered_orders) AS BIGINT) AS orders,
    {mart(sdiv("SUM(m.minutes_value * m.minutes_weight)", "SUM(m.minutes_weight)"))} AS dur,
    {mart(sdiv("SUM(m.late_value * m.late_weight)", "SUM(m.late_weight)") + " * 100")} AS late,
    {mart(sdiv("SUM(m.prep_value * m.prep_weight)", "SUM(m.prep_weight)") + " * 100")} AS lateprep,
    {mart(sdiv("SUM(m.failed_value * m.failed_weight)", "SUM(m.failed_weight)") + " * 100")} AS failed,
    {mart(sdiv("SUM(m.bad_value * m.bad_weight)", "SUM(m.bad_weight)") + " * 100")} AS bad,
    {mart("MAX(a.replacement)")} AS replacement,
    {mart(sdiv("SUM(m.ticket_value * m.ticket_weight)", "SUM(m.ticket_weight)") + " * 100")} AS cs,
    {mart(sdiv("SUM(m.completion_value * m.completion_weight)", "SUM(m.completion_weight)") + " * 100")} AS compl,
    {mart(sdiv("SUM(m.rating_value * m.rating_weight)", "SUM(m.rating_weight)"))} AS rating
  FROM provider_monthly m JOIN cm ON m.provider_id = cm.provider_id LEFT JOIN adj_p a ON a.provider_id = m.provider_id
  WHERE m.{bench_m}
  GROUP BY cm.provider_name, cm.city_name HAVING SUM(m.delivered_orders) > 0),
sb AS (SELECT s.addr, s.city, COALESCE(t.bucket, '{p.other_bucket}') AS bucket, s.orders,
         {", ".join(f"{rhu('s.' + k, 2)} AS {k}" for k, _ in STORE_COLS if k != "orders")}
       FROM store_quality s LEFT JOIN top_cities t ON s.city = t.bucket),
med AS (SELECT {", ".join(f"{mart(f'median(CAST({k} AS DOUBLE))')} AS med_{k}" for k, _ in STORE_COLS)} FROM sb),
flagged AS (SELECT sb.*, CAST({" + ".join(
        f"CASE WHEN sb.{k} {'<' if dr == 1 else '>'} med.med_{k} THEN 1 ELSE 0 END"
        for k, dr in STORE_COLS if dr != 0)} AS BIGINT) AS flags
            FROM sb CROSS JOIN med)"""

    def whole(x):
        return f"CAST(CAST({rhu(x, 0)} AS BIGINT) AS VARCHAR)"

    q["provider_city_map"] = f"{sc}\nSELECT provider_id, city_name FROM cm"
    q["city_orders_rank"] = f"{sc}\nSELECT city, orders FROM city_rank ORDER BY orders DESC, city"
    q["city_bucket"] = f"{sc}\nSELECT bucket, bucket_ord FROM buckets"
    q["business_by_bucket_month"] = f"{sc}\nSELECT * FROM biz"
    q["populated_months"] = f"{sc}\nSELECT month, orders FROM populated ORDER BY month"
    rounded = ", ".join(f"{mart(f'{r}_vw')} AS {r}_vw, {r}_w" for r in _RATES)
    q["quality_by_bucket_month"] = f"{sc}\nSELECT bucket, month, {rounded} FROM qual"
    q["adjustment_by_bucket_month"] = (
        f"{sc}\nSELECT bucket, month, {mart('adjustment_vw')} AS adjustment_vw, adjustment_w FROM adjm"
    )
    q["benchmark_business"] = f"{sc}\nSELECT * FROM bb"
    q["benchmark_quality"] = f"{sc}\nSELECT * FROM bq"
    q["benchmark_adjustment"] = f"{sc}\nSELECT * FROM ba"
    q["store_quality"] = f"{sc}\nSELECT * FROM store_quality ORDER BY orders DESC, addr, city"
    q["metric_matrix"] = f"{sc}\nSELECT metric_ord, metric_key, bucket_ord, bucket, month, value FROM matrix"
    q["metric_benchmarks"] = f"{sc}\nSELECT metric_ord, metric_key, bench FROM bench"
    q["metric_cell_class"] = f"""{sc}
SELECT mx.metric_ord, mx.metric_key, mx.bucket, mx.month, mx.value, b.bench,
  CASE WHEN mx.value IS NULL OR b.bench IS NULL OR md.dir = 0 THEN NULL
       WHEN (md.dir = 1 AND mx.value >= b.bench) OR (md.dir = -1 AND mx.value <= b.bench) THEN 'good'
       ELSE 'bad' END AS cell_class
FROM matrix mx JOIN bench b ON b.metric_key = mx.metric_key JOIN metric_def md ON md.metric_key = mx.metric_key"""
    par = f"COALESCE(abs({sdiv('mean_value - bench', 'abs(bench)')}) <= {p.par_band}, false)"
    undef = "(mean_value IS NULL OR bench IS NULL)"
    q["metric_verdict"] = f"""{sc}
SELECT metric_ord, metric_key, bucket, {mart("mean_value")} AS mean_value, bench,
  CASE WHEN {undef} THEN NULL WHEN {par} THEN 'par' WHEN mean_value > bench THEN 'above' ELSE 'below' END AS verdict,
  CASE WHEN {undef} OR {par} THEN 'eq'
       WHEN mean_value > bench THEN (CASE WHEN dir = -1 THEN 'down' ELSE 'up' END)
       ELSE (CASE WHEN dir = -1 THEN 'up' ELSE 'down' END) END AS tone
FROM means"""

    def trend(key):
        return f"""(SELECT bucket, arg_min(value, month) AS first_value, arg_max(value, month) AS last_value
   FROM matrix WHERE metric_key = '{key}' AND value IS NOT NULL GROUP BY bucket HAVING COUNT(*) >= 2) t
   CROSS JOIN span"""

    pct = (f"CAST(CASE WHEN first_value <> 0 THEN {rhu(sdiv('abs(last_value - first_value)', 'first_value') + ' * 100', 0)}"
           f" ELSE 0 END AS BIGINT)")
    orders_trend = f"""SELECT bucket, first_value, last_value,
  CASE WHEN last_value >= first_value THEN 'win' ELSE 'watch' END AS level, {pct} AS pct, 'Orders' AS kind,
  'Orders ' || {whole("first_value")} || '→' || {whole("last_value")} || ' (' || m_first || '→' || m_last || '), '
    || CASE WHEN last_value >= first_value THEN 'growth ' ELSE 'decline ' END || CAST({pct} AS VARCHAR) || '%.' AS text
FROM {trend("Orders")}"""
    users_trend = f"""SELECT bucket, first_value, last_value,
  CASE WHEN last_value >= first_value THEN 'win' ELSE 'watch' END AS level, 'New users' AS kind,
  'New users ' || {whole("first_value")} || '→' || {whole("last_value")} || ' (' || m_first || '→' || m_last || ').'
    AS text
FROM {trend("New Users")}"""
    item_val = (f"CASE fmt WHEN 'min' THEN {whole('mean_value')} || ' min' WHEN 'pct' THEN {whole('mean_value')} || '%' "
                f"WHEN 'dec' THEN printf('%.2f', {rhu('mean_value', 2)}) ELSE {whole('mean_value')} END")
    gap_key = ("mean_value" if p.gap_order == "mean"
               else f"COALESCE({sdiv('abs(mean_value - bench)', 'abs(bench)')}, CAST('infinity' AS DOUBLE))")
    gaps = f"""SELECT bucket, 'crit' AS level, 'Where to improve' AS kind,
  'Biggest gaps with the market: ' || string_agg(item, '; ' ORDER BY gap_rank) || '.' AS text, COUNT(*) AS n_gaps
FROM (SELECT bucket, metric_key || ' (' || {item_val} || ')' AS item,
        row_number() OVER (PARTITION BY bucket ORDER BY {gap_key} DESC, metric_ord) AS gap_rank
      FROM means
      WHERE bench IS NOT NULL AND dir <> 0 AND mean_value IS NOT NULL AND dir * (mean_value - bench) < 0
        AND metric_group = 'quality')
WHERE gap_rank <= {p.max_gaps}
GROUP BY bucket"""
    q["highlight_orders_trend"] = f"{sc}\n{orders_trend}"
    q["highlight_new_users_trend"] = f"{sc}\n{users_trend}"
    q["highlight_gaps"] = f"{sc}\n{gaps}"
    q["highlights"] = f"""{sc}
SELECT bucket_ord, bucket, ord, level, kind, text FROM (
  SELECT bucket, 1 AS ord, level, kind, text FROM ({orders_trend})
  UNION ALL SELECT bucket, 2 AS ord, level, kind, text FROM ({users_trend})
  UNION ALL SELECT bucket, 3 AS ord, level, kind, text FROM ({gaps})) JOIN buckets USING (bucket)
ORDER BY bucket_ord, ord"""

    keys = [k for k, _ in STORE_COLS]
    hi, mid = SEVERITY_CUTS if (p.severity_high, p.severity_mid) == (0.6, 0.35) else p.severity_cuts(9)
    q["store_bucketed"] = f"{sc}\nSELECT * FROM sb"
    q["store_medians"] = f"{sc}\nSELECT {', '.join(f'med_{k} AS {k}' for k in keys)} FROM med"
    q["store_medians_distributed"] = q["store_medians"]  # the same numbers, selected in another way
    q["store_flags"] = f"{sc}\nSELECT addr, city, bucket, {', '.join(keys)}, flags FROM flagged"
    q["worst_stores"] = f"""{sc}
SELECT addr, city, bucket, {', '.join(keys)}, flags FROM flagged
ORDER BY flags DESC, COALESCE(late, 0) DESC, orders DESC, addr, city LIMIT {p.worst_stores}"""
    q["store_severity"] = f"""{sc}
SELECT addr, city, bucket, flags,
  CAST(CASE WHEN flags >= {hi} THEN 2 WHEN flags >= {mid} THEN 1 ELSE 0 END AS BIGINT) AS severity
FROM flagged"""
    vcase = " ".join(f"WHEN '{k}' THEN CAST(sb.{k} AS DOUBLE)" for k in keys)
    mcase = " ".join(f"WHEN '{k}' THEN med.med_{k}" for k in keys)
    q["store_cell_class"] = f"""{sc}
SELECT addr, city, bucket, col_ord, col_key, value, median,
  CASE WHEN value IS NULL OR median IS NULL OR dir = 0 THEN NULL
       WHEN (dir = 1 AND value >= median) OR (dir = -1 AND value <= median) THEN 'good' ELSE 'bad' END AS cell_class
FROM (SELECT sb.addr, sb.city, sb.bucket, c.col_ord, c.col_key, c.dir,
        CASE c.col_key {vcase} END AS value, CASE c.col_key {mcase} END AS median
      FROM sb CROSS JOIN med CROSS JOIN store_cols c)"""
    q["store_ranked"] = f"""{sc}
SELECT bucket,
  CAST(row_number() OVER (PARTITION BY bucket ORDER BY flags DESC NULLS LAST, orders DESC, addr, city) AS BIGINT)
    AS store_rank,
  addr, city, orders, flags
FROM flagged ORDER BY bucket, store_rank"""
    q["bucket_store_counts"] = f"""{sc}
SELECT bucket_ord, bucket, COUNT(*) AS stores FROM sb JOIN buckets USING (bucket) GROUP BY ALL ORDER BY bucket_ord"""
    return q


def build_input_quality() -> str:
    """Counts of rows of the inputs that a report leaves out or counts twice."""

    def counts(table: str, checks: dict[str, str]) -> list[str]:
        return [f"SELECT '{table}' AS input, '{c}' AS measure, COUNT(CASE WHEN {cond} THEN 1 END) AS n FROM {table}" for c, cond in checks.items()]

    def rates(names: list[str]) -> dict[str, str]:
        return {"rows": "true"} | {f"{r}_without_weight": f"{r}_value IS NOT NULL AND COALESCE({r}_weight, 0) <= 0" for r in names}

    parts = counts("fact_order", {
        "rows": "true", "null_state": "order_state IS NULL", "null_provider": "provider_id IS NULL", "null_user": "user_id IS NULL",
        "null_gross": "gross IS NULL", "negative_gross": "gross < 0",
        "unknown_provider": "provider_id NOT IN (SELECT provider_id FROM dim_provider)",
    })
    parts += counts("provider_weekly", rates(["adjustment", "replacement", "acceptance", "rating", "active"]))
    parts += counts("provider_monthly", rates(_RATES))
    parts += counts("resolution", {"unknown_order": "NOT EXISTS (SELECT 1 FROM fact_order f WHERE f.order_id = resolution.order_id)"})
    for table, key, check in (("fact_order", "order_id", "repeated_order"), ("dim_provider", "provider_id", "repeated_provider")):
        parts.append(f"SELECT '{table}' AS input, '{check}' AS measure, COUNT({key}) - COUNT(DISTINCT {key}) AS n FROM {table}")
    return f"WITH {MAPPING}\nSELECT input, measure, n FROM (" + "\nUNION ALL\n".join(parts) + ") ORDER BY input, measure"


#: The partners of the test mapping: two groups in each of two countries.
TEST_PARTNERS = [(c, g) for c in ("xa", "xb") for g in ("P0", "P1")]
_BOTH_GRAINS = ("financial", "operational", "replacement_adjustment", "failed_orders", "failed_reasons", "campaigns", "acceptance")
_BY_COUNTRY = ("benchmark_business", "benchmark_quality", "benchmark_adjustment", "metric_benchmarks")

_FROM_STATES = (
    "financial", "operational", "failed_orders", "campaigns", "failed_reasons", "top_stores_last_month", "provider_city_map",
    "city_orders_rank", "city_bucket", "business_by_bucket_month", "benchmark_business",
)


def build_all_partners(p: ReportParams = FIXTURE_PARAMS) -> dict[str, str]:
    """Statements for all partners: the single statements of every partner, one below the other."""
    single = {(c, g): build(p.with_(country=c, partner_group=g)) for c, g in TEST_PARTNERS}
    out: dict[str, list[str]] = {}
    for (c, g), q in single.items():
        if g == TEST_PARTNERS[0][1]:
            for name in _BY_COUNTRY:
                out.setdefault(name, []).append(f"SELECT '{c}' AS country_code, * FROM ({q[name]})")
        for name, sql in q.items():
            who = f"'{c}' AS country_code, '{g}' AS partner_group"
            family, _, last = name.rpartition("_")
            grain = {"monthly": "month", "weekly": "week"}.get(last)
            if family in _BOTH_GRAINS and grain:
                out.setdefault(family, []).append(f"SELECT {who}, '{grain}' AS grain, * FROM ({sql})")
            elif name not in _BY_COUNTRY and not name.startswith("highlight_"):
                out.setdefault(name, []).append(f"SELECT {who}, * FROM ({sql})")
    joined = {name: "\nUNION ALL\n".join(parts) for name, parts in out.items()}
    return {f"partners_{name}": sql for name, sql in joined.items()} | {f"states_{name}": joined[name] for name in _FROM_STATES}


ORACLE_SQL = {**build(), **build_all_partners(), "input_quality": build_input_quality()}
