"""SQL building blocks of the oracle queries: the shop tables and features as CTEs."""

from __future__ import annotations

import re

from churnlake.registry.star_tables import EVENT_HORIZON_DAYS, HORIZON_DAYS, LOGIN_SHIFT_DAYS

CTES: dict[str, str] = {}


def sql(main: str) -> str:
    """The query with every CTE it names, directly or through another, put in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                needed.append(name)

    visit(main)
    if not needed:
        return main
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in needed) + "\n" + main


def exact_sum(value: str) -> str:
    """SQL of a sum of doubles, added as integers of 2**-64 and rounded to a double once.

    A whole number's text is read as the nearest double, which a cast does not promise.
    """
    unit = "18446744073709551616.0::DOUBLE"
    return f"(CAST(CAST(sum(CAST({value} * {unit} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {unit})"


def exact_avg(value: str) -> str:
    return f"({exact_sum(value)} / nullif(count({value}), 0))"


def _users(created: str) -> str:
    return f"""
SELECT c_custkey AS user_id,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
            THEN 'MALE' ELSE 'FEMALE' END AS gender,
       make_date(CAST(1941 + c_custkey % 41 AS INT), 1, 1) AS birthdate,
       {created} AS created_at
FROM customer"""


CTES["s_users"] = _users(
    "TIMESTAMP '1994-07-01 00:00:00' + to_days(CAST(c_custkey % 180 AS INT))"
)
CTES["s_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date,
       o_totalprice AS total_amount, o_orderstatus AS status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'WELCOME10'
                            WHEN '2-HIGH' THEN 'SUMMER25' END AS used_coupon_code
FROM orders"""
CTES["s_items"] = """
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
       l_partkey AS product_id, l_quantity AS quantity,
       l_extendedprice / l_quantity AS price_per_item
FROM lineitem"""
CTES["s_products"] = "SELECT p_partkey AS product_id, p_type AS category_id FROM part"
CTES["s_logins"] = f"""
SELECT event_id AS login_id, user_id, ts - INTERVAL {LOGIN_SHIFT_DAYS} DAY AS login_at
FROM events WHERE event_type = 'view'"""
CTES["s_carts"] = f"""
SELECT event_id AS cart_item_id, user_id, ts - INTERVAL {LOGIN_SHIFT_DAYS} DAY AS added_at
FROM events WHERE event_type = 'click'"""
CTES["s_categories"] = """
SELECT r_regionkey AS category_id, r_name AS category_name, CAST(NULL AS DOUBLE) AS parent_id
FROM region
UNION ALL
SELECT 100 + n_nationkey, n_name, CAST(n_regionkey AS DOUBLE) FROM nation"""
CTES["s_interests"] = """
SELECT DISTINCT o_custkey AS user_id, p_type AS category_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE l_returnflag = 'R'"""

CTES["e_users"] = _users(
    "TIMESTAMP '2023-12-01 00:00:00' + to_days(CAST(c_custkey % 60 AS INT))"
)
CTES["e_orders"] = """
SELECT event_id AS order_id, user_id, ts AS order_date, value AS total_amount,
       CASE WHEN event_id % 5 = 0 THEN 'WELCOME10' END AS used_coupon_code
FROM events WHERE event_type = 'purchase'"""
CTES["e_logins"] = (
    "SELECT event_id AS login_id, user_id, ts AS login_at FROM events WHERE event_type = 'view'"
)
CTES["e_carts"] = (
    "SELECT event_id AS cart_item_id, user_id, ts AS added_at FROM events "
    "WHERE event_type = 'click'"
)

AGE_BAND = (
    "CASE WHEN age >= 0 AND age <= 24 THEN '<25' WHEN age > 24 AND age <= 34 THEN '25-34' "
    "WHEN age > 34 AND age <= 44 THEN '35-44' WHEN age > 44 AND age <= 200 THEN '45+' END"
)
RFM_BAND = (
    "CASE WHEN RFM_sum > 2 AND RFM_sum <= 5 THEN 'Low(3-5)' "
    "WHEN RFM_sum > 5 AND RFM_sum <= 8 THEN 'Mid-Low(6-8)' "
    "WHEN RFM_sum > 8 AND RFM_sum <= 11 THEN 'Mid-High(9-11)' "
    "WHEN RFM_sum > 11 AND RFM_sum <= 15 THEN 'High(12-15)' END"
)


def _clock(p: str, horizon: int) -> str:
    return f"""
SELECT max(m) AS ref, max(m) - INTERVAL {horizon} DAY AS threshold FROM (
  SELECT max(order_date) AS m FROM {p}_orders UNION ALL SELECT max(login_at) FROM {p}_logins
  UNION ALL SELECT max(added_at) FROM {p}_carts UNION ALL SELECT max(created_at) FROM {p}_users)"""


def _order_profile(p: str, where: str = "TRUE") -> str:
    return f"""
SELECT user_id, count(*) AS order_count, {exact_sum('total_amount')} AS total_spend,
       {exact_sum('total_amount')} / count(*) AS avg_order_value,
       min(order_date) AS first_order_date, max(order_date) AS last_purchase_date,
       CAST(sum(gap) AS DOUBLE) / count(gap) AS avg_days_between_orders,
       bool_or(used_coupon_code IS NOT NULL) AS used_coupon,
       count(used_coupon_code) AS n_coupon
FROM (SELECT *, datesub('day', lag(order_date) OVER (
        PARTITION BY user_id ORDER BY order_date, order_id), order_date) AS gap
      FROM {p}_orders, {p}_clock WHERE {where})
GROUP BY user_id"""


def _features(p: str, horizon: int, diversity: str) -> str:
    return f"""
SELECT u.user_id, gender, birthdate, created_at, last_purchase_date, first_order_date,
       CASE WHEN last_purchase_date IS NULL OR last_purchase_date < threshold
            THEN 1 ELSE 0 END AS churn,
       coalesce(datesub('day', last_purchase_date, ref), {horizon + 9999}) AS recency_days,
       coalesce(order_count, 0) AS order_count, coalesce(total_spend, 0.0) AS total_spend,
       coalesce(avg_order_value, 0.0) AS avg_order_value, avg_days_between_orders,
       coalesce(login_count, 0) AS login_count, coalesce(cart_count, 0) AS cart_count,
       last_login_at, last_cart_at, coalesce(used_coupon, FALSE) AS used_coupon,
       year(ref) - year(birthdate) AS age,
       {AGE_BAND.replace('age', '(year(ref) - year(birthdate))')} AS age_group,
       CASE WHEN login_count > 0
            THEN coalesce(cart_count, 0)::DOUBLE / login_count ELSE 0.0 END AS avg_cart_per_login,
       {'coalesce(category_diversity, 0)' if diversity else '0'} AS category_diversity
FROM {p}_users u CROSS JOIN {p}_clock
LEFT JOIN {p}_profile USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS login_count, max(login_at) AS last_login_at
           FROM {p}_logins GROUP BY user_id) USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS cart_count, max(added_at) AS last_cart_at
           FROM {p}_carts GROUP BY user_id) USING (user_id)
{diversity}"""


def _scored(source: str) -> str:
    """Scores by unique rank: bin = greatest(1, ceil((rank - 1) q / (n - 1)))."""

    def bin_of(order: str) -> str:
        rank = f"row_number() OVER (ORDER BY {order}, user_id)"
        return (
            f"greatest(1, (({rank} - 1) * 5 + count(*) OVER () - 2) // (count(*) OVER () - 1))"
        )

    return f"""
SELECT *, {RFM_BAND} AS RFM_bucket FROM (
  SELECT *, R_score + F_score + M_score AS RFM_sum FROM (
    SELECT *, 6 - {bin_of('recency_days DESC')} AS R_score,
           {bin_of('order_count')} AS F_score, {bin_of('total_spend')} AS M_score
    FROM {source}))"""


CTES["s_clock"] = _clock("s", HORIZON_DAYS)
CTES["e_clock"] = _clock("e", EVENT_HORIZON_DAYS)
CTES["s_profile"] = _order_profile("s")
CTES["e_profile"] = _order_profile("e")
CTES["s_diversity"] = """
SELECT user_id, count(DISTINCT category_id) AS category_diversity
FROM s_items LEFT JOIN s_orders USING (order_id) LEFT JOIN s_products USING (product_id)
WHERE user_id IS NOT NULL AND category_id IS NOT NULL GROUP BY user_id"""
CTES["s_features"] = _features("s", HORIZON_DAYS, "LEFT JOIN s_diversity USING (user_id)")
CTES["e_features"] = _features("e", EVENT_HORIZON_DAYS, "")
CTES["s_scored"] = _scored("s_features")

CTES["scores"] = """
SELECT model, o_orderkey AS id, o_custkey, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END
         AS label,
       CAST((o_orderkey * 7919) % 1000
            + k * CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS DOUBLE) / 1600 AS score
FROM orders CROSS JOIN (VALUES ('good', 600), ('fair', 300), ('none', 0)) AS m(model, k)"""

NUMERIC = ("order_count", "total_spend", "avg_order_value", "avg_days_between_orders",
           "login_count", "cart_count", "recency_days", "RFM_sum", "age")
CTES["long_numeric"] = "\nUNION ALL ".join(
    f"SELECT user_id, churn, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM s_scored"
    for c in NUMERIC
)
CTES["long_levels"] = """
SELECT churn, 'gender' AS variable, gender AS level FROM s_scored
UNION ALL SELECT churn, 'age_group', age_group FROM s_scored
UNION ALL SELECT churn, 'used_coupon', CAST(used_coupon AS VARCHAR) FROM s_scored"""


def _snapshots(p: str, horizon: int) -> str:
    def one(back: int) -> str:
        ref = f"(SELECT ref - INTERVAL {back} DAY FROM {p}_clock)"
        return f"""
SELECT u.user_id, birthdate, created_at, gender, coalesce(order_count, 0) AS order_count,
       coalesce(total_spend, 0.0) AS total_spend, last_order,
       coalesce(avg_order_value, 0.0) AS avg_order_value, avg_days_between_orders,
       coalesce(login_count, 0) AS login_count, coalesce(cart_count, 0) AS cart_count,
       {ref} AS snapshot_ref_date, year({ref}) - year(birthdate) AS age,
       CASE WHEN f.user_id IS NULL THEN 1 ELSE 0 END AS churn_90d
FROM {p}_users u
LEFT JOIN (SELECT user_id, count(*) AS order_count, {exact_sum('total_amount')} AS total_spend,
                  max(order_date) AS last_order,
                  {exact_sum('total_amount')} / count(*) AS avg_order_value,
                  CAST(sum(gap) AS DOUBLE) / count(gap) AS avg_days_between_orders
           FROM (SELECT *, datesub('day', lag(order_date) OVER (
                   PARTITION BY user_id ORDER BY order_date, order_id), order_date) AS gap
                 FROM {p}_orders WHERE order_date <= {ref}) GROUP BY user_id) o USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS login_count FROM {p}_logins
           WHERE login_at <= {ref} GROUP BY user_id) l USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS cart_count FROM {p}_carts
           WHERE added_at <= {ref} GROUP BY user_id) c USING (user_id)
LEFT JOIN (SELECT DISTINCT user_id FROM {p}_orders WHERE order_date > {ref}
           AND order_date <= {ref} + INTERVAL {horizon} DAY) f ON f.user_id = u.user_id"""

    both = one(2 * horizon) + "\nUNION ALL" + one(horizon)
    return f"""
SELECT *, {AGE_BAND} AS age_group,
       CASE WHEN login_count > 0 THEN cart_count::DOUBLE / login_count ELSE 0.0 END
         AS avg_cart_per_login,
       CASE WHEN gender IN ('MALE', 'male', 'Male', 'M', 'm') AND age BETWEEN 20 AND 39
            THEN 1 ELSE 0 END AS is_male_20s30s
FROM ({both})"""


CTES["s_snapshots"] = _snapshots("s", HORIZON_DAYS)
CTES["e_snapshots"] = _snapshots("e", EVENT_HORIZON_DAYS)
CTES["seg_stats"] = """
SELECT avg(login_count) AS m1, coalesce(nullif(stddev_pop(login_count), 0), 1) AS d1,
       avg(order_count) AS m2, coalesce(nullif(stddev_pop(order_count), 0), 1) AS d2,
       avg(avg_cart_per_login) AS m3,
       coalesce(nullif(stddev_pop(avg_cart_per_login), 0), 1) AS d3,
       avg(category_diversity) AS m4,
       coalesce(nullif(stddev_pop(category_diversity), 0), 1) AS d4
FROM s_features"""
CTES["seg_scaled"] = """
SELECT f.*, (login_count - m1) / d1 AS z1, (order_count - m2) / d2 AS z2,
       (avg_cart_per_login - m3) / d3 AS z3, (category_diversity - m4) / d4 AS z4
FROM s_features f CROSS JOIN seg_stats"""
CENTRES = ((3.0, 0.0, 1.5, 0.5), (-0.3, 1.0, -0.3, 0.5), (-0.3, -0.5, -0.3, 0.5),
           (-0.3, -1.5, -0.3, -1.0))


def _distance(centre: tuple[float, ...]) -> str:
    return " + ".join(
        f"(z{i + 1} - ({x}::DOUBLE)) * (z{i + 1} - ({x}::DOUBLE))" for i, x in enumerate(centre)
    )


CTES["seg_assigned"] = f"""
SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0
               WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS cluster
FROM (SELECT *, {', '.join(f'{_distance(c)} AS d{i}' for i, c in enumerate(CENTRES))}
      FROM seg_scaled)"""
