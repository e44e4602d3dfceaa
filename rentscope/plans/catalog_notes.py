"""Registered jobs for the worked SQL notes, mapped onto the driver tables.

Mapping: a company is a customer (department = nation, macrosector =
market segment, revenue = account balance); transactions, clicks and calls
are events; posts and purchases are orders; drugs are parts sold through
lineitems; emails are orders and their texts are the order's lineitems.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_rounded, round_ratio, sql_avg_rounded
from ..operators import aggregates as agg
from ..operators import joins, ordered, windows
from .catalog import register
from .companies import companies_text, keep_numeric
from ..sources.tables import table

# ---------------------------------------------------------------------------
# Company register: strict and lenient typing of numeric text
# ---------------------------------------------------------------------------

_CO = r"""
WITH co AS (
  SELECT CASE WHEN c.c_custkey % 50 = 7 THEN 'NIT-' || CAST(c.c_custkey AS VARCHAR)
              ELSE CAST(c.c_custkey AS VARCHAR) END AS nit,
         c.c_name AS company_name, r.r_name AS supervisor, r.r_name AS region, n.n_name AS department,
         n.n_name || ' CITY' AS city,
         CASE WHEN c.c_custkey % 70 = 2 THEN '46A9'
              ELSE CAST(c.c_nationkey * 100 + r.r_regionkey AS VARCHAR) END AS ciiu,
         c.c_mktsegment AS macrosector,
         CASE c.c_custkey % 40 WHEN 3 THEN '1,000' WHEN 5 THEN '1e5' WHEN 9 THEN '' WHEN 11 THEN NULL
              ELSE '$' || CAST(CAST(abs(c.c_acctbal) AS DECIMAL(14,2)) AS VARCHAR) END AS operating_revenue,
         '$' || CAST(CAST(c.c_acctbal AS DECIMAL(14,2)) AS VARCHAR) AS profit,
         CASE WHEN c.c_custkey % 40 = 13 THEN '-' ELSE '$' END
           || CAST(CAST(abs(c.c_acctbal) + 1000 AS DECIMAL(14,2)) AS VARCHAR) AS total_assets,
         '$' || CAST(CAST(abs(c.c_acctbal) + 500 AS DECIMAL(14,2)) AS VARCHAR) AS total_liabilities,
         '$' || CAST(CAST(c.c_acctbal - 500 AS DECIMAL(14,2)) AS VARCHAR) AS total_equity,
         CASE WHEN c.c_custkey % 60 = 1 THEN 'FY23' ELSE '2023' END AS cutoff_year
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey)
"""

_INT = "'^[0-9]+$'"
_UMONEY = r"'^[0-9]+(\.[0-9]+)?$'"
_SMONEY = r"'^-?[0-9]+(\.[0-9]+)?$'"


def _money_sql(c):
    return f"CAST(CAST(replace({c}, '$', '') AS DECIMAL(38,2)) AS DOUBLE)"


_STRICT = _CO + f"""
SELECT CAST(nit AS BIGINT) AS nit, company_name, supervisor, region, department, city,
       CAST(ciiu AS BIGINT) AS ciiu, macrosector,
       {_money_sql('operating_revenue')} AS operating_revenue, {_money_sql('profit')} AS profit,
       {_money_sql('total_assets')} AS total_assets, {_money_sql('total_liabilities')} AS total_liabilities,
       {_money_sql('total_equity')} AS total_equity, CAST(cutoff_year AS BIGINT) AS cutoff_year
FROM co
WHERE regexp_matches(nit, {_INT}) AND regexp_matches(ciiu, {_INT}) AND regexp_matches(cutoff_year, {_INT})
  AND regexp_matches(replace(operating_revenue, '$', ''), {_UMONEY})
  AND regexp_matches(replace(profit, '$', ''), {_SMONEY})
  AND regexp_matches(replace(total_assets, '$', ''), {_UMONEY})
  AND regexp_matches(replace(total_liabilities, '$', ''), {_UMONEY})
  AND regexp_matches(replace(total_equity, '$', ''), {_SMONEY})"""


def _lenient_int(c):
    return f"CASE WHEN regexp_matches({c}, {_INT}) THEN CAST({c} AS BIGINT) END AS {c}"


def _lenient_money(c):
    return f"CASE WHEN regexp_matches(replace({c}, '$', ''), {_SMONEY}) THEN {_money_sql(c)} END AS {c}"


_LENIENT = _CO + f"""
SELECT {_lenient_int('nit')}, company_name, supervisor, region, department, city, {_lenient_int('ciiu')},
       macrosector, {_lenient_money('operating_revenue')}, {_lenient_money('profit')},
       {_lenient_money('total_assets')}, {_lenient_money('total_liabilities')},
       {_lenient_money('total_equity')}, {_lenient_int('cutoff_year')}
FROM co"""


@register("company_strict", _STRICT)
def company_strict(spark, sf_dir):
    return keep_numeric(companies_text(spark, sf_dir), mode="drop")


@register("company_lenient", _LENIENT)
def company_lenient(spark, sf_dir):
    return keep_numeric(companies_text(spark, sf_dir), mode="null")


@register("company_by_department", _CO + """
SELECT * FROM co WHERE substr(department, 1, 1000) = 'NATION_1' ORDER BY nit LIMIT 100""")
def company_by_department(spark, sf_dir):
    # The first 100 companies of one department (the limit is the feature);
    # the nit order makes "first" deterministic.
    co = companies_text(spark, sf_dir)
    return co.where(F.substring("department", 1, 1000) == "NATION_1").orderBy("nit").limit(100)


# ---------------------------------------------------------------------------
# Company analytics over customers
# ---------------------------------------------------------------------------

_BIZ = """
WITH biz AS (
  SELECT c.c_custkey, c.c_name, n.n_name AS department, c.c_mktsegment AS macrosector, c.c_acctbal AS revenue
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)
"""


def biz(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_name", F.col("n_name").alias("department"),
        F.col("c_mktsegment").alias("macrosector"), F.col("c_acctbal").alias("revenue"))


def r4(c, name=None):
    return F.round(F.col(c), 4).alias(name or c)


@register("group_avg_having_top10", _BIZ + f"""
SELECT department, count(department) AS n_companies, {sql_avg_rounded('revenue', 4)} AS avg_revenue
FROM biz WHERE macrosector = 'MACHINERY'
GROUP BY department HAVING avg(revenue) > 0.1
ORDER BY avg(revenue) DESC, department LIMIT 10""")
def group_avg_having_top10(spark, sf_dir):
    g = (biz(spark, sf_dir).where(F.col("macrosector") == "MACHINERY").groupBy("department")
         .agg(F.count("department").alias("n_companies"), avg_rounded(F.col("revenue"), 4).alias("avg_revenue"),
              F.avg("revenue").alias("_avg")))
    return (g.where(F.col("_avg") > 0.1).orderBy(F.col("_avg").desc(), "department").limit(10)
             .select("department", "n_companies", "avg_revenue"))


@register("top1_group", _BIZ + """
SELECT department, count(department) AS n_companies FROM biz WHERE macrosector = 'BUILDING'
GROUP BY department ORDER BY n_companies DESC, department LIMIT 1""")
def top1_group(spark, sf_dir):
    g = (biz(spark, sf_dir).where(F.col("macrosector") == "BUILDING")
         .groupBy("department").agg(F.count("department").alias("n_companies")))
    return g.orderBy(F.col("n_companies").desc(), "department").limit(1)


@register("above_group_avg", _BIZ + f"""
SELECT b.c_name, b.department, b.revenue, a.dept_avg FROM biz b
JOIN (SELECT department, avg(revenue) AS raw_avg, {sql_avg_rounded('revenue', 4)} AS dept_avg
      FROM biz WHERE macrosector = 'MACHINERY' GROUP BY department) a ON a.department = b.department
WHERE b.macrosector = 'MACHINERY' AND b.revenue > a.raw_avg ORDER BY b.revenue DESC""")
def above_group_avg(spark, sf_dir):
    m = biz(spark, sf_dir).where(F.col("macrosector") == "MACHINERY")
    a = m.groupBy("department").agg(F.avg("revenue").alias("_raw"), avg_rounded(F.col("revenue"), 4).alias("dept_avg"))
    return m.join(a, "department").where(F.col("revenue") > F.col("_raw")).select(
        "c_name", "department", "revenue", "dept_avg").orderBy(F.col("revenue").desc())


@register("groups_above_mean_total", _BIZ + """
SELECT department, round(total, 4) AS total FROM (
  SELECT department, sum(revenue) AS total FROM biz WHERE macrosector = 'HOUSEHOLD' GROUP BY department) d
WHERE total > (SELECT avg(total) FROM (
  SELECT sum(revenue) AS total FROM biz WHERE macrosector = 'HOUSEHOLD' GROUP BY department) x)""")
def groups_above_mean_total(spark, sf_dir):
    h = biz(spark, sf_dir).where(F.col("macrosector") == "HOUSEHOLD")
    return joins.groups_above_mean_total(h, "department", "revenue").orderBy(F.col("total").desc()) \
        .select("department", r4("total"))


@register("top5_per_group", _BIZ + """
SELECT c_name, macrosector, revenue, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY macrosector ORDER BY revenue DESC, c_custkey) AS rn FROM biz) t
WHERE rn <= 5""")
def top5_per_group(spark, sf_dir):
    t = windows.top_n_per_group(biz(spark, sf_dir), "macrosector",
                                [F.col("revenue").desc(), F.col("c_custkey")], 5)
    return t.select("c_name", "macrosector", "revenue", F.col("rn").cast("bigint").alias("rn"))


@register("share_of_group", _BIZ + """
SELECT c_custkey, c_name, macrosector,
       round(100.0 * revenue / NULLIF(sum(revenue) OVER (PARTITION BY macrosector), 0), 6) AS pct
FROM biz""")
def share_of_group(spark, sf_dir):
    s = windows.share_of_group(biz(spark, sf_dir), "macrosector", "revenue")
    return s.select("c_custkey", "c_name", "macrosector", F.round("pct", 6).alias("pct"))


@register("running_total", _BIZ + """
SELECT department, c_name, revenue,
       round(sum(revenue) OVER (PARTITION BY department ORDER BY revenue DESC, c_custkey
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running
FROM biz""")
def running_total(spark, sf_dir):
    # skew-safe: a department holding a third of all companies is still
    # scanned by many tasks (value ranges + offsets)
    r = ordered.running_total(biz(spark, sf_dir), "department", "revenue", ["c_custkey"])
    return r.select("department", "c_name", "revenue", r4("running"))


@register("quartiles", _BIZ + """
SELECT c_name, macrosector, revenue,
       ntile(4) OVER (PARTITION BY macrosector ORDER BY revenue DESC, c_custkey) AS quartile
FROM biz""")
def quartiles(spark, sf_dir):
    q = ordered.ntile(biz(spark, sf_dir), "macrosector", "revenue", ["c_custkey"], 4, out="quartile")
    return q.select("c_name", "macrosector", "revenue", F.col("quartile").cast("bigint").alias("quartile"))


@register("global_top10_dense", _BIZ + """
SELECT c_name, revenue, dense_rank FROM (
  SELECT c_name, revenue, dense_rank() OVER (ORDER BY revenue DESC) AS dense_rank FROM biz) t
WHERE dense_rank <= 10""")
def global_top10_dense(spark, sf_dir):
    return windows.global_dense_top(biz(spark, sf_dir), "revenue", 10).select(
        "c_name", "revenue", F.col("dense_rank").cast("bigint").alias("dense_rank"))


@register("group_vs_global_avg", _BIZ + f"""
SELECT s.macrosector, s.segment_avg, g.global_avg FROM
  (SELECT macrosector, avg(revenue) AS raw_seg, {sql_avg_rounded('revenue', 4)} AS segment_avg
   FROM biz GROUP BY macrosector) s,
  (SELECT avg(revenue) AS raw_glob, {sql_avg_rounded('revenue', 4)} AS global_avg FROM biz) g
WHERE s.raw_seg / g.raw_glob > 0.8""")
def group_vs_global_avg(spark, sf_dir):
    b = biz(spark, sf_dir)
    seg = b.groupBy("macrosector").agg(F.avg("revenue").alias("_seg"),
                                       avg_rounded(F.col("revenue"), 4).alias("segment_avg"))
    glob = b.agg(F.avg("revenue").alias("_glob"), avg_rounded(F.col("revenue"), 4).alias("global_avg"))
    j = joins.with_scalar(seg, glob)
    return j.where(F.col("_seg") / F.col("_glob") > 0.8).select("macrosector", "segment_avg", "global_avg")


@register("pareto80", _BIZ + """
SELECT c_name, macrosector, revenue, round(cum_value, 4) AS cum_value, round(group_total, 4) AS group_total,
       round(cum_pct, 6) AS cum_pct, ranking FROM (
  SELECT *, 100.0 * cum_value / group_total AS cum_pct FROM (
    SELECT c_name, macrosector, revenue,
           sum(revenue) OVER (PARTITION BY macrosector ORDER BY revenue DESC, c_custkey
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_value,
           sum(revenue) OVER (PARTITION BY macrosector) AS group_total,
           dense_rank() OVER (PARTITION BY macrosector ORDER BY revenue DESC) AS ranking
    FROM biz) a) b
WHERE cum_pct <= 80""")
def pareto80(spark, sf_dir):
    p = ordered.pareto(biz(spark, sf_dir), "macrosector", "revenue", ["c_custkey"], cut=80.0)
    return p.select("c_name", "macrosector", "revenue", r4("cum_value"), r4("group_total"),
                    F.round("cum_pct", 6).alias("cum_pct"), "ranking")


# ---------------------------------------------------------------------------
# Orders per customer
# ---------------------------------------------------------------------------

def _orders_in_year(spark, sf_dir, year: int, *cols):
    o = table(spark, sf_dir, "orders", *cols)
    # half-open range on the raw column: pushed into the parquet scan
    return o.where((F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) &
                   (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))


@register("count_histogram", """
SELECT orders_per_customer, count(*) AS n_customers FROM (
  SELECT o_custkey, count(*) AS orders_per_customer FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
  GROUP BY o_custkey) t GROUP BY orders_per_customer""")
def count_histogram(spark, sf_dir):
    o = _orders_in_year(spark, sf_dir, 1997, "o_custkey", "o_orderdate")
    return agg.count_histogram(o, "o_custkey", bucket="orders_per_customer", n="n_customers")


@register("day_span", """
SELECT o_custkey, date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) AS days_between
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
GROUP BY o_custkey
HAVING date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) > 1""")
def day_span(spark, sf_dir):
    o = _orders_in_year(spark, sf_dir, 1998, "o_custkey", "o_orderdate")
    return agg.day_span(o, "o_custkey", "o_orderdate", 1)


@register("third_txn", """
SELECT o_custkey, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) t
WHERE rn = 3""")
def third_txn(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return windows.nth_per_key(o, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], 3).select(
        "o_custkey", "o_totalprice", "o_orderdate")


# ---------------------------------------------------------------------------
# Events (skills, devices, clicks, balances, calls, cards)
# ---------------------------------------------------------------------------

def _events(spark, sf_dir, *cols):
    return table(spark, sf_dir, "events", *cols)


@register("has_all", """
SELECT user_id, count(DISTINCT event_type) AS n_matched FROM events
WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id
HAVING count(DISTINCT event_type) = 3""")
def has_all(spark, sf_dir):
    return agg.has_all(_events(spark, sf_dir, "user_id", "event_type"), "user_id", "event_type",
                       ["click", "view", "purchase"])


@register("cond_pivot", """
SELECT CAST(count_if(event_type NOT IN ('click', 'view')) AS BIGINT) AS laptop_views,
       CAST(count_if(event_type IN ('click', 'view')) AS BIGINT) AS mobile_views FROM events""")
def cond_pivot(spark, sf_dir):
    e = _events(spark, sf_dir, "event_type")
    return agg.cond_pivot(e, F.col("event_type").isin("click", "view"), "mobile_views", "laptop_views")


@register("ctr", """
SELECT user_id,
       CASE WHEN count_if(event_type = 'view') > 0 THEN
         sign(count_if(event_type = 'click')) * ((2 * 10000 * count_if(event_type = 'click') + count_if(event_type = 'view'))
           // (2 * count_if(event_type = 'view'))) / 100.0 END AS ctr
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'
GROUP BY user_id""")
def ctr(spark, sf_dir):
    # 100 * clicks / views, rounded to 2 decimals exactly (NULL without views)
    e = _events(spark, sf_dir, "user_id", "event_type", "ts").where(
        (F.col("ts") >= F.lit("2024-01-01").cast("timestamp_ntz")) &
        (F.col("ts") < F.lit("2025-01-01").cast("timestamp_ntz")))
    g = e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("_c"),
                                 F.count_if(F.col("event_type") == "view").alias("_v"))
    return g.select("user_id", round_ratio(F.col("_c") * 100, F.col("_v"), 2).cast("double").alias("ctr"))


@register("monthly_avg", f"""
SELECT CAST(month(ts) AS INTEGER) AS mth, user_id, {sql_avg_rounded('value', 2)} AS avg_value
FROM events GROUP BY month(ts), user_id""")
def monthly_avg(spark, sf_dir):
    e = _events(spark, sf_dir, "ts", "user_id", "value")
    return e.groupBy(F.month("ts").alias("mth"), "user_id").agg(avg_rounded(F.col("value"), 2).alias("avg_value")) \
        .orderBy("mth", "user_id")


@register("signed_balance", """
SELECT user_id,
       round(sum(CASE WHEN event_type IN ('purchase', 'error') THEN -value ELSE value END), 4) AS final_balance,
       round(sum(CASE WHEN event_type NOT IN ('purchase', 'error') THEN value ELSE -value END), 4) AS final_balance_alt
FROM events GROUP BY user_id""")
def signed_balance(spark, sf_dir):
    # Every event is one of two transaction kinds: purchases and errors
    # withdraw, all others deposit.  Both formulations of the source agree.
    kind = F.when(F.col("event_type").isin("purchase", "error"), "withdrawal").otherwise("deposit")
    e = _events(spark, sf_dir, "user_id", "event_type", "value").withColumn("kind", kind)
    v = F.col("value")
    return e.groupBy("user_id").agg(
        F.round(F.sum(F.when(F.col("kind") == "withdrawal", -v).otherwise(v)), 4).alias("final_balance"),
        F.round(F.sum(F.when(F.col("kind") == "deposit", v).otherwise(-v)), 4).alias("final_balance_alt"))


@register("keys_with_3plus", """
SELECT count(*) AS n_keys FROM (
  SELECT user_id FROM events GROUP BY user_id HAVING count(user_id) >= 3) t""")
def keys_with_3plus(spark, sf_dir):
    return agg.keys_with_min_rows(_events(spark, sf_dir, "user_id"), "user_id", 3)


@register("group_range", """
SELECT event_type, round(max(value) - min(value), 4) AS difference FROM events GROUP BY event_type""")
def group_range(spark, sf_dir):
    g = agg.group_range(_events(spark, sf_dir, "event_type", "value"), "event_type", "value")
    return g.orderBy(F.col("difference").desc()).select("event_type", r4("difference"))


# emails = orders (one per order, owned by the customer); texts = lineitems,
# confirmed when the line status is 'F', acted on the ship date.
_MAIL = """
WITH emails AS (SELECT o_orderkey AS email_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS signup_date FROM orders),
texts AS (SELECT l_orderkey AS email_id, CAST(l_shipdate AS DATE) AS action_date,
                 CASE WHEN l_linestatus = 'F' THEN 'Confirmed' ELSE 'Not confirmed' END AS signup_action FROM lineitem)
"""


def _emails(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("email_id"), F.col("o_custkey").alias("user_id"),
                    F.to_date("o_orderdate").alias("signup_date"))


def _texts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_shipdate", "l_linestatus")
    return li.select(F.col("l_orderkey").alias("email_id"), F.to_date("l_shipdate").alias("action_date"),
                     F.when(F.col("l_linestatus") == "F", F.lit("Confirmed"))
                      .otherwise(F.lit("Not confirmed")).alias("signup_action"))


@register("confirm_gap_window", _MAIL + """
SELECT user_id, email_id FROM (
  SELECT t.email_id, e.user_id, t.signup_action,
         date_diff('day', min(t.action_date) OVER (PARTITION BY t.email_id),
                          max(t.action_date) OVER (PARTITION BY t.email_id)) AS delta_d
  FROM texts t JOIN emails e ON t.email_id = e.email_id) x
WHERE delta_d = 1 AND signup_action = 'Confirmed'""")
def confirm_gap_window(spark, sf_dir):
    # The per-email span (max - min action date) needs the texts alone: one
    # partial aggregate, then each of its few rows meets the email once per
    # confirmation.
    spans = _texts(spark, sf_dir).groupBy("email_id").agg(
        F.datediff(F.max("action_date"), F.min("action_date")).alias("delta_d"),
        F.count_if(F.col("signup_action") == "Confirmed").cast("int").alias("confirmed"))
    hits = spans.where((F.col("delta_d") == 1) & (F.col("confirmed") > 0)) \
        .select("email_id", F.explode(F.array_repeat(F.lit(1), F.col("confirmed"))).alias("_one"))
    return _emails(spark, sf_dir).join(hits, "email_id").select("user_id", "email_id")


@register("second_day_confirm", _MAIL + """
SELECT DISTINCT e.user_id FROM emails e JOIN texts t ON t.email_id = e.email_id
WHERE t.action_date = e.signup_date + INTERVAL 1 DAY AND t.signup_action = 'Confirmed'""")
def second_day_confirm(spark, sf_dir):
    t = _texts(spark, sf_dir).where(F.col("signup_action") == "Confirmed")
    e = _emails(spark, sf_dir)
    j = joins.offset_date_join(e, t, "email_id", F.col("signup_date"), F.col("action_date"), 1)
    return j.select("user_id").distinct()


# ---------------------------------------------------------------------------
# Pages, trades, job listings, items per order, drugs, salaries
# ---------------------------------------------------------------------------

@register("anti_no_likes", """
SELECT p.page_id FROM pages p WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.page_id)
ORDER BY p.page_id""")
def anti_no_likes(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id")
    l = table(spark, sf_dir, "labels", "doc_id").select(F.col("doc_id").alias("page_id"))
    return joins.anti_join(p, l, "page_id").orderBy("page_id")


@register("top3_joined", """
SELECT n.n_name AS city, count(n.n_name) AS total_orders
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE o.o_orderstatus = 'F'
GROUP BY n.n_name ORDER BY total_orders DESC, city LIMIT 3""")
def top3_joined(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").where(F.col("o_orderstatus") == "F")
    # pre-aggregate orders per customer before joining the customer table
    per_c = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"))
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    j = per_c.join(c, per_c.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    g = j.groupBy(F.col("n_name").alias("city")).agg(F.sum("_n").alias("total_orders"))
    return g.orderBy(F.col("total_orders").desc(), "city").limit(3)


@register("dup_groups", """
SELECT count(*) AS duplicate_groups FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) t""")
def dup_groups(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return agg.duplicate_groups(li, ["l_orderkey", "l_linenumber"])


@register("weighted_mean", """
WITH per_order AS (SELECT l_orderkey, count(*) AS item_count FROM lineitem GROUP BY l_orderkey),
items_per_order AS (SELECT item_count, count(*) AS order_occurrences FROM per_order GROUP BY item_count)
SELECT sign(sum(item_count * order_occurrences))
       * ((2 * 10 * sum(item_count * order_occurrences) + sum(order_occurrences)) // (2 * sum(order_occurrences)))
       / 10.0 AS avg_items
FROM items_per_order""")
def weighted_mean(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey")
    ipo = agg.count_histogram(li, "l_orderkey", bucket="item_count", n="order_occurrences")
    # exact ROUND(sum(x*w)/sum(w), 1) over integer counts
    s = ipo.agg(F.sum(F.col("item_count") * F.col("order_occurrences")).alias("_xw"),
                F.sum("order_occurrences").alias("_w"))
    return s.select(round_ratio(F.col("_xw"), F.col("_w"), 1).cast("double").alias("avg_items"))


_DRUGS = """
WITH sold AS (
  SELECT l_partkey, sum(l_extendedprice) AS total_sales, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey),
pharmacy_sales AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS drug, p.p_brand AS manufacturer, s.total_sales,
         s.qty * p.p_retailprice * 2 AS cogs
  FROM sold s JOIN part p ON p.p_partkey = s.l_partkey)
"""


def pharmacy_sales(spark, sf_dir) -> DataFrame:
    """Per part: sales and cost of goods (twice the list price of the units
    sold, so that some parts run at a loss).  Lineitems are aggregated per part
    first (partial aggregation), so only one row per part meets the join."""
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice", "l_quantity")
    sold = li.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("total_sales"),
                                       F.sum("l_quantity").alias("qty"))
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_retailprice")
    j = sold.join(p, sold.l_partkey == p.p_partkey)
    return j.select(F.col("p_partkey").cast("string").alias("drug"), F.col("p_brand").alias("manufacturer"),
                    "total_sales", (F.col("qty") * F.col("p_retailprice") * 2).alias("cogs"))


@register("top3_profit", _DRUGS + """
SELECT drug, round(total_sales - cogs, 4) AS total_profit FROM pharmacy_sales
ORDER BY total_sales - cogs DESC, drug LIMIT 3""")
def top3_profit(spark, sf_dir):
    ps = pharmacy_sales(spark, sf_dir).withColumn("_p", F.col("total_sales") - F.col("cogs"))
    return ps.orderBy(F.col("_p").desc(), "drug").limit(3).select("drug", F.round("_p", 4).alias("total_profit"))


@register("loss_by_group", _DRUGS + """
SELECT manufacturer, count(drug) AS drug_count, round(abs(sum(total_sales - cogs)), 4) AS total_loss
FROM pharmacy_sales WHERE total_sales - cogs < 0 GROUP BY manufacturer""")
def loss_by_group(spark, sf_dir):
    ps = pharmacy_sales(spark, sf_dir).withColumn("_p", F.col("total_sales") - F.col("cogs")).where(F.col("_p") < 0)
    return ps.groupBy("manufacturer").agg(F.count("drug").alias("drug_count"),
                                          F.round(F.abs(F.sum("_p")), 4).alias("total_loss")) \
        .orderBy(F.col("drug_count").desc())


@register("sales_millions", _DRUGS + """
SELECT manufacturer, '$' || CAST(CAST(round(sum(total_sales) / 1000000, 0) AS BIGINT) AS VARCHAR) || ' million' AS sale
FROM pharmacy_sales GROUP BY manufacturer""")
def sales_millions(spark, sf_dir):
    ps = pharmacy_sales(spark, sf_dir)
    g = ps.groupBy("manufacturer").agg(F.sum("total_sales").alias("_s"))
    return g.orderBy(F.col("_s").desc()).select(
        "manufacturer",
        F.concat(F.lit("$"), F.round(F.col("_s") / 1_000_000, 0).cast("bigint").cast("string"),
                 F.lit(" million")).alias("sale"))


@register("second_highest_dense", """
SELECT p_partkey, p_retailprice AS second_highest FROM (
  SELECT p_partkey, p_retailprice, dense_rank() OVER (ORDER BY p_retailprice DESC) AS r FROM part) t
WHERE r = 2""")
def second_highest_dense(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    return windows.global_dense_top(p, "p_retailprice", 2, only=2).select(
        "p_partkey", F.col("p_retailprice").alias("second_highest"))


@register("second_highest_subquery", """
SELECT max(p_retailprice) AS second_highest FROM part
WHERE p_retailprice < (SELECT max(p_retailprice) FROM part)""")
def second_highest_subquery(spark, sf_dir):
    return joins.max_below_max(table(spark, sf_dir, "part", "p_retailprice"), "p_retailprice", "second_highest")


@register("nested_get", """
SELECT event_type, count(*) AS n_events,
       count(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS n_with_k,
       CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       max(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k
FROM events GROUP BY event_type""")
def nested_get(spark, sf_dir):
    # Null-safe field get from nested text: NULL when the text is not an
    # object or has no such field (the JSON path never raises).
    e = _events(spark, sf_dir, "event_type", "props")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.count(k).alias("n_with_k"),
                                       F.sum(k).alias("sum_k"), F.max(k).alias("max_k"))
