"""Stand-in inputs for the tabular programs (FIXTURES.md section 2).

Browsing sessions: one per (user, day) of ``events``; page counts and durations
are counts and value sums of click / view / purchase rows. Games: one per order
of ``orders``; the paired home/away inputs are arithmetic on order and customer
keys and the order price. Both only shape rows; the operators do the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


def _cnt(kind: str) -> Column:
    return F.count_if(F.col("event_type") == kind).cast("long")


def _dur(kind: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("event_type") == kind, F.col("value"))), F.lit(0.0))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    g = ev.groupBy("user_id", "day").agg(
        _cnt("click").alias("administrative"), _dur("click").alias("administrative_duration"),
        _cnt("view").alias("informational"), _dur("view").alias("informational_duration"),
        _cnt("purchase").alias("product_related"), _dur("purchase").alias("product_related_duration"),
        (F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("bounce_rates"),
        (F.count_if(F.col("event_type") == "signup") / F.count(F.lit(1))).alias("exit_rates"),
        F.coalesce(F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))), F.lit(0.0)).alias("page_values"),
        F.count_if((F.col("event_type") == "purchase") & (F.col("value") > 30)).alias("_big"))
    u = F.col("user_id")
    month = (F.when(u % 3 == 0, F.date_format("day", "MMM"))
             .when(u % 3 == 1, F.concat(F.lit(" "), F.upper(F.date_format("day", "MMMM")), F.lit(" ")))
             .otherwise(F.lower(F.date_format("day", "MMM"))))
    return g.select(
        (u * 1000 + F.datediff("day", F.lit("2024-01-01").cast("date"))).alias("session_id"),
        month.alias("month"), "administrative", "administrative_duration", "informational",
        "informational_duration", "product_related", "product_related_duration", "bounce_rates",
        "exit_rates", "page_values",
        F.when(F.dayofmonth("day") == 14, F.lit(0.6)).otherwise(F.lit(0.0)).alias("special_day"),
        (u % 4 + 1).cast("int").alias("operating_systems"), (u % 6 + 1).cast("int").alias("browser"),
        (u % 9 + 1).cast("int").alias("region"),
        ((u + F.dayofmonth("day")) % 13 + 1).cast("int").alias("traffic_type"),
        F.when(u % 3 == 0, "Returning_Visitor").when(u % 3 == 1, "New_Visitor").otherwise("Other").alias("visitor_type"),
        F.dayofweek("day").isin(1, 7).alias("weekend"),
        (F.col("_big") > 0).cast("int").alias("purchased"))


SQL_SESSIONS = """
SELECT user_id * 1000 + datediff('day', DATE '2024-01-01', day) AS session_id,
  CASE WHEN user_id % 3 = 0 THEN strftime(day, '%b') WHEN user_id % 3 = 1 THEN ' ' || upper(strftime(day, '%B')) || ' '
       ELSE lower(strftime(day, '%b')) END AS month,
  administrative, administrative_duration, informational, informational_duration, product_related,
  product_related_duration, bounce_rates, exit_rates, page_values,
  CASE WHEN dayofmonth(day) = 14 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END AS special_day,
  CAST(user_id % 4 + 1 AS INTEGER) AS operating_systems, CAST(user_id % 6 + 1 AS INTEGER) AS browser,
  CAST(user_id % 9 + 1 AS INTEGER) AS region, CAST((user_id + dayofmonth(day)) % 13 + 1 AS INTEGER) AS traffic_type,
  CASE WHEN user_id % 3 = 0 THEN 'Returning_Visitor' WHEN user_id % 3 = 1 THEN 'New_Visitor' ELSE 'Other' END AS visitor_type,
  dayofweek(day) IN (0, 6) AS weekend, CAST(big > 0 AS INTEGER) AS purchased
FROM (SELECT user_id, CAST(ts AS DATE) AS day,
        count(*) FILTER (WHERE event_type = 'click') AS administrative,
        coalesce(sum(value) FILTER (WHERE event_type = 'click'), 0.0) AS administrative_duration,
        count(*) FILTER (WHERE event_type = 'view') AS informational,
        coalesce(sum(value) FILTER (WHERE event_type = 'view'), 0.0) AS informational_duration,
        count(*) FILTER (WHERE event_type = 'purchase') AS product_related,
        coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0.0) AS product_related_duration,
        count(*) FILTER (WHERE event_type = 'error') / count(*) AS bounce_rates,
        count(*) FILTER (WHERE event_type = 'signup') / count(*) AS exit_rates,
        coalesce(avg(value) FILTER (WHERE event_type = 'purchase'), 0.0) AS page_values,
        count(*) FILTER (WHERE event_type = 'purchase' AND value > 30) AS big
      FROM events GROUP BY user_id, CAST(ts AS DATE))"""


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    p = F.col("o_totalprice") / F.lit(1000.0)
    cols = {
        "id": k, "season": F.year("o_orderdate").cast("int"), "home_margin": p - F.lit(150.0),
        "elo_diff": ((c % 200) - 100).cast("double"),
        "home_margin_roll5": p / 5, "away_margin_roll5": (c % 97) / 3.0,
        "home_margin_roll20": p / 20, "away_margin_roll20": (c % 89) / 7.0,
    }
    for n in (5, 10, 20):
        cols[f"home_pts_roll{n}"] = p / n
        cols[f"home_opp_pts_roll{n}"] = (k % 101) / float(n)
        cols[f"away_pts_roll{n}"] = (c % 103) / float(n)
        cols[f"away_opp_pts_roll{n}"] = (c % 107) / float(n)
    cols.update({
        "home_win_roll5": (k % 6) / 5.0, "away_win_roll5": (c % 6) / 5.0,
        "home_win_roll10": (k % 11) / 10.0, "away_win_roll10": (c % 11) / 10.0,
        "home_elo_delta_prev1": ((k % 13) - 6).cast("double"), "away_elo_delta_prev1": ((c % 13) - 6).cast("double"),
        "home_elo_delta_roll5": (k % 17) / 4.0, "away_elo_delta_roll5": (c % 17) / 4.0,
        "home_roll_missing_10": F.col("o_orderstatus") == "P",
        "away_roll_missing_10": F.col("o_orderpriority") == "1-URGENT",
        "home_roll_missing_20": F.col("o_orderstatus") == "F",
        "away_roll_missing_20": F.col("o_orderpriority") == "5-LOW",
    })
    return o.select(*[v.alias(n) for n, v in cols.items()])


def _sql_games() -> str:
    p = "(o_totalprice / 1000.0::DOUBLE)"
    cols = [
        "o_orderkey AS id", "CAST(year(o_orderdate) AS INTEGER) AS season", f"{p} - 150.0::DOUBLE AS home_margin",
        "CAST((o_custkey % 200) - 100 AS DOUBLE) AS elo_diff",
        f"{p} / 5 AS home_margin_roll5", "(o_custkey % 97) / 3.0::DOUBLE AS away_margin_roll5",
        f"{p} / 20 AS home_margin_roll20", "(o_custkey % 89) / 7.0::DOUBLE AS away_margin_roll20",
    ]
    for n in (5, 10, 20):
        cols += [f"{p} / {n} AS home_pts_roll{n}", f"(o_orderkey % 101) / {n}.0::DOUBLE AS home_opp_pts_roll{n}",
                 f"(o_custkey % 103) / {n}.0::DOUBLE AS away_pts_roll{n}",
                 f"(o_custkey % 107) / {n}.0::DOUBLE AS away_opp_pts_roll{n}"]
    cols += [
        "(o_orderkey % 6) / 5.0::DOUBLE AS home_win_roll5", "(o_custkey % 6) / 5.0::DOUBLE AS away_win_roll5",
        "(o_orderkey % 11) / 10.0::DOUBLE AS home_win_roll10", "(o_custkey % 11) / 10.0::DOUBLE AS away_win_roll10",
        "CAST((o_orderkey % 13) - 6 AS DOUBLE) AS home_elo_delta_prev1",
        "CAST((o_custkey % 13) - 6 AS DOUBLE) AS away_elo_delta_prev1",
        "(o_orderkey % 17) / 4.0::DOUBLE AS home_elo_delta_roll5", "(o_custkey % 17) / 4.0::DOUBLE AS away_elo_delta_roll5",
        "o_orderstatus = 'P' AS home_roll_missing_10", "o_orderpriority = '1-URGENT' AS away_roll_missing_10",
        "o_orderstatus = 'F' AS home_roll_missing_20", "o_orderpriority = '5-LOW' AS away_roll_missing_20",
    ]
    return "SELECT " + ", ".join(cols) + " FROM orders"


SQL_GAMES = _sql_games()
