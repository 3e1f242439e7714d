"""Window analytics. Frames are written out and every order has a tie-breaker."""

from sparkwell.operators.ordered import (
    join_back, latest_per_key, over_rows, running, top_per_group, with_group_stats, with_ntile, with_peers,
    with_row_number,
)
from sparkwell.plans.common import F, Tables, Window, big, col, day, lit, query, rows, when

PRICE = [("p_retailprice", "desc"), ("p_partkey", "asc")]


def priced(t: Tables):
    return t.part.select("p_partkey", "p_brand", "p_retailprice")


def daily_freight(t: Tables, *keys):
    """Freight per day: a window over days is bounded by the calendar, not by the orders."""
    return t.orders.groupBy(*keys, day("o_orderdate").alias("order_day")).agg(
        F.sum("o_totalprice").alias("freight"), rows().alias("orders")
    )


DAILY_SQL = "(SELECT CAST(o_orderdate AS DATE) AS order_day, SUM(o_totalprice) AS freight, COUNT(*) AS orders FROM orders GROUP BY 1)"


def monthly_orders(t: Tables):
    month = [big(F.year("o_orderdate")).alias("y"), big(F.month("o_orderdate")).alias("m")]
    return t.orders.groupBy(*month).agg(rows().alias("orders"), F.sum("o_totalprice").alias("freight"))


MONTHLY_SQL = "(SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, COUNT(*) AS orders, SUM(o_totalprice) AS freight FROM orders GROUP BY 1, 2)"


@query("win_row_number", "SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part")
def win_row_number(t: Tables):
    return with_row_number(t.part.select("p_partkey", "p_retailprice"), [], PRICE).drop("p_retailprice")


@query(
    "win_row_number_partition",
    "SELECT p_partkey, p_brand, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part",
)
def win_row_number_partition(t: Tables):
    return with_row_number(priced(t), ["p_brand"], PRICE).drop("p_retailprice")


@query("win_rank", "SELECT p_partkey, RANK() OVER (ORDER BY p_retailprice DESC) AS place FROM part")
def win_rank(t: Tables):
    ranked = with_peers(t.part.select("p_partkey", "p_retailprice"), [], [("p_retailprice", "desc")], rank="place")
    return ranked.drop("p_retailprice")


@query(
    "win_dense_rank",
    "SELECT p_partkey, p_brand, DENSE_RANK() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS place FROM part",
)
def win_dense_rank(t: Tables):
    return with_peers(priced(t), ["p_brand"], [("p_retailprice", "desc")], dense_rank="place").drop("p_retailprice")


@query("win_ntile", "SELECT p_partkey, NTILE(4) OVER (ORDER BY p_retailprice DESC, p_partkey) AS tile FROM part")
def win_ntile(t: Tables):
    return with_ntile(t.part.select("p_partkey", "p_retailprice"), [], PRICE, 4).drop("p_retailprice")


@query(
    "win_rank_compare",
    """SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_size DESC, p_partkey) AS rn, RANK() OVER (ORDER BY p_size DESC) AS rk,
              DENSE_RANK() OVER (ORDER BY p_size DESC) AS drk, NTILE(4) OVER (ORDER BY p_size DESC, p_partkey) AS tile FROM part""",
)
def win_rank_compare(t: Tables):
    order = [("p_size", "desc"), ("p_partkey", "asc")]
    numbered = with_row_number(t.part.select("p_partkey", "p_size"), [], order)
    ranked = with_peers(numbered, [], [("p_size", "desc")], rank="rk", dense_rank="drk")
    return with_ntile(ranked, [], order, 4).drop("p_size")


@query(
    "win_rank_over_aggregate",
    "SELECT o_custkey, COUNT(*) AS n, RANK() OVER (ORDER BY COUNT(*) DESC) AS place FROM orders GROUP BY 1",
)
def win_rank_over_aggregate(t: Tables):
    return with_peers(t.orders.groupBy("o_custkey").agg(rows().alias("n")), [], [("n", "desc")], rank="place")


@query(
    "topn_per_group",
    """SELECT p_brand, p_partkey, rn FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn
       FROM part) WHERE rn <= 3""",
)
def topn_per_group(t: Tables):
    return top_per_group(priced(t), ["p_brand"], PRICE, 3).drop("p_retailprice")


@query(
    "dedup_keep_latest",
    """SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events) WHERE rn = 1""",
)
def dedup_keep_latest(t: Tables):
    return latest_per_key(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "tier_by_ntile",
    """SELECT p_partkey, CASE NTILE(3) OVER (ORDER BY p_retailprice, p_partkey) WHEN 1 THEN 'Budget' WHEN 2 THEN 'Standard'
       ELSE 'Premium' END AS tier FROM part""",
)
def tier_by_ntile(t: Tables):
    tiles = with_ntile(t.part.select("p_partkey", "p_retailprice"), [], [("p_retailprice", "asc"), ("p_partkey", "asc")], 3)
    tier = when(col("tile") == 1, "Budget").when(col("tile") == 2, "Standard").otherwise("Premium")
    return tiles.select("p_partkey", tier.alias("tier"))


@query(
    "median_row_per_group",
    """SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS rn,
       COUNT(*) OVER (PARTITION BY p_brand) AS n FROM part) WHERE rn = (n + 1) // 2""",
)
def median_row_per_group(t: Tables):
    numbered = with_row_number(priced(t), ["p_brand"], [("p_retailprice", "asc"), ("p_partkey", "asc")])
    sized = with_group_stats(numbered, ["p_brand"], n=rows())
    return sized.filter(col("rn") == F.floor((col("n") + 1) / 2)).drop("rn", "n")


@query(
    "running_rank",
    f"""WITH c AS (SELECT order_day, orders, SUM(orders) OVER (ORDER BY order_day ROWS UNBOUNDED PRECEDING) AS to_date FROM {DAILY_SQL})
        SELECT order_day, CAST(to_date AS BIGINT) AS orders_to_date, RANK() OVER (ORDER BY to_date DESC) AS place FROM c""",
)
def running_rank(t: Tables):
    days = running(daily_freight(t), [], [("order_day", "asc")], {"orders_to_date": ("sum", col("orders"))})
    return with_peers(days, [], [("orders_to_date", "desc")], rank="place").select("order_day", "orders_to_date", "place")


@query(
    "win_running_total",
    """SELECT o_orderkey, round(SUM(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running_total
       FROM orders""",
)
def win_running_total(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    total = running(orders, [], [("o_orderdate", "asc"), ("o_orderkey", "asc")], {"running_total": ("sum", col("o_totalprice"))})
    return total.select("o_orderkey", F.round("running_total", 2).alias("running_total"))


@query(
    "win_share_of_group",
    "SELECT p_partkey, p_brand, round(p_size * 100.0 / SUM(p_size) OVER (PARTITION BY p_brand), 6) AS pct FROM part",
)
def win_share_of_group(t: Tables):
    sized = t.part.select("p_partkey", "p_brand", "p_size")
    stats = with_group_stats(sized, ["p_brand"], total=F.sum("p_size"))
    return stats.select("p_partkey", "p_brand", F.round(col("p_size") * 100.0 / col("total"), 6).alias("pct"))


@query(
    "win_multi",
    """SELECT p_partkey, round(AVG(p_retailprice) OVER (), 6) AS overall, round(AVG(p_retailprice) OVER (PARTITION BY p_brand), 6) AS in_brand,
              round(p_retailprice - AVG(p_retailprice) OVER (PARTITION BY p_brand), 6) AS diff FROM part""",
)
def win_multi(t: Tables):
    overall = with_group_stats(priced(t), [], overall=F.avg("p_retailprice"))
    both = with_group_stats(overall, ["p_brand"], in_brand=F.avg("p_retailprice"))
    return both.select(
        "p_partkey", F.round("overall", 6).alias("overall"), F.round("in_brand", 6).alias("in_brand"),
        F.round(col("p_retailprice") - col("in_brand"), 6).alias("diff"),
    )


@query(
    "win_running_count",
    """SELECT o_orderkey, COUNT(*) OVER (ORDER BY o_orderdate RANGE UNBOUNDED PRECEDING) AS with_peers,
              COUNT(*) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS by_row FROM orders""",
)
def win_running_count(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderdate")
    counted = with_peers(orders, [], [("o_orderdate", "asc")], sums={"with_peers": lit(1)})
    return with_row_number(counted, [], [("o_orderdate", "asc"), ("o_orderkey", "asc")], "by_row").drop("o_orderdate")


@query(
    "win_default_frame",
    """SELECT p_partkey, CAST(SUM(p_size) OVER (ORDER BY p_retailprice) AS BIGINT) AS range_total,
              CAST(SUM(p_size) OVER (ORDER BY p_retailprice, p_partkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS rows_total FROM part""",
)
def win_default_frame(t: Tables):
    parts = t.part.select("p_partkey", "p_retailprice", "p_size")
    ranged = with_peers(parts, [], [("p_retailprice", "asc")], sums={"range_total": col("p_size")})
    order = [("p_retailprice", "asc"), ("p_partkey", "asc")]
    return running(ranged, [], order, {"rows_total": ("sum", col("p_size"))}).select("p_partkey", "range_total", "rows_total")


@query(
    "win_lag",
    """SELECT o_orderkey, LAG(o_totalprice) OVER w AS previous, round(o_totalprice - LAG(o_totalprice) OVER w, 2) AS diff FROM orders
       WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""",
)
def win_lag(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    order = [("o_orderdate", "asc"), ("o_orderkey", "asc")]
    lagged = over_rows(orders, [], order, {"previous": lambda w: F.lag("o_totalprice").over(w)}, before=1)
    return lagged.select("o_orderkey", "previous", F.round(col("o_totalprice") - col("previous"), 2).alias("diff"))


@query(
    "win_month_over_month",
    f"SELECT y, m, orders, orders - LAG(orders) OVER (ORDER BY y, m) AS change FROM {MONTHLY_SQL}",
)
def win_month_over_month(t: Tables):
    w = Window.orderBy("y", "m")  # one row per month
    return monthly_orders(t).select("y", "m", "orders", (col("orders") - F.lag("orders").over(w)).alias("change"))


@query(
    "win_lag_n",
    f"SELECT y, m, orders, LAG(orders) OVER (ORDER BY y, m) AS one_back, LAG(orders, 2) OVER (ORDER BY y, m) AS two_back FROM {MONTHLY_SQL}",
)
def win_lag_n(t: Tables):
    w = Window.orderBy("y", "m")  # one row per month
    return monthly_orders(t).select(
        "y", "m", "orders", F.lag("orders").over(w).alias("one_back"), F.lag("orders", 2).over(w).alias("two_back")
    )


CUSTOMER_ORDER = [("o_orderdate", "asc"), ("o_orderkey", "asc")]


@query(
    "win_lead_gap",
    """SELECT o_orderkey, o_custkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(LEAD(o_orderdate)
              OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE)) AS days_to_next FROM orders""",
)
def win_lead_gap(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    nexts = over_rows(orders, ["o_custkey"], CUSTOMER_ORDER, {"nxt": lambda w: F.lead("o_orderdate").over(w)}, after=1)
    return nexts.select("o_orderkey", "o_custkey", big(F.datediff("nxt", "o_orderdate")).alias("days_to_next"))


@query(
    "win_first_value",
    """SELECT p_partkey, FIRST_VALUE(p_name) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS cheapest FROM part""",
)
def win_first_value(t: Tables):
    parts = t.part.select("p_partkey", "p_brand", "p_name", "p_retailprice")
    first = F.min_by("p_name", F.struct("p_retailprice", "p_partkey"))
    return with_group_stats(parts, ["p_brand"], cheapest=first).select("p_partkey", "cheapest")


@query(
    "win_last_value",
    """SELECT p_partkey, LAST_VALUE(p_name) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS dearest FROM part""",
)
def win_last_value(t: Tables):
    parts = t.part.select("p_partkey", "p_brand", "p_name", "p_retailprice")
    last = F.max_by("p_name", F.struct("p_retailprice", "p_partkey"))
    return with_group_stats(parts, ["p_brand"], dearest=last).select("p_partkey", "dearest")


@query(
    "win_best_worst",
    """SELECT p_partkey, MIN(p_retailprice) OVER (PARTITION BY p_brand) AS lo, MAX(p_retailprice) OVER (PARTITION BY p_brand) AS hi,
              round(MAX(p_retailprice) OVER (PARTITION BY p_brand) - MIN(p_retailprice) OVER (PARTITION BY p_brand), 2) AS spread FROM part""",
)
def win_best_worst(t: Tables):
    stats = with_group_stats(priced(t), ["p_brand"], lo=F.min("p_retailprice"), hi=F.max("p_retailprice"))
    return stats.select("p_partkey", "lo", "hi", F.round(col("hi") - col("lo"), 2).alias("spread"))


@query(
    "retention_status",
    """WITH g AS (SELECT o_orderkey, o_custkey, date_diff('day', CAST(LAG(o_orderdate) OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate, o_orderkey) AS DATE), CAST(o_orderdate AS DATE)) AS gap FROM orders)
       SELECT *, CASE WHEN gap > 90 THEN 'At Risk' WHEN gap > 30 THEN 'Moderate' ELSE 'Active' END AS status FROM g WHERE gap IS NOT NULL""",
)
def retention_status(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    lagged = over_rows(orders, ["o_custkey"], CUSTOMER_ORDER, {"prev": lambda w: F.lag("o_orderdate").over(w)}, before=1)
    gap = big(F.datediff("o_orderdate", "prev"))
    status = when(col("gap") > 90, "At Risk").when(col("gap") > 30, "Moderate").otherwise("Active")
    return lagged.select("o_orderkey", "o_custkey", gap.alias("gap")).filter("gap IS NOT NULL").withColumn("status", status)


@query(
    "price_change",
    """WITH h AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_day, MAX(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2),
            d AS (SELECT *, LAG(price) OVER (PARTITION BY l_partkey ORDER BY ship_day) AS old_price FROM h)
       SELECT l_partkey, ship_day, price, old_price, round(price - old_price, 2) AS change,
              round((price - old_price) * 100 / old_price, 6) AS pct FROM d""",
)
def price_change(t: Tables):
    history = t.lineitem.groupBy("l_partkey", day("l_shipdate").alias("ship_day")).agg(F.max("l_extendedprice").alias("price"))
    w = Window.partitionBy("l_partkey").orderBy("ship_day")  # at most one row per part and day
    lagged = history.withColumn("old_price", F.lag("price").over(w))
    diff = col("price") - col("old_price")
    return lagged.withColumns({"change": F.round(diff, 2), "pct": F.round(diff * 100 / col("old_price"), 6)})


@query(
    "sessionize_lag",
    """WITH g AS (SELECT event_id, user_id, ts, date_diff('minute', LAG(ts) OVER w, ts) AS gap FROM events
                  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
            f AS (SELECT *, CASE WHEN gap IS NULL OR gap > 360 THEN 1 ELSE 0 END AS is_new FROM g)
       SELECT event_id, user_id, CAST(is_new AS BIGINT) AS is_new,
              CAST(SUM(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM f""",
)
def sessionize_lag(t: Tables):
    """Minute boundaries crossed since the last event; above 360 starts a session (30 is usual for web sessions)."""
    order = [("ts", "asc"), ("event_id", "asc")]
    events = t.events.select("event_id", "user_id", "ts")
    lagged = over_rows(events, ["user_id"], order, {"prev": lambda w: F.lag("ts").over(w)}, before=1)
    minute = lambda c: F.unix_timestamp(F.date_trunc("minute", col(c)).cast("timestamp"))
    gap = (minute("ts") - minute("prev")) / 60
    flagged = lagged.withColumn("is_new", when(col("prev").isNull() | (gap > 360), 1).otherwise(0).cast("bigint"))
    numbered = running(flagged, ["user_id"], order, {"session_no": ("sum", col("is_new"))})
    return numbered.select("event_id", "user_id", "is_new", "session_no")


def day_frame(lo, hi):
    """A ROWS frame over one row per day."""
    return Window.orderBy("order_day").rowsBetween(lo, hi)


@query(
    "moving_average",
    f"SELECT order_day, round(AVG(freight) OVER (ORDER BY order_day ROWS 6 PRECEDING), 6) AS avg7 FROM {DAILY_SQL}",
)
def moving_average(t: Tables):
    return daily_freight(t).select("order_day", F.round(F.avg("freight").over(day_frame(-6, 0)), 6).alias("avg7"))


@query(
    "centered_average",
    """SELECT o_orderkey, round(AVG(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS avg3
       FROM orders""",
)
def centered_average(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    avg3 = {"avg3": lambda w: F.round(F.avg("o_totalprice").over(w.rowsBetween(-1, 1)), 6)}
    return over_rows(orders, [], CUSTOMER_ORDER, avg3, before=1, after=1).select("o_orderkey", "avg3")


@query(
    "moving_min_max",
    """SELECT o_orderkey, MIN(o_totalprice) OVER w AS lo, MAX(o_totalprice) OVER w AS hi FROM orders
       WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS 4 PRECEDING)""",
)
def moving_min_max(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    frame = {
        "lo": lambda w: F.min("o_totalprice").over(w.rowsBetween(-4, 0)),
        "hi": lambda w: F.max("o_totalprice").over(w.rowsBetween(-4, 0)),
    }
    return over_rows(orders, [], CUSTOMER_ORDER, frame, before=4).select("o_orderkey", "lo", "hi")


@query(
    "rolling_30_days",
    """SELECT o_orderkey, o_custkey, round(SUM(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
              RANGE INTERVAL 30 DAY PRECEDING), 2) AS spend_30d FROM orders""",
)
def rolling_30_days(t: Tables):
    """Combined per customer and day first, so a frame holds at most 31 rows."""
    days = daily_freight(t, "o_custkey").withColumn("_d", F.unix_date("order_day"))
    frame = Window.partitionBy("o_custkey").orderBy("_d").rangeBetween(-30, 0)
    spend = days.select("o_custkey", "order_day", F.round(F.sum("freight").over(frame), 2).alias("spend_30d"))
    orders = t.orders.select("o_orderkey", "o_custkey", day("o_orderdate").alias("order_day"))
    return join_back(orders, spend, ["o_custkey", "order_day"]).drop("order_day")


@query(
    "ytd_total",
    f"SELECT y, m, round(SUM(freight) OVER (PARTITION BY y ORDER BY m ROWS UNBOUNDED PRECEDING), 2) AS ytd FROM {MONTHLY_SQL}",
)
def ytd_total(t: Tables):
    w = Window.partitionBy("y").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)  # twelve rows a year
    return monthly_orders(t).select("y", "m", F.round(F.sum("freight").over(w), 2).alias("ytd"))


@query(
    "percent_of_running_total",
    f"""SELECT order_day, round(100 * SUM(freight) OVER (ORDER BY order_day ROWS UNBOUNDED PRECEDING) / SUM(freight) OVER (), 6) AS pct
        FROM {DAILY_SQL}""",
)
def percent_of_running_total(t: Tables):
    so_far = F.sum("freight").over(day_frame(Window.unboundedPreceding, 0))
    all_days = F.sum("freight").over(day_frame(Window.unboundedPreceding, Window.unboundedFollowing))
    return daily_freight(t).select("order_day", F.round(100 * so_far / all_days, 6).alias("pct"))


@query(
    "gaps_and_islands",
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
            r AS (SELECT *, d - CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS island FROM d)
       SELECT user_id, MIN(d) AS first_day, MAX(d) AS last_day, COUNT(*) AS days FROM r GROUP BY user_id, island HAVING COUNT(*) >= 4""",
)
def gaps_and_islands(t: Tables):
    days = t.events.select("user_id", day("ts").alias("d")).distinct()
    w = Window.partitionBy("user_id").orderBy("d")  # one row per user and day
    islands = days.withColumn("island", F.date_sub("d", F.row_number().over(w)))
    spans = islands.groupBy("user_id", "island").agg(
        F.min("d").alias("first_day"), F.max("d").alias("last_day"), rows().alias("days")
    )
    return spans.filter("days >= 4").drop("island")


@query(
    "groups_frame",
    """SELECT p_partkey, CAST(SUM(p_size) OVER (ORDER BY p_retailprice GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS BIGINT) AS two_groups
       FROM part""",
)
def groups_frame(t: Tables):
    """Peer groups are combined first; a GROUPS frame is then a ROWS frame over groups."""
    groups = t.part.groupBy("p_retailprice").agg(F.sum("p_size").alias("s"))
    frame = {"two_groups": lambda w: F.sum("s").over(w.rowsBetween(-1, 0))}
    summed = over_rows(groups, [], [("p_retailprice", "asc")], frame, before=1)
    return join_back(t.part.select("p_partkey", "p_retailprice"), summed.drop("s"), ["p_retailprice"]).drop("p_retailprice")
