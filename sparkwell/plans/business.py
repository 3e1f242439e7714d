"""Business questions: news desk, code hosting, ride hailing and energy meters.

"Now" is always a parameter that is resolved when the query runs.
"""

import functools
import hashlib
from datetime import date, datetime, timedelta

from pyspark.sql import Column

from sparkwell.operators.cubes import Cube, CubeStore
from sparkwell.operators.ordered import exact_percentiles, latest_per_key, over_rows, top_per_group
from sparkwell.operators.pairs import overlapping_pairs
from sparkwell.plans.common import F, Tables, big, col, day, lit, query, rows, when
from sparkwell.plans.joins import FUNNEL_SQL, funnel_events, step_counts
from sparkwell.session import shared_path, shared_root
from sparkwell.sources.ledger import deliveries, landed
from sparkwell.sources.sinks import replace_partitions
from sparkwell.sources.versioned import VersionedTable

# --- news desk: events with the user's nation as country, the JSON number modulo 12 as theme


def ntz(text):
    return lit(text).cast("timestamp_ntz")


def news(t: Tables):
    country = t.customer.select(col("c_custkey"), F.concat(lit("C"), col("c_nationkey").cast("string")).alias("country"))
    k = F.get_json_object("props", "$.k").cast("int")
    events = t.events.select("event_id", "ts", "event_type", "value", "user_id", (k % 12).alias("theme"), (k % 5).alias("target"))
    return events.join(country, col("user_id") == col("c_custkey")).drop("c_custkey")


NEWS_SQL = """n AS (SELECT event_id, ts, event_type, value, user_id, CAST(json_extract(props, '$.k') AS INTEGER) % 12 AS theme,
  CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS target, 'C' || c_nationkey AS country FROM events JOIN customer ON user_id = c_custkey)"""


@query(
    "gdelt_protest_hotspots",
    f"""WITH {NEWS_SQL} SELECT country, COUNT(*) AS events FROM n WHERE event_type IN ('error', 'click') AND ts >= TIMESTAMP '2024-01-28'
         AND ts < TIMESTAMP '2024-01-29' GROUP BY 1 ORDER BY events DESC, country LIMIT 10""",
)
def gdelt_protest_hotspots(t: Tables, today: str = "2024-01-29"):
    yesterday = (col("ts") >= ntz(today) - F.expr("INTERVAL 1 DAY")) & (col("ts") < ntz(today))
    unrest = news(t).filter(col("event_type").isin("error", "click") & yesterday)
    return unrest.groupBy("country").agg(rows().alias("events")).orderBy(col("events").desc(), "country").limit(10)


@query(
    "gdelt_bilateral_trend",
    f"WITH {NEWS_SQL} SELECT CAST(ts AS DATE) AS day, country AS actor, target, round(AVG(value), 6) AS intensity, COUNT(*) AS n FROM n GROUP BY 1, 2, 3",
)
def gdelt_bilateral_trend(t: Tables):
    """Daily mean intensity of every actor and target pair."""
    return news(t).groupBy(day("ts").alias("day"), col("country").alias("actor"), "target").agg(
        F.round(F.avg("value"), 6).alias("intensity"), rows().alias("n")
    )


@query(
    "gdelt_theme_surge",
    f"""WITH {NEWS_SQL}, c AS (SELECT theme, COUNT(CASE WHEN ts >= TIMESTAMP '2024-01-29' THEN 1 END) AS last_day,
          COUNT(CASE WHEN ts < TIMESTAMP '2024-01-29' THEN 1 END) / 7.0 AS baseline FROM n WHERE ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-30' GROUP BY 1)
        SELECT theme, last_day, round(baseline, 6) AS baseline, round(last_day / baseline, 6) AS growth FROM c WHERE baseline > 0 ORDER BY last_day / baseline DESC, theme LIMIT 10""",
)
def gdelt_theme_surge(t: Tables, now: str = "2024-01-30"):
    """Last 24 hours against a seventh of the seven days before; both sides are returned."""
    cut = ntz(now) - F.expr("INTERVAL 1 DAY")
    window = (col("ts") >= cut - F.expr("INTERVAL 7 DAYS")) & (col("ts") < ntz(now))
    counts = news(t).filter(window).groupBy("theme").agg(
        F.count_if(col("ts") >= cut).alias("last_day"), (F.count_if(col("ts") < cut) / 7.0).alias("baseline")
    )
    growth = counts.filter("baseline > 0").withColumn("growth", col("last_day") / col("baseline"))
    top = growth.orderBy(col("growth").desc(), "theme").limit(10)
    return top.select("theme", "last_day", F.round("baseline", 6).alias("baseline"), F.round("growth", 6).alias("growth"))


@query(
    "gdelt_outlet_amplification",
    """WITH r AS (SELECT l_suppkey AS outlet, COUNT(*) AS mentions, COUNT(DISTINCT l_orderkey) AS events FROM lineitem GROUP BY 1)
       SELECT outlet, mentions, events, round(mentions / events, 6) AS ratio, mentions / events > (SELECT median(mentions / events) FROM r) AS above_median FROM r""",
)
def gdelt_outlet_amplification(t: Tables):
    """Mentions per distinct event of each outlet, against the median outlet."""
    ratios = t.lineitem.groupBy(col("l_suppkey").alias("outlet")).agg(
        rows().alias("mentions"), F.countDistinct("l_orderkey").alias("events")
    ).withColumn("ratio", col("mentions") / col("events"))
    median = exact_percentiles(ratios.select("ratio"), [], "ratio", {"p50": 0.5}).select("p50").scalar()
    flagged = ratios.withColumn("above_median", col("ratio") > median)
    return flagged.withColumn("ratio", F.round("ratio", 6))


@query(
    "gdelt_geo_overlay",
    """WITH e AS (SELECT CAST(floor(c_acctbal / 100) AS BIGINT) AS lat_cell, CAST(floor(value / 10) AS BIGINT) AS lon_cell, c_nationkey AS country, COUNT(*) AS events
                  FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2, 3),
            a AS (SELECT CAST(replace(source, 'src', '') AS INTEGER) AS country, COUNT(*) AS articles FROM documents WHERE lang = 'fr' GROUP BY 1)
       SELECT e.*, COALESCE(articles, 0) AS protest_articles_in_country FROM e LEFT JOIN a USING (country)""",
)
def gdelt_geo_overlay(t: Tables):
    """Events per one-degree cell beside the protest articles of the cell's country; articles carry no position."""
    people = t.customer.select("c_custkey", (col("c_acctbal") / 100).alias("lat"), col("c_nationkey").alias("country"))
    placed = t.events.join(people, col("user_id") == col("c_custkey"))
    cells = placed.groupBy(F.floor("lat").alias("lat_cell"), F.floor(col("value") / 10).alias("lon_cell"), "country").agg(rows().alias("events"))
    country = F.regexp_extract("source", r"src(\d+)", 1).cast("int")
    articles = t.documents.filter("lang = 'fr'").groupBy(country.alias("country")).agg(rows().alias("articles"))
    joined = cells.join(articles, "country", "left")
    return joined.select(
        "lat_cell", "lon_cell", "country", "events", F.coalesce("articles", lit(0)).alias("protest_articles_in_country")
    )


@query(
    "gdelt_self_audit",
    """WITH p AS (SELECT event_id, ts, event_id - CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END AS slice FROM events),
            f AS (SELECT ts, slice = LAG(slice) OVER (ORDER BY ts, event_id) AS stale FROM p)
       SELECT CAST(ts AS DATE) AS day, COUNT(*) AS polls, round(AVG(CASE WHEN stale THEN 1.0 ELSE 0.0 END), 6) AS degraded FROM f GROUP BY 1""",
)
def gdelt_self_audit(t: Tables):
    """Share of polls per day in which the manifest repeated its last slice."""
    stale_by = when(col("event_id") % 5 == 4, 1).otherwise(0)
    polls = t.events.select("event_id", "ts", (col("event_id") - stale_by).alias("slice"))
    lagged = over_rows(polls, [], [("ts", "asc"), ("event_id", "asc")], {"prev": lambda w: F.lag("slice").over(w)}, before=1)
    stale = F.coalesce(col("slice") == col("prev"), lit(False)).cast("double")
    return lagged.groupBy(day("ts").alias("day")).agg(rows().alias("polls"), F.round(F.avg(stale), 6).alias("degraded"))


@query(
    "gdelt_partial_slice_view",
    """WITH e AS (SELECT date_trunc('hour', ts) AS slice, event_id, event_type FROM events),
            m AS (SELECT date_trunc('hour', ts) AS slice, event_id, COUNT(*) AS mentions FROM events JOIN range(2) r(i) ON i <= event_id % 2 WHERE hour(ts) % 5 <> 0 GROUP BY 1, 2)
       SELECT CAST(e.slice AS TIMESTAMP) AS slice, e.event_id, COALESCE(mentions, 0) AS mentions, hour(e.slice) % 5 <> 0 AS complete FROM e LEFT JOIN m USING (slice, event_id)""",
)
def gdelt_partial_slice_view(t: Tables):
    """Events whose mention file is still missing stay visible; a file delivered twice counts once."""
    slice_ = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slice")
    events = t.events.select(slice_, "event_id")
    events = events.unionByName(events.filter("event_id % 6 = 0")).dropDuplicates(["slice", "event_id"])
    copies = F.explode(F.sequence(lit(0), (col("event_id") % 2).cast("int")))
    mentions = t.events.filter(F.hour("ts") % 5 != 0).select(slice_, "event_id", copies.alias("mention_no"))
    again = mentions.unionByName(mentions.filter("event_id % 4 = 1")).dropDuplicates(["slice", "event_id", "mention_no"])
    counts = again.groupBy("slice", "event_id").agg(rows().alias("n"))
    arrived = again.select("slice", lit(True).alias("has_mentions")).distinct()
    view = events.join(counts, ["slice", "event_id"], "left").join(arrived, "slice", "left")
    return view.select("slice", "event_id", F.coalesce("n", lit(0)).alias("mentions"), F.coalesce("has_mentions", lit(False)).alias("complete"))


# --- code hosting: a line is a pull request by the order's customer on the supplier's repository


def pulls(t: Tables):
    """The author is the opener (customer); the closing actor is someone else and is not used."""
    joined = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
    return joined.select(
        col("o_custkey").alias("author"), col("l_suppkey").alias("repo"), col("l_partkey").alias("part"),
        (col("l_returnflag") == "A").alias("merged"), (col("l_partkey") % 97).alias("pusher"),
    )


PULLS_SQL = """pr AS (SELECT o_custkey AS author, l_suppkey AS repo, l_partkey AS part, l_returnflag = 'A' AS merged, l_partkey % 97 AS pusher
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(
    "gh_top_languages",
    f"""WITH {PULLS_SQL}, l AS (SELECT author, p_type AS language, COUNT(*) AS merged FROM pr JOIN part ON part = p_partkey WHERE pr.merged GROUP BY 1, 2),
          r AS (SELECT *, SUM(merged) OVER (PARTITION BY author) AS total, ROW_NUMBER() OVER (PARTITION BY author ORDER BY merged DESC, language) AS place FROM l)
        SELECT author, language, merged, place FROM r WHERE total >= 10 AND place <= 3""",
)
def gh_top_languages(t: Tables):
    """Top three languages of every author with at least ten merged pull requests."""
    merged = pulls(t).filter("merged")
    languages = t.part.select(col("p_partkey").alias("part"), col("p_type").alias("language"))
    counts = merged.join(languages, "part").groupBy("author", "language").agg(rows().alias("merged"))
    active = counts.groupBy("author").agg(F.sum("merged").alias("total")).filter("total >= 10").select("author")
    return top_per_group(counts.join(active, "author", "left_semi"), ["author"], [("merged", "desc"), ("language", "asc")], 3, "place")


@query(
    "gh_authors_vs_pushers",
    f"""WITH {PULLS_SQL}, top AS (SELECT repo FROM pr GROUP BY 1 ORDER BY COUNT(*) DESC, repo LIMIT 50),
          a AS (SELECT repo, author, COUNT(*) AS commits, ROW_NUMBER() OVER (PARTITION BY repo ORDER BY COUNT(*) DESC, author) AS place FROM pr JOIN top USING (repo) GROUP BY 1, 2),
          p AS (SELECT repo, pusher, COUNT(*) AS pushes, ROW_NUMBER() OVER (PARTITION BY repo ORDER BY COUNT(*) DESC, pusher) AS place FROM pr JOIN top USING (repo) GROUP BY 1, 2)
        SELECT repo, place, author, commits, pusher, pushes FROM (SELECT * FROM a WHERE place <= 5) FULL JOIN (SELECT * FROM p WHERE place <= 5) USING (repo, place)""",
)
def gh_authors_vs_pushers(t: Tables):
    """Top five commit authors and pushers side by side for the fifty busiest repositories."""
    pr = pulls(t)
    busy = pr.groupBy("repo").agg(rows().alias("n")).orderBy(col("n").desc(), "repo").limit(50).select("repo")
    kept = pr.join(F.broadcast(busy), "repo")

    def ranked(who, count):
        counts = kept.groupBy("repo", who).agg(rows().alias(count))
        return top_per_group(counts, ["repo"], [(count, "desc"), (who, "asc")], 5, "place")

    return ranked("author", "commits").join(ranked("pusher", "pushes"), ["repo", "place"], "full")


@query(
    "gh_collab_pairs",
    f"""WITH {PULLS_SQL}, m AS (SELECT author, part AS repo, COUNT(*) AS w FROM pr GROUP BY 1, 2)
        SELECT a.author AS a, b.author AS b, COUNT(*) AS shared, CAST(SUM(a.w + b.w) AS BIGINT) AS combined FROM m a JOIN m b ON a.repo = b.repo AND a.author < b.author
        GROUP BY 1, 2 HAVING COUNT(*) >= 3 ORDER BY shared DESC, combined DESC, a, b LIMIT 10""",
)
def gh_collab_pairs(t: Tables):
    """Pairs with at least three common repositories; here a part is the repository."""
    contributions = pulls(t).groupBy("author", "part").agg(rows().alias("w"))
    pairs = overlapping_pairs(contributions, "author", "part", "w", 3)
    return pairs.orderBy(col("shared").desc(), col("combined").desc(), "a", "b").limit(10)


@query(
    "gh_star_fork_pr_funnel",
    FUNNEL_SQL + """ SELECT repo, stargazers, round(forked / stargazers, 6) AS fork_share, round(opened / forkers, 6) AS pr_share FROM s JOIN f USING (repo)
      WHERE repo IN (SELECT repo FROM e WHERE event_type = 'view' GROUP BY 1 HAVING COUNT(*) >= 480)""",
)
def gh_star_fork_pr_funnel(t: Tables, min_stars: int = 480):
    """Share of stargazers who fork within two days, and of forkers who open a request within five."""
    events = funnel_events(t)
    starred = events.filter("event_type = 'view'").groupBy("repo").agg(rows().alias("n")).filter(col("n") >= min_stars)
    events = events.join(starred.select("repo"), "repo", "left_semi").select("actor", "repo", "event_type", "ts")
    stars = step_counts(events, "view", "click", "INTERVAL 2 DAYS", "stargazers", "forked")
    forks = step_counts(events, "click", "purchase", "INTERVAL 5 DAYS", "forkers", "opened")
    return stars.join(forks, "repo").select(
        "repo", "stargazers", F.round(col("forked") / col("stargazers"), 6).alias("fork_share"),
        F.round(col("opened") / col("forkers"), 6).alias("pr_share"),
    )


@query(
    "gh_network_two_hops",
    f"""WITH {PULLS_SQL}, m AS (SELECT DISTINCT author, part AS repo FROM pr), s AS (SELECT author AS seed FROM pr GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
          r1 AS (SELECT repo FROM m JOIN s ON author = seed), d1 AS (SELECT DISTINCT author FROM m JOIN r1 USING (repo) WHERE author <> (SELECT seed FROM s)),
          r2 AS (SELECT DISTINCT repo FROM m JOIN d1 USING (author))
        SELECT author AS actor, CAST(1 AS BIGINT) AS distance, repo FROM m JOIN r1 USING (repo) WHERE author <> (SELECT seed FROM s)
        UNION ALL SELECT author, 2, repo FROM m JOIN r2 USING (repo) WHERE author NOT IN (SELECT author FROM d1) AND author <> (SELECT seed FROM s)""",
)
def gh_network_two_hops(t: Tables):
    """Everyone within two collaborations of the busiest author: one row per actor and connecting repository."""
    pr = pulls(t)
    member = pr.select("author", col("part").alias("repo")).distinct()
    seed = pr.groupBy(col("author").alias("seed")).agg(rows().alias("n")).orderBy(col("n").desc(), "seed").limit(1).select("seed")
    others = member.join(seed, col("author") == col("seed"), "left_anti")
    first_repos = member.join(F.broadcast(seed), col("author") == col("seed")).select("repo")
    first = others.join(first_repos, "repo", "left_semi")
    near = first.select("author").distinct()
    second_repos = others.join(near, "author", "left_semi").select("repo").distinct()
    second = others.join(near, "author", "left_anti").join(second_repos, "repo", "left_semi")
    tag = lambda df, d: df.select(col("author").alias("actor"), lit(d).cast("bigint").alias("distance"), "repo")
    return tag(first, 1).unionByName(tag(second, 2))


# --- ride hailing: a line is a trip; quantity is miles, line number the hour of day


def trips(t: Tables):
    return t.lineitem.select(
        (col("l_suppkey") % 10).alias("pickup_zone"), (col("l_partkey") % 10).alias("dropoff_zone"), "l_suppkey", "l_orderkey",
        big(col("l_linenumber")).alias("hour_of_day"), big(F.dayofweek("l_shipdate")).alias("day_of_week"),
        col("l_shipdate").alias("pickup"), col("l_extendedprice").alias("fare"), col("l_quantity").alias("miles"),
        "l_returnflag", "l_discount", "l_tax",
    )


LANDED = """pickup_zone BIGINT, dropoff_zone BIGINT, pickup_borough INT, dropoff_borough INT, hour_of_day BIGINT, day_of_week BIGINT,
  pickup TIMESTAMP_NTZ, fare DOUBLE, miles DOUBLE, asked STRING, pay DOUBLE, gross DOUBLE"""
WAITED = "zone BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"

SURGE = Cube("surge", {x: x for x in ("pickup_zone", "hour_of_day", "day_of_week")}, "fare / nullif(miles, 0.0D)")
SHARED = Cube(
    "shared", {"day": "to_date(pickup)", "pickup_zone": "pickup_zone", "dropoff_zone": "dropoff_zone"},
    sums={"requested": "1L", "matched": "if(asked = 'A', 1L, 0L)"}, keep="asked IN ('A', 'R')",
)
PAY = Cube("pay", {"licensee": "asked"}, sums={"gross": "gross", "pay": "pay"})
RUSH = Cube(
    "rush", {"pickup_borough": "pickup_borough", "dropoff_borough": "dropoff_borough"}, "fare",
    keep="day_of_week BETWEEN 2 AND 6 AND hour_of_day IN (1, 2, 3)",
)
WAIT = Cube("wait", {"day": "to_date(ts)", "hour": "hour(ts)", "zone": "zone"}, "value")


def month_of(time: str):
    return F.date_format(time, "yyyy-MM").alias("name")


#: Counted rows (a key and a borough) up to which the sellers travel to the lines.
BROADCAST_SELLERS = 1_000_000


def ride_months(t: Tables):
    """Trips with the boroughs of both ends, and the month that publishes them."""
    def region(df, key, name):
        return df.join(t.nation, col(key) == col("n_nationkey")).withColumnRenamed("n_regionkey", name).drop("n_nationkey", "n_name")

    buyers = region(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", "pickup_borough")
    sellers = region(t.supplier.select("s_suppkey", "s_nationkey"), "s_nationkey", "dropoff_borough")
    # a trip without an order, customer or supplier has no borough and still counts elsewhere; the orders meet their buyers first, so
    # that the wide lines are shuffled once for both
    orders = t.orders.select("o_orderkey", "o_custkey").join(buyers, col("o_custkey") == col("c_custkey"), "left").select("o_orderkey", "pickup_borough")
    sellers = F.broadcast(sellers) if t.supplier.count() <= BROADCAST_SELLERS else sellers
    lines = t.lineitem.join(sellers, col("l_suppkey") == col("s_suppkey"), "left")
    lines = lines.join(orders, col("l_orderkey") == col("o_orderkey"), "left")
    return lines.select(
        (col("l_suppkey") % 10).alias("pickup_zone"), (col("l_partkey") % 10).alias("dropoff_zone"), col("pickup_borough").cast("int"),
        col("dropoff_borough").cast("int"), big(col("l_linenumber")).alias("hour_of_day"), big(F.dayofweek("l_shipdate")).alias("day_of_week"),
        col("l_shipdate").cast("timestamp_ntz").alias("pickup"), col("l_extendedprice").cast("double").alias("fare"), col("l_quantity").cast("double").alias("miles"),
        col("l_returnflag").alias("asked"), (col("l_extendedprice") * (1 - col("l_discount"))).cast("double").alias("pay"),
        (col("l_extendedprice") * (1 + col("l_tax"))).cast("double").alias("gross"), month_of("l_shipdate"),
    )


def wait_months(t: Tables):
    return t.events.select(col("user_id").alias("zone"), col("ts").cast("timestamp_ntz").alias("ts"), "value", month_of("ts"))


def cube_store(t: Tables, what: str) -> CubeStore:
    """The cubes of the trips or waits, below the shared folder and the state of the files they come from.

    The landing folder has one folder a month, as the feed publishes it. It is written when the tables
    are new or have changed; after that a question lists files and reads its cube.
    """
    tables, rows_of, schema = {
        "rides": (("lineitem", "orders", "customer", "supplier", "nation"), ride_months, LANDED), "waits": (("events",), wait_months, WAITED),
    }[what]
    files = [landed(t.spark, t.path(x)).withColumn("name", lit("all")) for x in tables]
    state = deliveries(functools.reduce(lambda x, y: x.unionByName(y), files)).first()["etag"]
    layout = hashlib.sha1(schema.encode()).hexdigest()[:8]
    root = f"{shared_root(t.spark).rstrip('/')}/sparkwell/{what}-{layout}-{state}"
    published = VersionedTable(t.spark, f"{root}/published")
    if not published.exists():
        replace_partitions(rows_of(t), f"{root}/landing", "name")
        published.replace(t.spark.createDataFrame([(state,)], "state STRING"))
    return CubeStore(t.spark, f"{root}/landing", schema, f"{root}/cubes")


def from_cube(t: Tables, what: str, cube: Cube, months=None):
    store = cube_store(t, what)
    store.refresh(cube)
    return store.read(cube, months)


def last_full_month(now: str) -> str:
    """The latest complete month before ``now``, as yyyy-MM."""
    return (datetime.fromisoformat(now).replace(day=1) - timedelta(days=1)).strftime("%Y-%m")


def trailing(now: str, days: int) -> tuple[list[str], Column]:
    """Months that hold the days before ``now``, and the condition on the day; ``now`` is a date."""
    end = date.fromisoformat(now)
    start = end - timedelta(days=days)
    return [start.strftime("%Y-%m"), (end - timedelta(days=1)).strftime("%Y-%m")], (col("day") >= lit(start)) & (col("day") < lit(end))


SURGE_SQL = """SELECT l_suppkey % 10 AS pickup_zone, CAST(l_linenumber AS BIGINT) AS hour_of_day, dayofweek(l_shipdate) + 1 AS day_of_week,
  round(median(l_extendedprice / NULLIF(l_quantity, 0)), 6) AS per_mile, COUNT(*) AS trips FROM lineitem"""


@query(
    "fhv_surge_hotspots",
    f"""{SURGE_SQL} WHERE l_shipdate >= TIMESTAMP '2001-07-01' AND l_shipdate < TIMESTAMP '2001-08-01' GROUP BY 1, 2, 3 HAVING COUNT(*) >= 2
        ORDER BY per_mile DESC, 1, 2, 3 LIMIT 100""",
)
def fhv_surge_hotspots(t: Tables, now: str = "2001-08-15", min_trips: int = 2):
    """Dearest zone, hour and weekday cells of the latest complete month (200 trips a cell on full data), from the cube."""
    cells = from_cube(t, "rides", SURGE, [last_full_month(now)])
    medians = exact_percentiles(cells, list(SURGE.cell), "value", {"p50": 0.5}, "n").filter(col("n") >= min_trips)
    found = medians.select(*SURGE.cell, F.round("p50", 6).alias("per_mile"), col("n").alias("trips"))
    return found.orderBy(col("per_mile").desc(), *SURGE.cell).limit(100)


@query(
    "fhv_wait_percentiles",
    """SELECT user_id AS zone, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, COUNT(*) AS n FROM events
       WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY AND ts < TIMESTAMP '2024-01-31' AND hour(ts) = 8 GROUP BY 1 ORDER BY p90 DESC, zone LIMIT 25""",
)
def fhv_wait_percentiles(t: Tables, now: str = "2024-01-31", hour: int = 8):
    """Zones with the longest 90th-percentile wait at one hour, over the trailing 30 days; counts of values add up over days."""
    months, days = trailing(now, 30)
    waits = from_cube(t, "waits", WAIT, months).filter(days & (col("hour") == hour))
    found = exact_percentiles(waits, ["zone"], "value", {"p50": 0.5, "p90": 0.9}, "n")
    rounded = found.select("zone", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"), "n")
    return rounded.orderBy(col("p90").desc(), "zone").limit(25)


@query(
    "fhv_shared_match",
    """SELECT l_suppkey % 10 AS pickup_zone, l_partkey % 10 AS dropoff_zone, COUNT(*) AS requested,
              round(COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) / COUNT(*), 6) AS match_rate FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-06-01' - INTERVAL 90 DAY AND l_shipdate < TIMESTAMP '1998-06-01' AND l_returnflag IN ('A', 'R')
       GROUP BY 1, 2 HAVING COUNT(*) >= 10 ORDER BY match_rate DESC, 1, 2 LIMIT 20""",
)
def fhv_shared_match(t: Tables, now: str = "1998-06-01", min_requests: int = 10):
    """Matched over requested shared rides per zone pair, trailing 90 days (500 requests on full data), from daily sums."""
    months, days = trailing(now, 90)
    asked = from_cube(t, "rides", SHARED, months).filter(days)
    pairs = asked.groupBy("pickup_zone", "dropoff_zone").agg(F.sum("requested").alias("requested"), F.sum("matched").alias("matched"))
    rate = F.round(col("matched") / col("requested"), 6)
    kept = pairs.filter(col("requested") >= min_requests).select("pickup_zone", "dropoff_zone", "requested", rate.alias("match_rate"))
    return kept.orderBy(col("match_rate").desc(), "pickup_zone", "dropoff_zone").limit(20)


@query(
    "fhv_driver_pay_share",
    """SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag AS licensee, round(SUM(l_extendedprice * (1 + l_tax)), 4) AS gross,
              round(SUM(l_extendedprice * (1 - l_discount)), 4) AS driver_pay,
              round(100 * SUM(l_extendedprice * (1 - l_discount)) / SUM(l_extendedprice * (1 + l_tax)), 6) AS pct FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2""",
)
def fhv_driver_pay_share(t: Tables):
    """Gross fares and driver pay of each licensee and month, kept as sums."""
    months = from_cube(t, "rides", PAY).select(col("name").alias("month"), "licensee", "gross", "pay")
    return months.select(
        "month", "licensee", F.round("gross", 4).alias("gross"), F.round("pay", 4).alias("driver_pay"), F.round(100 * col("pay") / col("gross"), 6).alias("pct")
    ).orderBy("month", "licensee")


@query(
    "fhv_duration_shift",
    """WITH x AS (SELECT c.n_regionkey AS pickup_borough, s.n_regionkey AS dropoff_borough, l_extendedprice AS trip_time, l_shipdate < TIMESTAMP '1998-06-01' AS first_half
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation c ON c_nationkey = c.n_nationkey
                  JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey WHERE isodow(l_shipdate) <= 5 AND l_linenumber IN (1, 2, 3)),
            m AS (SELECT pickup_borough, dropoff_borough, median(trip_time) FILTER (WHERE first_half) AS a, median(trip_time) FILTER (WHERE NOT first_half) AS b,
                  COUNT(*) FILTER (WHERE first_half) AS n_first, COUNT(*) FILTER (WHERE NOT first_half) AS n_second FROM x GROUP BY 1, 2)
       SELECT pickup_borough, dropoff_borough, round(a, 6) AS median_first, round(b, 6) AS median_second, n_first, n_second, round(100 * (b - a) / a, 6) AS pct_change
       FROM m ORDER BY abs(100 * (b - a) / a) DESC LIMIT 10""",
)
def fhv_duration_shift(t: Tables, midpoint: str = "1998-06-01"):
    """Borough pairs whose median weekday rush-hour duration moved most between the halves; ``midpoint`` begins a month."""
    if not midpoint.endswith("-01"):
        raise ValueError("the cube is kept by month: the midpoint must be the first day of one")
    pair = list(RUSH.cell)
    trips_of = from_cube(t, "rides", RUSH).filter(col("pickup_borough").isNotNull() & col("dropoff_borough").isNotNull())
    halves = trips_of.withColumn("first_half", col("name") < midpoint[:7])
    medians = exact_percentiles(halves, [*pair, "first_half"], "value", {"p50": 0.5}, "n")
    first = medians.filter("first_half").select(*pair, col("p50").alias("a"), col("n").alias("n_first"))
    second = medians.filter("NOT first_half").select(*pair, col("p50").alias("b"), col("n").alias("n_second"))
    change = 100 * (col("b") - col("a")) / col("a")
    shifted = first.join(second, pair).withColumn("pct", change).orderBy(F.abs("pct").desc()).limit(10)
    return shifted.select(
        *pair, F.round("a", 6).alias("median_first"), F.round("b", 6).alias("median_second"), "n_first", "n_second",
        F.round("pct", 6).alias("pct_change"),
    )


@query(
    "fhv_cube_incremental",
    """SELECT l_suppkey % 10 AS pickup_zone, CAST(l_linenumber AS BIGINT) AS hour_of_day, round(median(l_extendedprice * 2 / NULLIF(l_quantity, 0)), 6) AS per_mile, COUNT(*) AS trips
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-07-01' AND l_shipdate < TIMESTAMP '2001-08-01' GROUP BY 1, 2""",
)
def fhv_cube_incremental(t: Tables, now: str = "2001-08-15"):
    """Cube per month; a republished month is rebuilt alone, and the query picks the month from ``now``."""
    path = shared_path(t.spark, "cube")
    cell = ["month", "pickup_zone", "hour_of_day"]

    def build(source):
        priced = source.withColumn("per_mile", col("fare") / F.nullif(col("miles"), lit(0.0)))
        return exact_percentiles(priced.select(*cell, "per_mile"), cell, "per_mile", {"p50": 0.5})

    source = trips(t).withColumn("month", F.date_format("pickup", "yyyy-MM"))
    replace_partitions(build(source), path, "month")
    corrected = source.filter("month = '2001-07'").withColumn("fare", col("fare") * 2)
    replace_partitions(build(corrected), path, "month")
    cube = t.spark.read.schema("pickup_zone BIGINT, hour_of_day BIGINT, n BIGINT, p50 DOUBLE, month STRING").parquet(path)
    month = F.date_format(F.add_months(F.to_date(lit(now)), -1), "yyyy-MM")
    return cube.filter(col("month") == month).select(
        "pickup_zone", "hour_of_day", F.round("p50", 6).alias("per_mile"), col("n").alias("trips")
    )


# --- energy meters: user is the meter, value the kWh; readings of one half hour correct each other


def half_hour():
    return F.window("ts", "30 minutes")["start"].cast("timestamp_ntz")


def readings(t: Tables, span=None):
    """Deliveries with repeats: every fourth id is pushed twice. A span of whole half hours (start, end) is that of the
    delivered rows too, so it is read from ``ts`` at the scan."""
    events = t.events if span is None else t.events.filter((col("ts") >= span[0]) & (col("ts") < span[1]))
    sent = events.select(
        col("event_id").alias("delivery_id"), col("user_id").alias("meter_id"), half_hour().alias("reading_time"),
        col("value").alias("kwh"), col("ts").alias("received_at"),
    )
    return sent.unionByName(sent.filter("delivery_id % 4 = 0"))


def meter_view(t: Tables, span=None):
    """One corrected value per meter and half hour: repeats dropped, the latest received wins."""
    once = readings(t, span).dropDuplicates(["delivery_id"])
    return latest_per_key(once, ["meter_id", "reading_time"], ["received_at", "delivery_id"]).select("meter_id", "reading_time", "kwh")


METER_SQL = """r AS (SELECT user_id AS meter_id, time_bucket(INTERVAL 30 MINUTE, ts) AS reading_time, arg_max(value, event_id) AS kwh FROM events GROUP BY 1, 2)"""


@query("meter_dedup_correct", f"WITH {METER_SQL} SELECT * FROM r")
def meter_dedup_correct(t: Tables):
    return meter_view(t)


@query(
    "meter_halfhour_total",
    f"""WITH {METER_SQL} SELECT reading_time, round(SUM(kwh), 2) AS total FROM r WHERE reading_time >= TIMESTAMP '2024-01-28 17:00:00'
         AND reading_time < TIMESTAMP '2024-01-28 22:00:00' GROUP BY 1""",
)
def meter_halfhour_total(t: Tables, today: str = "2024-01-29"):
    """The whole book per half hour of yesterday evening."""
    start = ntz(today) - F.expr("INTERVAL 7 HOURS")
    end = ntz(today) - F.expr("INTERVAL 2 HOURS")
    evening = meter_view(t, (start, end))
    return evening.groupBy("reading_time").agg(F.round(F.sum("kwh"), 2).alias("total"))


@query(
    "meter_top_households",
    f"""WITH {METER_SQL} SELECT meter_id, 'N' || c_nationkey AS area, round(SUM(kwh), 2) AS kwh FROM r JOIN customer ON c_custkey = meter_id
         WHERE CAST(reading_time AS DATE) = DATE '2024-01-13' GROUP BY ALL ORDER BY kwh DESC, meter_id LIMIT 10""",
)
def meter_top_households(t: Tables, on: str = "2024-01-13"):
    totals = meter_view(t, (ntz(on), ntz(on) + F.expr("INTERVAL 1 DAY"))).groupBy("meter_id").agg(F.round(F.sum("kwh"), 2).alias("kwh"))
    area = t.customer.select(col("c_custkey").alias("meter_id"), F.concat(lit("N"), col("c_nationkey").cast("string")).alias("area"))
    return totals.join(area, "meter_id").orderBy(col("kwh").desc(), "meter_id").limit(10)


def households(t: Tables):
    tariff = when(col("c_nationkey") % 2 == 0, "ToU").otherwise("Std")
    return t.customer.select(col("c_custkey").alias("meter_id"), col("c_mktsegment").alias("segment"), tariff.alias("tariff"))


HOME_SQL = "h AS (SELECT c_custkey AS meter_id, c_mktsegment AS segment, CASE WHEN c_nationkey % 2 = 0 THEN 'ToU' ELSE 'Std' END AS tariff FROM customer)"


@query(
    "meter_segment_daily_avg",
    f"""WITH {METER_SQL}, {HOME_SQL}, d AS (SELECT meter_id, CAST(reading_time AS DATE) AS d, SUM(kwh) AS kwh FROM r
          WHERE reading_time >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY AND reading_time < TIMESTAMP '2024-01-31' GROUP BY 1, 2)
        SELECT segment, tariff, round(AVG(kwh), 6) AS daily_kwh, COUNT(*) AS household_days FROM d JOIN h USING (meter_id) GROUP BY 1, 2""",
)
def meter_segment_daily_avg(t: Tables, now: str = "2024-01-31"):
    """Sum per household and day first, then the mean by segment and tariff."""
    daily = meter_view(t, (ntz(now) - F.expr("INTERVAL 30 DAYS"), ntz(now))).groupBy("meter_id", day("reading_time").alias("d")).agg(F.sum("kwh").alias("kwh"))
    return daily.join(households(t), "meter_id").groupBy("segment", "tariff").agg(
        F.round(F.avg("kwh"), 6).alias("daily_kwh"), rows().alias("household_days")
    )


@query(
    "meter_reporting_daily",
    """WITH d AS (SELECT CAST(x AS DATE) AS day FROM unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) s(x)),
            n AS (SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT user_id) AS meters FROM events GROUP BY 1)
       SELECT day, COALESCE(meters, 0) AS reporting, (SELECT COUNT(DISTINCT user_id) FROM events) - COALESCE(meters, 0) AS silent FROM d LEFT JOIN n USING (day)""",
)
def meter_reporting_daily(t: Tables, first: str = "2023-12-31", last: str = "2024-01-31"):
    """Days without any reading show as zero."""
    known = t.events.select("user_id").distinct().agg(rows().alias("known"))
    days = known.select("known", F.explode(F.sequence(F.to_date(lit(first)), F.to_date(lit(last)))).alias("day"))
    seen = t.events.groupBy(day("ts").alias("day")).agg(F.countDistinct("user_id").alias("n"))
    reporting = F.coalesce("n", lit(0))
    return days.join(seen, "day", "left").select("day", reporting.alias("reporting"), (col("known") - reporting).alias("silent"))


@query(
    "meter_offpeak_share",
    f"""WITH {METER_SQL}, {HOME_SQL} SELECT meter_id, CAST(reading_time AS DATE) AS day, round(SUM(CASE WHEN hour(reading_time) < 6 THEN kwh ELSE 0 END) / NULLIF(SUM(kwh), 0), 6) AS offpeak
        FROM r JOIN h USING (meter_id) WHERE tariff = 'ToU' GROUP BY 1, 2""",
)
def meter_offpeak_share(t: Tables):
    """Share of a day's use between midnight and six, for time-of-use households."""
    tou = households(t).filter("tariff = 'ToU'").select("meter_id")
    night = F.sum(when(F.hour("reading_time") < 6, col("kwh")).otherwise(0.0))
    used = meter_view(t).join(tou, "meter_id", "left_semi").groupBy("meter_id", day("reading_time").alias("day"))
    return used.agg(F.round(night / F.nullif(F.sum("kwh"), lit(0.0)), 6).alias("offpeak"))


@query(
    "meter_weather_relation",
    f"""WITH {METER_SQL}, u AS (SELECT CAST(reading_time AS DATE) AS day, SUM(kwh) AS total FROM r GROUP BY 1),
          w AS (SELECT CAST(ts AS DATE) AS day, AVG(CAST(json_extract(props, '$.k') AS DOUBLE) / 4) AS temperature FROM events GROUP BY 1)
        SELECT day, round(temperature, 6) AS temperature, round(total, 2) AS total, round(corr(temperature, total) OVER (), 6) AS correlation FROM u JOIN w USING (day)""",
)
def meter_weather_relation(t: Tables):
    """Daily mean temperature beside the daily total, and their correlation."""
    use = meter_view(t).groupBy(day("reading_time").alias("day")).agg(F.sum("kwh").alias("total"))
    temperature = F.avg(F.get_json_object("props", "$.k").cast("double") / 4)
    weather = t.events.groupBy(day("ts").alias("day")).agg(temperature.alias("temperature"))
    both = use.join(weather, "day")
    relation = both.agg(F.corr("temperature", "total")).scalar()
    return both.select(
        "day", F.round("temperature", 6).alias("temperature"), F.round("total", 2).alias("total"), F.round(relation, 6).alias("correlation")
    )


@query(
    "meter_peak_projection",
    """WITH e AS (SELECT DISTINCT ON (user_id, b) user_id, time_bucket(INTERVAL 1 DAY, ts) AS b, value FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS b FROM events WHERE hour(ts) < 12)
                  ORDER BY user_id, b, event_id DESC),
            s AS (SELECT b, SUM(value) AS so_far, COUNT(*) AS reported FROM e GROUP BY 1)
       SELECT CAST(b AS DATE) AS day, round(so_far, 2) AS so_far, reported, round(so_far * (SELECT COUNT(DISTINCT user_id) FROM events) / reported, 4) AS projected,
              so_far * (SELECT COUNT(DISTINCT user_id) FROM events) / reported > 6000 AS breach FROM s""",
)
def meter_peak_projection(t: Tables, threshold: float = 6000.0):
    """Total by the end of a window, scaled from the meters heard so far (by noon of each day), against the threshold."""
    early = t.events.filter(F.hour("ts") < 12).groupBy(day("ts").alias("day"), "user_id").agg(F.max_by("value", "event_id").alias("kwh"))
    so_far = early.groupBy("day").agg(F.sum("kwh").alias("s"), rows().alias("reported"))
    meters = t.events.select("user_id").distinct().agg(rows()).scalar()
    projected = col("s") * meters / col("reported")
    return so_far.select(
        "day", F.round("s", 2).alias("so_far"), "reported", F.round(projected, 4).alias("projected"), (projected > threshold).alias("breach")
    )


@query(
    "meter_coverage_filter",
    f"""WITH {METER_SQL}, c AS (SELECT meter_id, COUNT(*) AS readings FROM r GROUP BY 1)
        SELECT meter_id, readings, round(readings / 60.0, 6) AS coverage FROM c WHERE readings / 60.0 >= 0.5""",
)
def meter_coverage_filter(t: Tables, expected: float = 60.0):
    """Households with at least half of the expected readings."""
    counts = meter_view(t).groupBy("meter_id").agg(rows().alias("readings"))
    covered = counts.filter(col("readings") / expected >= 0.5)
    return covered.withColumn("coverage", F.round(col("readings") / expected, 6))
