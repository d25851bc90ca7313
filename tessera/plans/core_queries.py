"""Flagship slice: dedup -> as-of enrichment -> delay features -> summary.

``user_id``, place = ``event_type``, schedule = ``ts``, delay = ``value``,
threshold 15); the weather observations joined as-of are the ``view`` events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import asof_join
from tessera.operators.profile import dedup_by_key, flag_sums_by_keys, row_count_ledger
from tessera.operators.temporal import previous_leg_flag, trailing_count
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources.tables import Tables

LEAD_SECONDS = 2 * 3600
# Time buckets that bound each sort when one key holds a large share of rows:
# a unit/place/key is split into buckets of this width, and the edges are
# repaired with carry tables over bucket rows only.
ASOF_BUCKET_SECONDS = 3_600
TRAILING_BUCKET_SECONDS = 900
LEG_BUCKET_SECONDS = 900

LINEITEM_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def clean_events(t: Tables) -> DataFrame:
    """Events deduplicated on (user_id, ts), lowest event_id kept."""
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return dedup_by_key(ev, ["user_id", "ts"], ["event_id"])


def enriched_purchases(events: DataFrame) -> DataFrame:
    left = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = events.where(F.col("event_type") == "view") \
                  .select(F.col("event_id").alias("view_id"), "user_id", "ts", "value")
    out = asof_join(left, right, "user_id", "ts", "ts", ["view_id", "value"],
                    lead_seconds=LEAD_SECONDS, right_tiebreak="view_id",
                    bucket_seconds=ASOF_BUCKET_SECONDS)
    return out.select("event_id", "user_id", "view_id", F.col("value").alias("view_value"))


def delay_features(events: DataFrame) -> DataFrame:
    x = previous_leg_flag(events, unit="user_id", ts="ts", delay="value", tiebreak="event_id",
                          bucket_seconds=LEG_BUCKET_SECONDS)
    return trailing_count(x, place="event_type", ts="ts", delay="value",
                          bucket_seconds=TRAILING_BUCKET_SECONDS)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type: rows, delayed rows, previous-leg flags, trailing delay
    counts and as-of matches of purchases to an earlier view."""
    t = Tables(spark, sf_dir)
    # The deduplicated events feed three differently-partitioned consumers
    # (unit-date lags, place-time counts, key-day as-of); materialise them once
    # on shared storage instead of re-running the dedup shuffle per consumer.
    ev = cut_lineage(clean_events(t))
    feats = delay_features(ev)
    matched = enriched_purchases(ev).select("event_id", F.col("view_id").isNotNull().alias("_hit"))
    x = feats.join(matched, "event_id", "left")
    return x.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("value") >= 15).alias("n_delayed"),
        F.sum("prev_delayed").cast("long").alias("n_prev_delayed"),
        F.sum("n_prev_delays").cast("long").alias("sum_prev_delays"),
        F.count_if(F.col("_hit")).alias("n_asof_matched"))


_EVENTS_SQL = """
(SELECT event_id, ts, user_id, event_type, value FROM (
   SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn FROM events)
 WHERE rn = 1)"""

_W02_SQL = f"""
WITH b AS (SELECT event_id, user_id, value, CAST(ts AS DATE) AS d, epoch_us(ts) AS us
           FROM {_EVENTS_SQL}),
l AS (SELECT event_id, us - 7200000000 AS cut, d,
        lag(us, 1) OVER w AS p1_us, lag(d, 1) OVER w AS p1_d, lag(value, 1) OVER w AS p1_v,
        lag(us, 2) OVER w AS p2_us, lag(d, 2) OVER w AS p2_d, lag(value, 2) OVER w AS p2_v
      FROM b WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT event_id,
  CASE WHEN cut - p1_us >= 900000000 AND p1_d = d AND p1_v >= 15 THEN 1
       WHEN cut - p2_us >= 900000000 AND cut - p1_us < 900000000 AND p2_d = d AND p2_v >= 15 THEN 1
       ELSE 0 END AS prev_delayed
FROM l"""

_W03_SQL = f"""
SELECT event_id,
  CAST(SUM(CASE WHEN value >= 15 THEN 1 ELSE 0 END) OVER (
       PARTITION BY CAST(ts AS DATE), event_type ORDER BY epoch_us(ts)
       RANGE BETWEEN UNBOUNDED PRECEDING AND 8100000000 PRECEDING) AS BIGINT) AS n_prev_delays
FROM {_EVENTS_SQL}"""

_J04_SQL = f"""
SELECT p.event_id, p.user_id, v.view_id, v.value AS view_value
FROM (SELECT event_id, user_id, ts - INTERVAL 2 HOUR AS cut FROM {_EVENTS_SQL}
      WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT event_id AS view_id, user_id, ts, value FROM {_EVENTS_SQL}
                WHERE event_type = 'view') v
ON p.user_id = v.user_id AND p.cut >= v.ts"""


@register("a15_dedup", sql=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(LINEITEM_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def a15_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return dedup_by_key(li, ["l_orderkey", "l_linenumber"], LINEITEM_ORDER)


@register("j04_asof", sql=_J04_SQL)
def j04_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_purchases(clean_events(Tables(spark, sf_dir)))


@register("w02_prev_leg", sql=_W02_SQL)
def w02_prev_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = clean_events(Tables(spark, sf_dir))
    return previous_leg_flag(ev, unit="user_id", ts="ts", delay="value", tiebreak="event_id",
                             bucket_seconds=LEG_BUCKET_SECONDS).select("event_id", "prev_delayed")


@register("w03_trailing", sql=_W03_SQL)
def w03_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = clean_events(Tables(spark, sf_dir))
    return trailing_count(ev, place="event_type", ts="ts", delay="value",
                          bucket_seconds=TRAILING_BUCKET_SECONDS) \
        .select("event_id", "n_prev_delays")


# The reference's eight keys: hour, weekday, day, month, quarter, year,
# carrier (event_type) and origin (user_id).
_A01_KEYS = ["hour", "weekday", "day", "month", "quarter", "year", "event_type", "user_id"]


@register("a01_flag_sums", sql=f"""
SELECT CASE {' '.join(f"WHEN GROUPING({k}) = 0 THEN '{k}'" for k in _A01_KEYS)} END AS key_name,
       CASE {' '.join(f"WHEN GROUPING({k}) = 0 THEN CAST({k} AS VARCHAR)" for k in _A01_KEYS)}
       END AS key_value,
       count(*) AS n_rows, CAST(sum(flag) AS BIGINT) AS n_flag
FROM (SELECT hour(ts) AS hour, dayofweek(ts) AS weekday, day(ts) AS day, month(ts) AS month,
             quarter(ts) AS quarter, year(ts) AS year, event_type, user_id,
             CASE WHEN value >= 15 THEN 1 ELSE 0 END AS flag FROM events)
GROUP BY GROUPING SETS ({', '.join(f'({k})' for k in _A01_KEYS)})""")
def a01_flag_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    keys = {"hour": F.hour("ts"), "weekday": F.dayofweek("ts") - 1, "day": F.dayofmonth("ts"),
            "month": F.month("ts"), "quarter": F.quarter("ts"), "year": F.year("ts"),
            "event_type": F.col("event_type"), "user_id": F.col("user_id")}
    return flag_sums_by_keys(ev, keys, F.col("value") >= 15)


@register("flagship_summary", sql=f"""
WITH w2 AS ({_W02_SQL}), w3 AS ({_W03_SQL}), j AS ({_J04_SQL}), e AS {_EVENTS_SQL}
SELECT e.event_type, count(*) AS n_rows, count(*) FILTER (WHERE e.value >= 15) AS n_delayed,
       CAST(sum(w2.prev_delayed) AS BIGINT) AS n_prev_delayed,
       CAST(sum(w3.n_prev_delays) AS BIGINT) AS sum_prev_delays,
       count(*) FILTER (WHERE j.view_id IS NOT NULL) AS n_asof_matched
FROM e JOIN w2 USING (event_id) JOIN w3 USING (event_id) LEFT JOIN j USING (event_id)
GROUP BY e.event_type""")
def flagship_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)


_MONTH = "month(ts)"


@register("a14_pipeline_ledger", sql=f"""
WITH d AS {_EVENTS_SQL},
p AS (SELECT {_MONTH} AS part, count(*) AS n FROM d WHERE event_type = 'purchase' GROUP BY 1),
e AS (SELECT {_MONTH} AS part, count(*) AS n FROM d GROUP BY 1),
s AS (SELECT 'raw' AS stage, {_MONTH} AS part, count(*) AS n_rows, TRUE AS as_expected FROM events GROUP BY 2
  UNION ALL SELECT 'dedup', part, n, TRUE FROM e
  UNION ALL SELECT 'purchases', part, n, TRUE FROM p
  UNION ALL SELECT 'as_of', part, n, TRUE FROM p
  UNION ALL SELECT 'features', part, n, TRUE FROM e
  UNION ALL SELECT 'model_ready', part, n, TRUE FROM e)
SELECT stage, CAST(part AS BIGINT) AS part, n_rows, as_expected FROM s""")
def a14_pipeline_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts per month after every stage of the as-of pipeline, and whether each is
    what it should be: a join that enriches keeps every row, dedup adds none."""
    t = Tables(spark, sf_dir)
    raw = t.events.select("event_id", "ts")
    ev = cut_lineage(clean_events(t))
    purchases = ev.where(F.col("event_type") == "purchase").select("event_id", "ts")
    as_of = cut_lineage(enriched_purchases(ev).join(ev.select("event_id", "ts"), "event_id"))
    features = cut_lineage(delay_features(ev))
    ready = features.join(as_of.select("event_id", "view_id"), "event_id", "left")
    stages = {"raw": raw, "dedup": ev, "purchases": purchases, "as_of": as_of, "features": features, "model_ready": ready}
    kept = {"as_of": "purchases", "features": "dedup", "model_ready": "dedup"}  # stage -> one of equal counts
    ledger = cut_lineage(row_count_ledger(stages, by=F.month("ts")))
    other = ledger.select(F.col("stage").alias("_of"), "part", F.col("n_rows").alias("_n"))
    base = F.create_map(*[F.lit(x) for s in stages for x in (s, kept.get(s, "raw"))])[F.col("stage")]
    x = ledger.withColumn("_of", base).join(other, ["_of", "part"], "left")
    equal = F.col("stage").isin(*kept)
    return x.select("stage", F.col("part").cast("long").alias("part"), "n_rows",
                    F.when(equal, F.col("n_rows") == F.col("_n")).otherwise(F.col("n_rows") <= F.col("_n")).alias("as_expected"))


_READY_SQL = f"""
WITH d AS {_EVENTS_SQL}, a AS ({_J04_SQL}), l AS ({_W02_SQL}), c AS ({_W03_SQL}),
x AS (SELECT d.event_id, d.event_type, hour(d.ts) AS hour, l.prev_delayed, coalesce(c.n_prev_delays, 0) AS n_prev_delays,
        coalesce(a.view_value, 0) AS view_value, CAST(a.view_id IS NOT NULL AS INTEGER) AS has_view,
        CAST(d.value >= 15 AS INTEGER) AS label
      FROM d JOIN l USING (event_id) JOIN c USING (event_id) LEFT JOIN a USING (event_id)),
g AS (SELECT event_type, count(DISTINCT user_id) AS n_users, count(*) AS n_events FROM d GROUP BY 1)
SELECT x.event_id, x.event_type, hour, prev_delayed, n_prev_delays, has_view, label, n_users, n_events,
  round((view_value - (SELECT avg(view_value) FROM x)) / (SELECT stddev_samp(view_value) FROM x), 6) AS view_value_scaled,
  round((n_prev_delays - (SELECT avg(n_prev_delays) FROM x)) / (SELECT stddev_samp(n_prev_delays) FROM x), 6)
    AS n_prev_delays_scaled
FROM x JOIN g USING (event_type)"""


@register("a14_model_ready", sql=_READY_SQL)
def a14_model_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model-ready table: deduplicated events with the as-of view, the delay features, the
    place's weighted degree in the user-place graph (users and events), and scaled columns."""
    ev = cut_lineage(clean_events(Tables(spark, sf_dir)))
    views = enriched_purchases(ev).select("event_id", "view_id", "view_value")
    place = ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("n_events"))
    x = delay_features(ev).join(views, "event_id", "left").select(
        "event_id", "event_type", F.hour("ts").cast("long").alias("hour"), "prev_delayed",
        F.coalesce("n_prev_delays", F.lit(0)).alias("n_prev_delays"), F.coalesce("view_value", F.lit(0)).alias("view_value"),
        F.col("view_id").isNotNull().cast("int").alias("has_view"), (F.col("value") >= 15).cast("int").alias("label"))
    x = cut_lineage(x)
    scale = x.agg(*[f(c).alias(f"{n}_{c}") for c in ("view_value", "n_prev_delays")
                    for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    for c in ("view_value", "n_prev_delays"):
        z = (F.col(c) - scale.select(f"m_{c}").scalar()) / scale.select(f"s_{c}").scalar()
        x = x.withColumn(f"{c}_scaled", F.round(z, 6))
    return x.drop("view_value").join(place, "event_type")
