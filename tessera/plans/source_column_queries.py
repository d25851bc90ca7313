"""Registered queries for sources/sinks (S) and scalar column operators (P)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import columns as C
from tessera.functions import weather as WX
from tessera.operators.joins import asof_join
from tessera.operators.ranking import counts_with_prefix
from tessera.plans.core_queries import ASOF_BUCKET_SECONDS, clean_events, enriched_purchases
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources import files as S
from tessera.sources.tables import Tables

# ---------------------------------------------------------------- sources


@register("s01_timeslice", sql="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def s01_timeslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.load_timeslice(spark, f"{sf_dir}/orders.parquet", "o_orderdate", "1997", 1995,
                            cols=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


@register("s01_timeslice_6m", sql="""
SELECT count(*) AS n_rows, CAST(sum(o_totalprice) AS DECIMAL(18,2)) AS total_price FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-07-01'""")
def s01_timeslice_6m(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.load_timeslice(spark, f"{sf_dir}/orders.parquet", "o_orderdate", "6m", 1995)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum("o_totalprice").cast("decimal(18,2)").alias("total_price"))


@register("s02_csv_headerless", sql="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s02_csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "nation-csv")
    Tables(spark, sf_dir).nation.write.option("header", False).csv(path)
    return S.read_headerless_csv(spark, path, ["n_nationkey", "n_name", "n_regionkey"],
                                 ["int", "string", "int"])


@register("s03_csv_header", sql="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       CAST(o_orderdate AS DATE) AS order_date FROM orders""")
def s03_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    Tables(spark, sf_dir).orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")) \
        .write.option("header", True).csv(path)
    return S.read_csv_with_header(
        spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string",
        date_cols={"o_orderdate": "yyyy-MM-dd"},
        renames={"o_orderkey": "order_id", "o_custkey": "customer_id",
                 "o_orderstatus": "status", "o_orderdate": "order_date"})


@register("s04_json", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def s04_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", S.parse_json_column("props", "k long")["k"].alias("k"))


@register("s04_json_lines", sql="""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def s04_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events-json")
    ev = Tables(spark, sf_dir).events
    ev.select("event_id", "event_type",
              S.parse_json_column("props", "k long").alias("props")).write.json(path)
    back = S.read_json_records(spark, path, "event_id long, event_type string, props struct<k: long>")
    return back.select("event_id", "event_type", F.col("props.k").alias("k"))


@register("s05_sparse_text", sql="""
SELECT CAST(label AS VARCHAR) AS label, CAST(i - 1 AS INTEGER) AS idx,
       'px_' || CAST((i - 1) // 8 AS VARCHAR) || '_' || CAST((i - 1) % 8 AS VARCHAR) AS name
FROM (SELECT label, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings)
WHERE embedding[i] > 0""")
def s05_sparse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "embeddings-sparse")
    emb = Tables(spark, sf_dir).embeddings
    S.render_sparse_lines(emb, "label", "embedding").write.text(path)
    # Feature-name dimension derived from the vectors' own width.
    names = emb.select(F.posexplode(F.sequence(F.lit(0), F.size("embedding") - 1))) \
               .select(F.col("col").alias("idx")).distinct() \
               .select("idx", F.concat(F.lit("px_"), (F.col("idx") / 8).cast("int").cast("string"),
                                       F.lit("_"), (F.col("idx") % 8).cast("string")).alias("name"))
    return S.read_sparse_text(spark, path, names).select("label", "idx", "name")


@register("s05_line_places", sql="""
WITH x AS (SELECT label, len(list_filter(embedding, lambda v: v > 0)) AS n FROM embeddings)
SELECT CAST(label AS VARCHAR) AS label, 2 * count(*) AS n_lines, CAST(2 * sum(n) AS BIGINT) AS n_entries FROM x
WHERE n > 0 GROUP BY 1""")
def s05_line_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines keep their identity by place: every row is written twice, and both lines count."""
    path = scratch_path(spark, "embeddings-twice")
    emb = Tables(spark, sf_dir).embeddings
    S.render_sparse_lines(emb.unionByName(emb), "label", "embedding").write.text(path)
    per_line = S.read_sparse_text(spark, path).groupBy("file", "block", "line", "label").agg(F.count(F.lit(1)).alias("n"))
    return per_line.groupBy("label").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("n").alias("n_entries"))



@register("s06_parquet_sink", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem""")
def s06_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lineitem-parquet")
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                                                "l_returnflag")
    S.write_parquet(li, path)                      # default: error if exists
    S.write_parquet(li, path, mode="overwrite")    # overwrite mode replaces it
    return spark.read.parquet(path)


@register("s07_csv_sink", sql="""
SELECT doc_id, quality, CAST(CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS INTEGER) AS prediction
FROM labels JOIN documents USING (doc_id)""")
def s07_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    pred = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id") \
        .select("doc_id", "quality", (F.col("n_chars") >= 2000).cast("int").alias("prediction"))
    path = scratch_path(spark, "predictions-csv")
    S.write_csv(pred, path)
    return spark.read.schema("doc_id long, quality int, prediction int") \
        .option("header", True).csv(path)


@register("s08_cut", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_quantity >= 25""")
def s08_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem.where(F.col("l_quantity") >= 25) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return S.materialize(li, scratch_path(spark, "lineitem-cut"))


@register("s10_sql_view", sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) IN (1996, 1997)""")
def s10_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    Tables(spark, sf_dir).orders.createOrReplaceTempView("all")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM all "
                     "WHERE year(o_orderdate) IN (1996, 1997)")


# ---------------------------------------------------------------- projection / scalar


@register("p01_prune", sql="SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def p01_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_quantity", "l_extendedprice")


_DOC_LABELS_SQL = "documents d LEFT JOIN labels l USING (doc_id)"


def _doc_labels(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text", "n_chars").join(t.labels, "doc_id", "left")


@register("p02_either_notnull", sql=f"""
SELECT doc_id, quality, toxic FROM {_DOC_LABELS_SQL}
WHERE quality IS NOT NULL OR toxic IS NOT NULL""")
def p02_either_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _doc_labels(Tables(spark, sf_dir))
    return x.where(C.either_not_null("quality", "toxic")).select("doc_id", "quality", "toxic")


@register("p03_row_id", sql="SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem")
def p03_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    with_id = li.select(C.file_row_id().alias("row_id"))
    return with_id.agg(F.count(F.lit(1)).alias("n_rows"),
                       F.count_distinct("row_id").alias("n_ids"))


@register("p04_status_filter", sql=f"""
SELECT doc_id, toxic FROM {_DOC_LABELS_SQL} WHERE toxic != 1""")
def p04_status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _doc_labels(Tables(spark, sf_dir))
    return x.where(F.col("toxic") != 1).select("doc_id", "toxic")


@register("p05_null_repair", sql=f"""
SELECT doc_id, CASE WHEN n_chars = length(text) AND quality IS NULL THEN 0 ELSE quality END
       AS quality_fixed FROM {_DOC_LABELS_SQL}""")
def p05_null_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _doc_labels(Tables(spark, sf_dir))
    return x.select("doc_id", C.repair_null_flag("n_chars", F.length("text"), "quality")
                    .alias("quality_fixed"))


@register("p06_sentinel", sql="""
SELECT p_partkey, CASE WHEN p_size = 50 OR right(p_brand, 1) IN ('2', '3', '6', '7') THEN NULL
       ELSE p_size END AS p_size_clean FROM part""")
def p06_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    return part.select("p_partkey", C.nullify("p_size", 50, F.substring("p_brand", -1, 1),
                                              [2, 3, 6, 7]).alias("p_size_clean"))


@register("p07_packed_parse", sql="""
WITH x AS (SELECT l_orderkey, string_split(concat_ws(',', CAST(l_linenumber AS VARCHAR),
                  l_returnflag, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)), ',') AS parts
           FROM lineitem)
SELECT l_orderkey, TRY_CAST(parts[1] AS INTEGER) AS f_line, TRY_CAST(parts[2] AS INTEGER) AS f_flag,
       TRY_CAST(parts[3] AS DOUBLE) AS f_qty, parts[4] AS f_missing FROM x""")
def p07_packed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    packed = F.concat_ws(",", F.col("l_linenumber").cast("string"), F.col("l_returnflag"),
                         F.col("l_quantity").cast("long").cast("string"))
    return li.select("l_orderkey", *C.packed_fields(
        packed, ["int", "int", "double", "string"], ["f_line", "f_flag", "f_qty", "f_missing"]))


# Packed cells made from lineitem, in SQL that both engines read: numbers padded with zeros,
# every sentinel and quality code, and parts that are short or no numbers.
_N = "(l_orderkey * 7 + l_linenumber * 3)"


def _part(value: str, width: int, sentinel: int, every: int) -> str:
    return f"CASE WHEN {_N} % {every} = 0 THEN '{sentinel}' ELSE lpad(CAST({value} AS STRING), {width}, '0') END"


_CELLS_SQL = {
    "WND": f"concat_ws(',', {_part(f'{_N} % 360', 3, 999, 5)}, CAST({_N} % 9 AS STRING), 'N', "
           f"{_part(f'{_N} % 210', 4, 9999, 7)}, CAST({_N} % 8 AS STRING))",
    "CIG": f"concat_ws(',', {_part(f'{_N} % 22000', 5, 99999, 6)}, CAST({_N} % 7 AS STRING), 'M', 'N')",
    "VIS": f"concat_ws(',', {_part(f'{_N} % 16000', 6, 999999, 4)}, CAST({_N} % 8 AS STRING), "
           f"{_part(f'{_N} % 3', 3, 999, 11)}, CAST({_N} % 5 AS STRING))",
    "TMP": f"concat_ws(',', CASE WHEN {_N} % 3 = 0 THEN '-' ELSE '+' END || {_part(f'{_N} % 400', 4, 9999, 8)}, "
           f"CASE WHEN {_N} % 13 = 0 THEN 'A' ELSE CAST({_N} % 8 AS STRING) END)",
    "DEW": f"concat_ws(',', {_part(f'{_N} % 300', 4, 9999, 9)}, CASE WHEN {_N} % 17 = 0 THEN 'C' ELSE '1' END)",
    "SLP": f"CASE WHEN {_N} % 10 = 0 THEN 'none' ELSE concat_ws(',', {_part(f'9900 + {_N} % 500', 5, 99999, 12)}, "
           f"CAST({_N} % 8 AS STRING)) END",
    "AA1": f"CASE WHEN {_N} % 4 = 1 THEN '06' ELSE concat_ws(',', {_part(f'{_N} % 24', 2, 99, 5)}, "
           f"{_part(f'{_N} % 90', 4, 9999, 7)}, '9', CAST({_N} % 8 AS STRING)) END",
}
_WEATHER_SQL = "(SELECT l_orderkey, l_linenumber, " + ", ".join(f"{sql} AS {cell}" for cell, sql in _CELLS_SQL.items()) + \
    " FROM lineitem)"
_PARSED_SQL = "(SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"string_split({cell}, ',')[{at + 1}] AS {name}" if kind == "string"
    else f"TRY_CAST(string_split({cell}, ',')[{at + 1}] AS INTEGER) AS {name}"
    for cell, fields in WX.CELLS.items() for name, at, kind in fields) + f" FROM {_WEATHER_SQL})"


def weather_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = [F.expr(sql).alias(cell) for cell, sql in _CELLS_SQL.items()]
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", *cells)


@register("p07_weather_parse", sql=f"SELECT * FROM {_PARSED_SQL}")
def p07_weather_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """22 typed fields from the seven packed cells of a weather record."""
    return WX.parse_weather(weather_records(spark, sf_dir))


@register("p06_weather_clean", sql="SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CASE WHEN CAST({name} AS VARCHAR) = '{dict((v, n) for v, n, _ in WX.RULES)[name]}' OR CAST("
    f"{dict((v, q) for v, _, q in WX.RULES)[name]} AS VARCHAR) IN ('2', '3', '6', '7') THEN NULL ELSE {name} END AS {name}"
    if name in {v for v, _, _ in WX.RULES} else name for name in WX.FIELDS) + f" FROM {_PARSED_SQL}")
def p06_weather_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten rules that clear sentinels and values of bad quality."""
    return WX.clean_weather(WX.parse_weather(weather_records(spark, sf_dir)))


@register("p07_url_parse", sql="""
WITH x AS (SELECT page_id, string_split(url, '/') AS parts FROM pages)
SELECT page_id, parts[1] AS scheme, parts[3] AS host, parts[4] AS lang,
       TRY_CAST(parts[5] AS INTEGER) AS path_num FROM x""")
def p07_url_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).pages
    fields = C.packed_fields("url", ["string", "string", "string", "string", "int"],
                             ["scheme", "_empty", "host", "lang", "path_num"], sep="/")
    return pages.select("page_id", *fields).drop("_empty")


def _hhmm(ts: str = "ts"):
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


@register("p08_hhmm", sql="""
SELECT event_id, CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS hhmm,
       strptime(strftime(ts, '%Y-%m-%d') || lpad(CAST(hour(ts) * 100 + minute(ts) AS VARCHAR), 4, '0'),
                '%Y-%m-%d%H%M') AS local_ts
FROM events""")
def p08_hhmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    x = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), _hhmm().alias("hhmm"))
    # Local wall-clock time: a timestamp without zone, as in the source data.
    return x.select("event_id", "hhmm",
                    C.hhmm_to_timestamp("d", "hhmm").cast("timestamp_ntz").alias("local_ts"))


@register("p09_lead", sql="SELECT event_id, ts - INTERVAL 2 HOUR AS cut FROM events")
def p09_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).events.select("event_id", C.lead_time("ts", 2).alias("cut"))


_ZONES = [("view", "America/New_York"), ("signup", "America/Chicago"),
          ("error", "America/Denver"), ("click", "America/Los_Angeles"), ("purchase", None)]


@register("p10_to_utc", sql=f"""
WITH z(event_type, tz) AS (VALUES {', '.join(f"('{k}', {repr(v) if v else 'NULL'})" for k, v in _ZONES)})
SELECT event_id, CASE WHEN tz IS NULL THEN NULL ELSE timezone('UTC', timezone(tz, ts)) END AS utc_ts
FROM events LEFT JOIN z USING (event_type)""")
def p10_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    zones = spark.createDataFrame(_ZONES, "event_type string, tz string")
    x = ev.join(zones, "event_type", "left")
    return x.select("event_id", C.to_utc(F.col("ts").cast("timestamp"), "tz")
                    .cast("timestamp_ntz").alias("utc_ts"))


@register("p11_hour", sql="""
SELECT event_id, CAST(floor((hour(ts) * 100 + minute(ts)) / 100) AS INTEGER) AS hour FROM events""")
def p11_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", C.hour_of_hhmm(_hhmm()).alias("hour"))


_TYPES = ["view", "signup", "error", "click", "purchase"]


def _daily_wide(t: Tables) -> DataFrame:
    ev = t.events.select(F.to_date("ts").alias("day"), "event_type", "value")
    return ev.groupBy("day").pivot("event_type", _TYPES).agg(F.round(F.sum("value"), 2))


_DAILY_WIDE_SQL = f"""
(SELECT CAST(ts AS DATE) AS day,
        {', '.join(f"round(sum(value) FILTER (WHERE event_type = '{k}'), 2) AS {k}" for k in _TYPES)}
 FROM events GROUP BY 1)"""


@register("p13_row_mean", sql=f"""
SELECT day, round(({' + '.join(f'coalesce({k}, 0)' for k in _TYPES)})
              / nullif({' + '.join(f'CAST({k} IS NOT NULL AS INTEGER)' for k in _TYPES)}, 0), 6)
       AS row_mean FROM {_DAILY_WIDE_SQL}""")
def p13_row_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _daily_wide(Tables(spark, sf_dir))
    return wide.select("day", F.round(C.row_mean(_TYPES), 6).alias("row_mean"))


@register("p14_argmax", sql=f"""
SELECT day, CASE {' '.join(
    f"WHEN {k} = greatest({', '.join(_TYPES)}) THEN '{k}'" for k in _TYPES)} END AS top_type
FROM {_DAILY_WIDE_SQL}""")
def p14_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _daily_wide(Tables(spark, sf_dir))
    return wide.select("day", C.row_argmax_name(_TYPES).alias("top_type"))


@register("p15_recode", sql=f"""
SELECT day, CASE WHEN view IS NULL AND click IS NULL THEN NULL
                 WHEN click IS NULL OR view >= click THEN 'viewLead' ELSE 'clickLead' END || ',' ||
            CASE WHEN signup IS NULL AND purchase IS NULL THEN NULL
                 WHEN purchase IS NULL OR signup >= purchase THEN 'signupLead' ELSE 'purchaseLead' END
       AS label4
FROM {_DAILY_WIDE_SQL}""")
def p15_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winner of each column pair (first on ties, missing values skipped),
    recoded to a '...Lead' label, the two joined into a 4-class label (null
    when a pair has no value)."""
    wide = _daily_wide(Tables(spark, sf_dir))
    a = C.row_argmax_name(["view", "click"], ["viewLead", "clickLead"])
    b = C.row_argmax_name(["signup", "purchase"], ["signupLead", "purchaseLead"])
    return wide.select("day", F.concat(a, F.lit(","), b).alias("label4"))


@register("p16_label_code", sql="""
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS segment_code
FROM customer""")
def p16_label_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = Tables(spark, sf_dir).customer
    codes = counts_with_prefix(cust.select("c_mktsegment").distinct(), "c_mktsegment") \
        .select("c_mktsegment", F.col("before").cast("long").alias("segment_code"))
    return cust.join(codes, "c_mktsegment").select("c_custkey", "segment_code")


@register("p17_text_len", sql="""
SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS text_len,
       CAST(length(role || text) AS BIGINT) AS combined_len FROM conversations""")
def p17_text_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = Tables(spark, sf_dir).conversations
    return conv.select("conv_id", "turn", F.length("text").cast("long").alias("text_len"),
                       F.length(F.concat("role", "text")).cast("long").alias("combined_len"))


@register("p18_epoch_parts", sql="""
WITH x AS (SELECT event_id, to_timestamp(CAST(floor(epoch(ts)) AS BIGINT)) AS t FROM events)
SELECT event_id, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
       CAST(day(t) AS INTEGER) AS day, CAST(hour(t) AS INTEGER) AS hour,
       CAST(dayofweek(t) AS INTEGER) AS weekday FROM x""")
def p18_epoch_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return ev.select("event_id", *C.epoch_parts(epoch))


@register("p19_half_month", sql="""
SELECT event_id, CAST(day(ts) <= 15 AS INTEGER) AS first_half FROM events""")
def p19_half_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", C.first_half_of_month("ts").alias("first_half"))


@register("p20_hour_buckets", sql=f"""
SELECT event_id, {', '.join(f'CAST(hour(ts) // 4 = {i} AS INTEGER) AS hour_bucket_{i}'
                            for i in range(6))} FROM events""")
def p20_hour_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", *C.hour_buckets("ts"))


_WORD_RE = r"[\p{L}\p{N}_]{2,}"


@register("p21_membership", sql=r"""
SELECT doc_id, CAST(list_has_any(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}'),
                                 ['the', 'and']) AS INTEGER) AS has_word FROM documents""")
def p21_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    toks = F.regexp_extract_all(F.lower("text"), F.lit(_WORD_RE), 0)
    return docs.select("doc_id", C.contains_any(toks, ["the", "and"]).alias("has_word"))


# The flags' patterns.
_IMAGE_RE = "(imgur\\.com|\\.jpg|png|picture|pic|youtube)"
_LINK_RE = "http[s]?://\\S+|www\\."


@register("p22_regex_flags", sql=f"""
SELECT page_id, CAST(regexp_matches(html, '{_IMAGE_RE}', 'i') AS INTEGER) AS has_image,
       CAST(regexp_matches(html, '{_LINK_RE}', 'i') AS INTEGER) AS has_link FROM pages""")
def p22_regex_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).pages
    return pages.select("page_id", C.regex_flag("html", _IMAGE_RE).alias("has_image"),
                        C.regex_flag("html", _LINK_RE).alias("has_link"))


@register("p23_bin_levels", sql="""
SELECT vec_id, array_to_string(list_transform(embedding,
         lambda x: CASE WHEN x >= 0.1 THEN 2 WHEN x >= -0.1 THEN 1 ELSE 0 END), ',') AS levels,
       CAST(list_sum(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END)) AS INTEGER)
         AS n_positive
FROM embeddings""")
def p23_bin_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = Tables(spark, sf_dir).embeddings
    return emb.select("vec_id",
                      F.array_join(A.three_levels("embedding", -0.1, 0.1), ",").alias("levels"),
                      A.array_sum(A.binarize("embedding", 0.0)).cast("int").alias("n_positive"))


@register("p24_row_standardize", sql="""
WITH s AS (SELECT vec_id, embedding, list_avg(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS m,
                  sqrt(list_avg(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))
                       - pow(list_avg(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 2)) AS sd
           FROM embeddings),
z AS (SELECT vec_id, list_transform(embedding,
        lambda x: (CAST(x AS DOUBLE) - m) / CASE WHEN sd = 0 OR sd IS NULL THEN 1 ELSE sd END) AS zz FROM s)
SELECT vec_id, round(zz[1], 6) AS z_first, round(list_sum(list_transform(zz, lambda v: v * v)), 4) AS z_sumsq
FROM z""")
def p24_row_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = Tables(spark, sf_dir).embeddings
    z = A.standardize(emb, "embedding", "z")
    return z.select("vec_id", F.round(F.col("z")[0], 6).alias("z_first"),
                    F.round(A.array_sum(F.transform("z", lambda v: v * v)), 4).alias("z_sumsq"))


@register("p25_noise")
def p25_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = Tables(spark, sf_dir).embeddings
    return emb.select("vec_id", A.add_gaussian_noise("embedding", 0.1, seed=7).alias("noisy"))


@register("p26_box_filter", sql=A.BOX_FILTER_SQL)
def p26_box_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = Tables(spark, sf_dir).embeddings
    f = emb.select("vec_id", A.box_filter("embedding", 8, 8).alias("f"))
    return f.select("vec_id", F.round(A.array_sum("f"), 6).alias("f_sum"),
                    F.round(F.col("f")[9], 6).alias("f_9"), F.round(F.col("f")[0], 6).alias("f_0"))


@register("p27_log_odds", sql="""
WITH r AS (SELECT source, count(*) AS n, avg(CAST(quality AS DOUBLE)) AS rate
           FROM documents JOIN labels USING (doc_id) GROUP BY source)
SELECT source, round(ln(n), 6) AS log_n, round(rate / nullif(1 - rate, 0), 6) AS odds FROM r""")
def p27_log_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    r = t.documents.join(t.labels, "doc_id").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("quality").cast("double")).alias("rate"))
    return r.select("source", F.round(F.log("n"), 6).alias("log_n"),
                    F.round(C.log_odds("rate"), 6).alias("odds"))


@register("p28_calendar_filter", sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE year(o_orderdate) IN (1996, 1997) AND o_orderdate <= TIMESTAMP '1997-06-30'""")
def p28_calendar_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    import datetime as dt
    return o.where(F.year("o_orderdate").isin(1996, 1997)
                   & (F.col("o_orderdate") <= F.lit(dt.datetime(1997, 6, 30)))) \
            .select("o_orderkey", "o_orderdate")


@register("p29_bool_label", sql="""
SELECT doc_id, CAST(quality = 1 AS INTEGER) AS label FROM labels""")
def p29_bool_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = Tables(spark, sf_dir).labels
    return lab.select("doc_id", (F.col("quality") == 1).cast("int").alias("label"))


@register("p30_elapsed_minutes", sql="""
WITH e AS (SELECT event_id, user_id, ts, event_type, value FROM (
   SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn FROM events)
   WHERE rn = 1),
p AS (SELECT event_id, user_id, ts, ts - INTERVAL 2 HOUR AS cut FROM e WHERE event_type = 'purchase'),
v AS (SELECT event_id AS view_id, user_id, ts AS view_ts FROM e WHERE event_type = 'view')
SELECT p.event_id, round((epoch_us(p.ts) - epoch_us(v.view_ts)) / 60000000.0, 4) AS minutes
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.cut >= v.view_ts""")
def p30_elapsed_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = clean_events(Tables(spark, sf_dir))
    left = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = ev.where(F.col("event_type") == "view") \
              .select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts"))
    j = asof_join(left, right, "user_id", "ts", "view_ts", ["view_ts"], lead_seconds=7200,
                  right_tiebreak="view_id", bucket_seconds=ASOF_BUCKET_SECONDS)
    return j.select("event_id", F.round(C.minutes_between("ts", "view_ts"), 4).alias("minutes"))


_ = enriched_purchases  # re-exported for callers building on the flagship


@register("p12_role_prefix", sql="""
SELECT o.o_orderkey, c.c_name AS CUST_c_name, c.c_mktsegment AS CUST_c_mktsegment,
       n.n_name AS CUST_n_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def p12_role_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualified star on the fact plus role-prefixed dimension columns."""
    from tessera.operators.joins import prefixed

    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer
    n = t.nation
    x = o.join(c, o["o_custkey"] == c["c_custkey"]) \
         .join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    return x.select(o["o_orderkey"], *prefixed(c, ["c_name", "c_mktsegment"], "CUST_"),
                    *prefixed(n, ["n_name"], "CUST_"))
