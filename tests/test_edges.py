"""Hand-built edge frames (FIXTURES.md part C) and cross-checks of two
formulations of the same operator."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import curves as CV
from tessera.operators import graph as G
from tessera.operators import joins as J
from tessera.operators import metrics as M
from tessera.operators import profile as P
from tessera.operators import ranking as R
from tessera.operators import temporal as W
from tessera.operators import text as T
from tessera.operators.encode import zscore

T0 = dt.datetime(2024, 3, 10, 0, 0)


def ts(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_nullify_sentinel_and_quality(spark):
    df = spark.createDataFrame(
        [(1, 9999.0, "1"), (2, 12.0, "3"), (3, 12.0, None), (4, None, "1"), (5, 7.0, "A")],
        "id int, v double, q string")
    out = dict(df.select("id", C.nullify("v", 9999.0, "q", [2, 3, 6, 7]).alias("x")).collect())
    assert out == {1: None, 2: None, 3: 12.0, 4: None, 5: 7.0}


def test_packed_fields(spark):
    df = spark.createDataFrame([("1,2,3",), ("1,2",), ("x,2,3",), ("+0012,5,6",), (None,)], "p string")
    rows = df.select(*C.packed_fields("p", ["int", "int", "int"], ["a", "b", "c"])).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3), (1, 2, None), (None, 2, 3), (12, 5, 6),
                                        (None, None, None)]


def test_hhmm_to_timestamp(spark):
    df = spark.createDataFrame([(5,), (45,), (930,), (2359,), (2400,), (None,)], "t int")
    got = [r[0] for r in df.select(C.hhmm_to_timestamp(F.lit("2015-01-02"), "t")).collect()]
    assert got[:4] == [dt.datetime(2015, 1, 2, 0, 5), dt.datetime(2015, 1, 2, 0, 45),
                       dt.datetime(2015, 1, 2, 9, 30), dt.datetime(2015, 1, 2, 23, 59)]
    assert got[4] is None and got[5] is None
    hours = [r[0] for r in df.select(C.hour_of_hhmm("t")).collect()]
    assert hours == [0, 0, 9, 23, 24, None]


def test_to_utc_across_dst(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2019, 3, 10, 1, 30), "America/New_York"),   # before the spring change
         (dt.datetime(2019, 3, 10, 3, 30), "America/New_York"),   # after it
         (dt.datetime(2019, 11, 3, 0, 30), "America/Chicago"),
         (dt.datetime(2019, 11, 3, 3, 30), "America/Chicago"),
         (dt.datetime(2019, 6, 1, 12, 0), None)], "t timestamp_ntz, z string")
    got = [r[0] for r in df.select(C.to_utc(F.col("t").cast("timestamp"), "z")).collect()]
    assert got[0] == dt.datetime(2019, 3, 10, 6, 30)
    assert got[1] == dt.datetime(2019, 3, 10, 7, 30)
    assert got[2] == dt.datetime(2019, 11, 3, 5, 30)
    assert got[3] == dt.datetime(2019, 11, 3, 9, 30)
    assert got[4] is None


# ---------------------------------------------------------------- as-of join

def _asof_fixture(spark):
    left = spark.createDataFrame([
        (1, "A", ts(240)),        # right exactly at cut-off (ts-120) -> matches 2 (t=120)
        (2, "B", ts(60)),         # only later rights
        (3, "C", ts(300)),        # no rights for key
        (4, "D", ts(500)),        # duplicate right times at 200 -> larger tiebreak wins
        (5, None, ts(500)),       # null key
        (6, "A", ts(24 * 60 + 30)),   # next day, carry-over from the previous day
    ], "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame([
        (1, "A", ts(100), 1.0), (2, "A", ts(120), 2.0), (3, "A", ts(121), 3.0),
        (4, "B", ts(200), 4.0),
        (5, "D", ts(200), 5.0), (6, "D", ts(200), 6.0),
        (7, None, ts(10), 7.0),
    ], "rid int, k string, rt timestamp_ntz, v double")
    return left, right


def _brute_asof(left, right, lead_min):
    out = {}
    for _, l in left.iterrows():
        if l["k"] is None:
            out[l["id"]] = None
            continue
        cut = l["t"] - pd.Timedelta(minutes=lead_min)
        cand = right[(right["k"] == l["k"]) & (right["rt"] <= cut)]
        out[l["id"]] = None if cand.empty else int(cand.sort_values(["rt", "rid"]).iloc[-1]["rid"])
    return out


@pytest.mark.parametrize("bucket", [None, 3600, 86400])
def test_asof_join_edges(spark, bucket):
    left, right = _asof_fixture(spark)
    out = J.asof_join(left, right, "k", "t", "rt", ["rid", "v"], lead_seconds=7200,
                      right_tiebreak="rid", bucket_seconds=bucket)
    got = {r["id"]: r["rid"] for r in out.collect()}
    want = _brute_asof(left.toPandas(), right.toPandas(), 120)
    assert got == want
    assert got == {1: 2, 2: None, 3: None, 4: 6, 5: None, 6: 3}
    assert out.count() == left.count()


def test_asof_matches_brute_force_on_events(spark):
    from tessera.plans.core_queries import clean_events
    from tessera.sources.tables import Tables

    from tests.conftest import SMALL

    ev = clean_events(Tables(spark, SMALL))
    left = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = ev.where("event_type = 'view'").select(F.col("event_id").alias("rid"), "user_id",
                                                    F.col("ts").alias("rt"))
    a = {r[0]: r[1] for r in J.asof_join(left, right, "user_id", "ts", "rt", ["rid"], 7200, "",
                                          "rid").select("event_id", "rid").collect()}
    b = {r[0]: r[1] for r in J.asof_join(left, right, "user_id", "ts", "rt", ["rid"], 7200, "",
                                          "rid", bucket_seconds=3600).select("event_id", "rid").collect()}
    lp = left.toPandas().rename(columns={"user_id": "k", "ts": "t", "event_id": "id"})
    rp = right.toPandas().rename(columns={"user_id": "k"})
    assert a == b == _brute_asof(lp, rp, 120)


# ---------------------------------------------------------------- windows

def test_nearest_per_group_ties(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 5.0), (1, 12, 7.0), (2, 20, 1.0)],
                               "g int, s int, d double")
    ties = sorted(tuple(r) for r in J.nearest_per_group(df, "g", "d").collect())
    assert ties == [(1, 10, 5.0), (1, 11, 5.0), (2, 20, 1.0)]
    one = sorted(tuple(r) for r in J.nearest_per_group(df, "g", "d", keep_ties=False,
                                                         tiebreak=["s"]).collect())
    assert one == [(1, 10, 5.0), (2, 20, 1.0)]


def _legs(spark):
    # unit U1: first leg; leg1 delayed 15 exactly; leg before cut-off with gap rules
    rows = [
        (1, "U1", ts(0), 20.0),     # first leg -> 0
        (2, "U1", ts(60), 15.0),    # prev ends 60 min before; cut = ts-120 -> diff -60 < 15 -> 0
        (3, "U1", ts(300), 0.0),    # cut=180; prev1 (60) diff=120 >= 15, delay 15 >= 15 -> 1
        (4, "U1", ts(440), 0.0),    # cut=320; prev1 (300) diff=20 >= 15 but delay 0; -> 0
        (5, "U1", ts(425 + 10), 0.0),
        (6, "U2", ts(100), 30.0),
        (7, "U2", ts(225), 0.0),    # cut=105; prev1 diff=5 < 15; prev2 none -> 0
        (8, "U2", ts(24 * 60 + 200), 0.0),   # previous leg on another day -> 0
        (9, "U3", ts(0), 40.0),
        (10, "U3", ts(130), 1.0),
        (11, "U3", ts(250), 0.0),   # cut=130: prev1 (130) diff 0 < 15, prev2 (0) diff 130, delay 40 -> 1
    ]
    return spark.createDataFrame(rows, "id int, u string, t timestamp_ntz, d double")


@pytest.mark.parametrize("bucket", [None, 3600, 600])
def test_previous_leg_flag(spark, bucket):
    df = _legs(spark)
    got = dict(W.previous_leg_flag(df, "u", "t", "d", tiebreak="id", out="f",
                                   bucket_seconds=bucket).select("id", "f").collect())
    assert got[1] == 0 and got[2] == 0 and got[3] == 1 and got[4] == 0
    assert got[7] == 0 and got[8] == 0 and got[11] == 1
    assert all(v in (0, 1) for v in got.values())


def test_previous_leg_flag_matches_unit_window(spark):
    from tessera.plans.core_queries import clean_events
    from tessera.sources.tables import Tables

    from tests.conftest import SMALL

    ev = clean_events(Tables(spark, SMALL))
    a = W.previous_leg_flag(ev, "user_id", "ts", "value", tiebreak="event_id").select("event_id", "prev_delayed")
    b = W.previous_leg_flag(ev, "user_id", "ts", "value", tiebreak="event_id", bucket_seconds=1800) \
         .select("event_id", "prev_delayed")
    assert sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize("bucket", [None, 3600, 900])
def test_trailing_count(spark, bucket):
    rows = [(1, "P", ts(0), 20.0), (2, "P", ts(135), 0.0), (3, "P", ts(134), 0.0),
            (4, "P", ts(10), 20.0), (5, "P", ts(10), 1.0), (6, "P", ts(300), 0.0),
            (7, "Q", ts(5), 50.0)]
    df = spark.createDataFrame(rows, "id int, place string, t timestamp_ntz, d double")
    got = dict(W.trailing_count(df, "place", "t", "d", out="n", bucket_seconds=bucket)
               .select("id", "n").collect())
    assert got[2] == 1          # exactly 135 min after row 1
    assert got[3] is None       # 134 min: nothing at or before -1 min -> empty frame
    assert got[1] is None and got[7] is None
    assert got[6] == 2          # rows 1 and 4 are delayed and far enough back
    assert got[4] is None and got[5] is None


def test_trailing_count_bucketed_equals_plain(spark):
    from tessera.plans.core_queries import clean_events
    from tessera.sources.tables import Tables

    from tests.conftest import SMALL

    ev = clean_events(Tables(spark, SMALL))
    a = W.trailing_count(ev, "event_type", "ts", "value").select("event_id", "n_prev_delays")
    b = W.trailing_count(ev, "event_type", "ts", "value", bucket_seconds=1200) \
         .select("event_id", "n_prev_delays")
    assert sorted(a.collect()) == sorted(b.collect())


def test_percent_rank_global_matches_window(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3, 1, 1, 2, None, 5, 5, 5, 0])],
                               "id int, v int")
    got = dict(R.percent_rank_global(df, "v", n_buckets=3).select("id", "pct_rank").collect())
    want = dict(df.select("id", F.percent_rank().over(Window.orderBy("v"))).collect())
    assert got == pytest.approx(want)
    one = spark.createDataFrame([(1, 7)], "id int, v int")
    assert R.percent_rank_global(one, "v").first()["pct_rank"] == 0.0


@pytest.mark.parametrize("n", [1, 7, 10, 23])
def test_first_come_deciles_match_qcut(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, 5, n).astype(float)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id int, v double")
    got = dict(R.first_come_deciles(df, "v", "id", n_buckets=4).select("id", "decile").collect())
    if n == 1:
        assert got == {0: 0}
        return
    want = pd.qcut(pd.Series(vals).rank(method="first"), 10, labels=False)
    assert got == {i: int(w) for i, w in enumerate(want)}


def test_deciles_all_equal(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(10)], "id int, v double")
    got = dict(R.first_come_deciles(df, "v", "id").select("id", "decile").collect())
    assert got == {i: i for i in range(10)}


def test_exact_quantiles(spark):
    vals = [5.0, 1.0, 3.0, 3.0, 10.0, 7.0, 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = R.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0], few=2).first()
    assert list(q) == pytest.approx(list(np.quantile(vals, [0.0, 0.25, 0.5, 0.9, 1.0])))


# ---------------------------------------------------------------- profiles, normalisation

def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, None)], "a int, b string")
    got = {r["column_name"]: (r["n_null"], r["pct_null"], r["all_null"])
           for r in P.null_profile(df).collect()}
    assert got == {"a": (1, 33.33, False), "b": (3, 100.0, True)}
    empty = P.null_profile(df.limit(0)).collect()
    assert all(r["n_null"] == 0 and r["pct_null"] is None for r in empty)


def test_zscore_constant_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0), (3, None, 5.0)], "id int, a double, c double")
    got = {r["id"]: (r["a_scaled"], r["c_scaled"]) for r in zscore(df, ["a", "c"], keep=["id"]).collect()}
    assert got[1][0] == pytest.approx(-1 / math.sqrt(2)) and got[2][0] == pytest.approx(1 / math.sqrt(2))
    assert got[3][0] is None
    assert all(v[1] is None for v in got.values())


def test_dedup_is_deterministic(spark):
    df = spark.createDataFrame([(1, 3, "z"), (1, 2, "y"), (1, 2, "x"), (2, 9, "w")], "k int, o int, s string")
    got = sorted(tuple(r) for r in P.dedup_by_key(df, ["k"], ["o", "s"]).collect())
    assert got == [(1, 2, "x"), (2, 9, "w")]


# ---------------------------------------------------------------- graph

def _numpy_pagerank(nodes, edges, alpha=0.85, rounds=50):
    idx = {n: i for i, n in enumerate(nodes)}
    n = len(nodes)
    m = np.zeros((n, n))
    for s, d, w in edges:
        m[idx[s], idx[d]] += w
    out = m.sum(axis=1)
    r = np.full(n, 1.0 / n)
    for _ in range(rounds):
        dang = r[out == 0].sum()
        nxt = np.zeros(n)
        for i in range(n):
            if out[i] > 0:
                nxt += r[i] * m[i] / out[i]
        r = alpha * nxt + (alpha * dang + 1 - alpha) / n
    return {nodes[i]: r[i] for i in range(n)}


def test_pagerank_matches_dense_iteration(spark):
    edges = [("a", "b", 1.0), ("a", "c", 3.0), ("b", "c", 1.0), ("c", "a", 2.0), ("c", "c", 1.0),
             ("d", "e", 1.0), ("e", "d", 1.0), ("a", "b", 1.0), ("f", "g", 1.0)]  # dup edge, dangling g
    df = spark.createDataFrame(edges, "s string, d string, w double")
    e = G.weighted_edges(df, "s", "d", "w")
    got = {r["node"]: r["rank"] for r in G.pagerank(e, fixed_rounds=12).collect()}
    want = _numpy_pagerank(sorted(got), [(s, d, w) for s, d, w in edges], rounds=12)
    assert got == pytest.approx(want, abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)
    conv = {r["node"]: r["rank"] for r in G.pagerank(e).collect()}
    assert conv == pytest.approx(_numpy_pagerank(sorted(got), edges, rounds=200), abs=1e-5)


def test_degree_centrality(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a"), ("c", "c")], "s string, d string")
    got = {r["node"]: r["degree_centrality"] for r in
           G.degree_centrality(G.weighted_edges(df, "s", "d")).collect()}
    assert got == {"a": 1.0, "b": 1.0, "c": 1.0}


# ---------------------------------------------------------------- text

def test_tfidf_edges(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "aa cc"), (3, "")], "doc_id int, text string")
    tf = T.term_counts(docs)
    w = {(r["doc_id"], r["term"]): r["w"] for r in
         T.tfidf(tf, n_docs=docs.select(F.count(F.lit(1))).scalar()).collect()}
    n = 3  # the empty document still counts in the corpus size
    idf = {"aa": math.log((1 + n) / (1 + 2)) + 1, "bb": math.log((1 + n) / (1 + 1)) + 1,
           "cc": math.log((1 + n) / (1 + 1)) + 1}
    raw1 = {"aa": 2 * idf["aa"], "bb": idf["bb"]}
    norm = math.sqrt(sum(v * v for v in raw1.values()))
    assert w[(1, "aa")] == pytest.approx(raw1["aa"] / norm)
    assert w[(1, "bb")] == pytest.approx(raw1["bb"] / norm)
    assert not any(k[0] == 3 for k in w)


# ---------------------------------------------------------------- metrics

def test_binary_metrics_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    r = M.binary_metrics(df).first()
    assert (r["tp"], r["fn"], r["precision"], r["recall"], r["f1"]) == (0, 2, 0.0, 0.0, 0.0)


def test_confusion_matrix_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 1)], "label int, prediction int")
    got = {(r["label"], r["prediction"]): r["n"] for r in M.confusion_matrix(df).collect()}
    assert len(got) == 9 and got[(2, 2)] == 0 and got[(1, 0)] == 1


def test_auc_extremes(spark):
    same = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 1), (0.5, 0)], "s double, label int")
    assert CV.auc(same, "s", "label").first()[0] == pytest.approx(0.5)
    perfect = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.1, 0), (0.2, 0)], "s double, label int")
    assert CV.auc(perfect, "s", "label").first()[0] == pytest.approx(1.0)


def test_calibration_edges(spark):
    df = spark.createDataFrame([(0.5, 1, 1), (0.9, 1, 0), (0.95, 0, 0)], "max_posterior double, label int, prediction int")
    got = {r["bucket"]: (r["total"], r["correct"], r["accuracy"])
           for r in M.calibration(df, [0.5, 0.9, 1.0]).collect()}
    assert got == {0: (1, 1, 1.0), 1: (1, 0, 0.0), 2: (1, 1, 1.0)}
    got2 = {r["bucket"]: r["total"] for r in M.calibration(df, [0.2, 0.5, 0.9, 1.0]).collect()}
    assert got2[0] == 0


def test_knn_blocks_equal_single_block(spark, monkeypatch):
    from tessera.operators import neighbors as NB

    rng = np.random.default_rng(1)
    pts = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(i, [float(x) for x in p], int(i % 3)) for i, p in enumerate(pts)],
                               "id long, v array<double>, y int")
    q, r = df.where("id < 25"), df.where("id >= 25")
    one = sorted(NB.knn_vote(NB.knn_candidates(q, r, 3, "id", "id", "v", "y"), [1, 3]).collect())
    monkeypatch.setattr(NB, "CELL", 6)
    many = sorted(NB.knn_vote(NB.knn_candidates(q, r, 3, "id", "id", "v", "y"), [1, 3]).collect())
    assert one == many and len(one) == 50
    d = ((pts[:25, None, :] - pts[None, 25:, :]) ** 2).sum(-1)
    nearest = d.argmin(axis=1) + 25
    got = {r["qid"]: r["prediction"] for r in one if r["k"] == 1}
    assert got == {i: int(nearest[i] % 3) for i in range(25)}


def test_first_come_rank_hot_value(spark):
    rows = [(i, 1.0 if i % 10 else float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v double")
    got = dict(R.first_come_rank(df, "v", "id", n_buckets=8).select("id", "rank").collect())
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(order)}


def test_timeslice_prunes_year_directories(spark, tmp_path):
    from tessera.sources import files as S

    from tests.conftest import SMALL

    o = spark.read.parquet(f"{SMALL}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    path = str(tmp_path / "orders_by_year")
    o.write.partitionBy("year").parquet(path)
    df = S.load_timeslice(spark, path, "o_orderdate", "1997", 1995, cols=["o_orderkey", "o_orderdate"],
                          year_partition="year")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    want = o.where(F.year("o_orderdate") == 1997).count()
    assert df.count() == want and df.columns == ["o_orderkey", "o_orderdate"]
    six = S.load_timeslice(spark, path, "o_orderdate", "6m", 1995, year_partition="year")
    assert six.count() == o.where("o_orderdate < timestamp'1995-07-01'").count()


def test_row_mean_and_argmax_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, 2.0, 1.0)],
                               "a double, b double, c double")
    rows = df.select(C.row_mean(["a", "b", "c"]).alias("m"),
                     C.row_argmax_name(["a", "b", "c"]).alias("w")).collect()
    assert [(r["m"], r["w"]) for r in rows] == [(2.0, "c"), (None, None), (5.0 / 3.0, "a")]


def test_sparse_text_reader_edges(spark, tmp_path):
    from tessera.sources import files as S

    path = tmp_path / "sparse.txt"
    path.write_text("1 3:1 5:1\n\n0\n  2 x:1 7:1  \n")
    names = spark.createDataFrame([(3, "f3"), (7, "f7")], "idx int, name string")
    rows = sorted(((r["label"], r["idx"], r["name"]) for r in
                   S.read_sparse_text(spark, str(path), names).collect()), key=repr)
    # blank line skipped, a label-only line has no features, a bad index is null
    assert rows == sorted([("1", 3, "f3"), ("1", 5, None), ("2", None, None), ("2", 7, "f7")], key=repr)


def test_headerless_csv_short_row(spark, tmp_path):
    from tessera.sources import files as S

    path = tmp_path / "dim.csv"
    path.write_text("1,ALPHA,3\n2,BETA\nx,GAMMA,5\n")
    rows = [tuple(r) for r in S.read_headerless_csv(spark, str(path), ["k", "name", "grp"],
                                                   ["int", "string", "int"]).orderBy("name").collect()]
    assert rows == [(1, "ALPHA", 3), (2, "BETA", None), (None, "GAMMA", 5)]


def test_csv_with_header_dates_and_renames(spark, tmp_path):
    from tessera.sources import files as S

    path = tmp_path / "series.csv"
    path.write_text("Dates,GrowthRet\n2020-01-03,0.5\n2020-01-06,\nbad-date,1.5\n")
    df = S.read_csv_with_header(spark, str(path), "Dates string, GrowthRet double",
                                date_cols={"Dates": "yyyy-MM-dd"},
                                renames={"Dates": "date", "GrowthRet": "growth"})
    rows = [tuple(r) for r in df.collect()]
    assert df.columns == ["date", "growth"]
    assert rows[0] == (dt.date(2020, 1, 3), 0.5) and rows[1] == (dt.date(2020, 1, 6), None)
    assert rows[2] == (None, 1.5)


def test_parquet_sink_modes(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from tessera.sources import files as S

    path = str(tmp_path / "out")
    df = spark.range(5)
    S.write_parquet(df, path)
    with pytest.raises(AnalysisException):
        S.write_parquet(df, path)              # default mode: error if the path exists
    S.write_parquet(spark.range(3), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_auc_and_vocabulary_report_on_degenerate_input(spark):
    one_class = spark.createDataFrame([(0.9, 1), (0.2, 1)], "s double, label int")
    assert CV.auc(one_class, "s", "label").first()[0] is None
    empty = spark.createDataFrame([], "doc_id long, term string, tf long")
    r = T.vocabulary_report(empty).first()
    assert r["vocab_size"] == 0 and r["avg_nnz"] is None and r["density_pct"] is None
