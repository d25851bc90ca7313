"""Fits are not shortened: the reference's grids, and stops by tolerance."""

import threading

import numpy as np

from tessera.operators import topics as TP
from tessera.plans import ml_queries as Q


def test_grids_of_the_reference():
    assert {k: sorted(v) for k, v in Q.LR_GRID.items()} == {
        "maxIter": [1, 30], "regParam": [0.001, 0.01], "elasticNetParam": [0.1, 0.25, 0.5]}
    assert sorted(tuple(g.values()) for g in Q.GBT_GRID) == [
        (d, 350, i, s) for d in (7, 11) for i in (7, 9) for s in (0.35, 0.45)]


def test_nmf_ends_by_tolerance(spark):
    v = spark.createDataFrame([(d, f"t{t}", float(1 + (d * t) % 5)) for d in range(6) for t in range(5)],
                              "doc_id long, term string, w double")
    assert len(TP.nmf(v, 2, rounds=40, tol=0.9)[2]) == 10


def test_nmf_equals_a_dense_descent(spark):
    rng = np.random.default_rng(0)
    dense = np.where(rng.random((7, 5)) < 0.6, rng.random((7, 5)), 0.0)
    dense[:, 0] += 0.1
    dense[0] += 0.1
    v = spark.createDataFrame([(d, f"t{t}", float(x)) for (d, t), x in np.ndenumerate(dense) if x],
                              "doc_id long, term string, w double")
    alpha, ratio = 0.05, 0.4
    starts = TP.nmf(v, 2, rounds=0)[:2]
    w = np.array([r[1:] for r in sorted(map(tuple, starts[0].collect()))])
    h = np.array([r[1:] for r in sorted(map(tuple, starts[1].collect()))]).T
    for _ in range(3):
        for j in range(2):
            rest = w.T @ dense - (w.T @ w) @ h + np.outer((w.T @ w)[:, j], h[j])
            h[j] = np.maximum(rest[j] - alpha * ratio, 0) / ((w.T @ w)[j, j] + alpha * (1 - ratio))
        for j in range(2):
            rest = dense @ h.T - w @ (h @ h.T) + np.outer(w[:, j], (h @ h.T)[:, j])
            w[:, j] = np.maximum(rest[:, j] - alpha * ratio, 0) / ((h @ h.T)[j, j] + alpha * (1 - ratio))
    got_w, got_h, losses = TP.nmf(v, 2, rounds=3, alpha=alpha, l1_ratio=ratio)
    assert np.allclose([r[1:] for r in sorted(map(tuple, got_w.collect()))], w)
    assert np.allclose(np.array([r[1:] for r in sorted(map(tuple, got_h.collect()))]).T, h)
    loss = 0.5 * ((dense - w @ h) ** 2).sum() + alpha * ratio * (w.sum() + h.sum()) + alpha * (1 - ratio) / 2 * (
        (w ** 2).sum() + (h ** 2).sum())
    assert np.isclose(losses[-1], loss)


def test_one_vs_rest_equals_a_dense_minimum(spark):
    from tessera.operators import linear as L

    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 4))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=120) > 0.3, "b", "a")
    y[:15] = "c"
    df = spark.createDataFrame([(r.tolist(), str(t)) for r, t in zip(x, y)], "v array<double>, y string").repartition(3)
    ones = np.column_stack([x, np.ones(120)])
    for p in L.one_vs_rest(df, "v", "y", [0.05, 2.0]):
        assert all(b <= a * (1 + 1e-12) for a, b in zip(p.history, p.history[1:]))
        assert L.residual(p) < 1e-6
        # plain proximal gradient descent on the dense data
        t, w = np.where(y == p.label, 1.0, 0.0), np.zeros(5)
        rate = 1 / (p.c * np.linalg.norm(ones, 2) ** 2 / 4 + (p.penalty == "l2"))
        for _ in range(60_000 if p.c > 1 else 20_000):
            g = p.c * ones.T @ (1 / (1 + np.exp(-ones @ w)) - t)
            w = w - rate * (g + w) if p.penalty == "l2" else np.sign(w - rate * g) * np.maximum(np.abs(w - rate * g) - rate, 0)
        assert np.allclose(p.w, w, atol=1e-5), (p.penalty, p.c, p.label)
        assert np.isclose((p.w ** 2).sum(), (w ** 2).sum(), atol=1e-5)


def test_kept_rows_of_v_number_the_terms_across_cuts(monkeypatch):
    """A document part is kept in rows of bounded size; its terms are numbered in order, once."""
    import pyarrow as pa

    rows = [(0, q, j, i, float(10 * j + i)) for q in range(2) for j in range(3) for i in range(j + 1)]
    rows += [(1, 0, 0, 0, 5.0)]
    names, kinds = "pqjiv", [pa.int32()] * 4 + [pa.float64()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[a:a + 2]), kinds)], list(names))
               for a in range(0, len(rows), 2)]
    monkeypatch.setattr(TP, "ROW_ENTRIES", 4)
    kept = [r for b in TP._kept_rows(iter(batches)) for r in b.to_pylist()]
    assert [(r["p"], r["seq"]) for r in kept] == [(0, 0), (0, 1), (0, 2), (1, 0)]
    got, terms = [], {}
    for r in kept:
        new = zip(np.frombuffer(r["term_part"], np.int32), np.frombuffer(r["term_at"], np.int32))
        terms.setdefault(r["p"], []).extend(new)
        d, t, v = (np.frombuffer(r[c], k) for c, k in (("d", np.int32), ("t", np.int32), ("v", np.float64)))
        got += [(r["p"], *map(int, terms[r["p"]][b]), int(a), float(x)) for a, b, x in zip(d, t, v)]
    assert got == rows
    assert terms[0] == [(q, j) for q in range(2) for j in range(3)]


def test_nmf_in_rounds_sends_numbers_only(spark):
    """The kept V and the mail of a round hold no keys: a factor's rows meet them again at the end."""
    v = spark.createDataFrame([(d, f"t{t}", float(1 + (i * t) % 5)) for i, d in enumerate((1, 2, None)) for t in range(3)],
                              "doc_id long, term string, w double")
    w, h, losses = TP.nmf(v, 2, rounds=2)
    assert sorted(r.doc_id for r in w.collect()) == [1, 2] and h.count() == 3 and losses[1] <= losses[0]
    assert "string" not in TP._ROW and [f.name for f in TP._MAIL_ARROW if f.type == "string"] == ["kind"]


def test_mixtures_of_both_classes_are_fitted_at_a_time(spark, monkeypatch):
    both = threading.Barrier(2, timeout=60)

    def fit(df, vector, k):
        both.wait()
        y = df.first()["y"]
        return Q.GM.Mixture(np.ones(1), np.full((1, 2), 10.0 * y), np.eye(2)[None])

    rows = spark.createDataFrame([(i, i % 2, [10.0 * (i % 2), 9.0 * (i % 2)]) for i in range(8)],
                                 "vec_id long, y int, pcs array<double>")
    monkeypatch.setattr(Q, "_binary_images", lambda t, dims: (rows, rows))
    monkeypatch.setattr(Q.GM, "mllib_full_mixture", fit)
    got = Q.l14_gmm_classify(spark, "").collect()
    assert sorted((r["vec_id"], r["prediction"]) for r in got) == [(i, i % 2) for i in range(8)]


def test_nmf_keeps_one_table_per_factor(spark):
    """A factor's table is deleted once the next one is written, and V's own once it is dealt."""
    from tessera import session

    v = spark.createDataFrame([(d, f"t{t}", float(1 + (d * t) % 5)) for d in range(6) for t in range(5)],
                              "doc_id long, term string, w double")
    tables = []
    for rounds in (2, 6):
        before = len(session._SCRATCH)
        w, h, losses = TP.nmf(v, 2, rounds=rounds)
        tables.append([p for p in session._SCRATCH[before:] if "nmf-" in p])
        assert (w.count(), h.count(), len(losses)) == (6, 5, rounds)
    assert [len(t) for t in tables] == [2, 2]


def test_nmf_reads_a_written_matrix_as_it_lies(spark):
    v = spark.createDataFrame([(d, f"t{t}", float(1 + (i * t) % 5)) for i, d in enumerate((1, 2, 3, None)) for t in range(5)],
                              "doc_id long, term string, w double")
    own, given = (TP.nmf(x, 2, rounds=2, written=x is not v) for x in (v, TP.cut_lineage(v)))
    for a, b in zip(own[:2], given[:2]):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert np.allclose(own[2], given[2])
