"""Gaussian mixtures with constrained covariances by EM on DataFrames (L-14, L-15).

MLlib's GaussianMixture only has full covariances; the reference also searches
spherical, diagonal and tied ones. Each EM round here is one pass over the
rows: a mapInPandas E-step turns each partition into one row of sufficient
statistics (responsibility-weighted counts, sums, second moments) for every
model being fitted, and the closed-form M-step runs on their sum. Only
parameters and statistics (models x components x dims^2 numbers, bounded by
the parameter cap) reach the driver. Scoring new rows is a column expression
with the fitted parameters inlined.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COV_TYPES = ("spherical", "diag", "tied", "full")
REG_COVAR = 1e-6


def n_parameters(cov: str, dims: int, comps: int, classes: int = 2) -> int:
    """Parameter count of one model per class (mixing weights counted, the
    last one of each model implied)."""
    if cov == "tied":
        per_class = comps * dims + comps + dims * (dims + 1) // 2
        return (per_class - 1) * classes
    per_comp = {"full": dims * (dims + 1) // 2, "diag": dims, "spherical": 1}[cov]
    return ((dims + per_comp + 1) * comps - 1) * classes


def search_grid(max_params: int = 50, dims=range(2, 26), comps=range(2, 26),
                classes: int = 2) -> list[tuple[str, int, int, int]]:
    """(covariance, dims, components, parameters) for every setting under the
    parameter cap, counted before anything is fitted."""
    out = []
    for cov in COV_TYPES:
        for d in dims:
            for k in comps:
                n = n_parameters(cov, d, k, classes)
                if n <= max_params:
                    out.append((cov, d, k, n))
    return out


@dataclass
class Mixture:
    weights: np.ndarray   # (k,)
    means: np.ndarray     # (k, d)
    covs: np.ndarray      # (k, d, d)

    def log_density_terms(self, xs: list[Column]) -> list[Column]:
        """Per component: log w_j + log N(x | mu_j, Sigma_j) as column expressions."""
        d = len(xs)
        out = []
        for w, mu, cov in zip(self.weights, self.means, self.covs):
            prec = np.linalg.inv(cov)
            _, logdet = np.linalg.slogdet(cov)
            diffs = [xs[a] - float(mu[a]) for a in range(d)]
            quad = F.lit(0.0)
            for a in range(d):
                for b in range(d):
                    if prec[a, b] != 0.0:
                        quad = quad + diffs[a] * diffs[b] * float(prec[a, b])
            const = math.log(max(w, 1e-300)) - 0.5 * (d * math.log(2 * math.pi) + logdet)
            out.append(F.lit(const) - 0.5 * quad)
        return out


def log_sum_exp(terms: list[Column]) -> Column:
    top = F.greatest(*terms) if len(terms) > 1 else terms[0]
    return top + F.log(sum((F.exp(t - top) for t in terms), F.lit(0.0)))


def score_samples(df: DataFrame, mix: Mixture, vector: str) -> Column:
    """log density of each row under a fitted mixture (``score_samples``)."""
    d = mix.means.shape[1]
    xs = [F.get(F.col(vector), a).cast("double") for a in range(d)]
    return log_sum_exp(mix.log_density_terms(xs))


def _init(df: DataFrame, vector: str, key: str, k: int, d: int, seed: int) -> Mixture:
    """Means: the k rows first in a seeded hash order; covariances: the data's
    per-dimension variance; equal weights."""
    xs = [F.get(F.col(vector), a).cast("double") for a in range(d)]
    picks = df.orderBy(F.xxhash64(F.col(key), F.lit(seed))).limit(k).select(*xs).collect()
    means = np.array([[float(v) for v in r] for r in picks], dtype=float)
    var = df.agg(*[F.var_pop(x) for x in xs]).first()
    base = np.diag([max(float(v or 0.0), 1e-3) + REG_COVAR for v in var])
    return Mixture(np.full(k, 1.0 / k), means, np.stack([base] * k))


def _log_dens(x: np.ndarray, mix: Mixture) -> np.ndarray:
    """(n, k) log w_j + log N(x | mu_j, Sigma_j)."""
    d = x.shape[1]
    out = np.empty((x.shape[0], len(mix.weights)))
    for j, (w, mu, cov) in enumerate(zip(mix.weights, mix.means, mix.covs)):
        prec = np.linalg.inv(cov)
        _, logdet = np.linalg.slogdet(cov)
        diff = x - mu
        quad = np.einsum("na,ab,nb->n", diff, prec, diff)
        out[:, j] = math.log(max(w, 1e-300)) - 0.5 * (d * math.log(2 * math.pi) + logdet + quad)
    return out


def _partial_stats(params, dims: int):
    """mapInPandas body: per partition, for every model, the log-likelihood sum
    and responsibility-weighted counts, sums and second moments (one row per place)."""
    def run(batches):
        acc = None
        for pdf in batches:
            x = pdf[[f"_x{a}" for a in range(dims)]].to_numpy(dtype=float)
            g = pdf["_g"].to_numpy()
            chunks = []
            for gv, mix in params:
                md = mix.means.shape[1]
                xm = x[g == gv][:, :md]
                k = len(mix.weights)
                if len(xm) == 0:
                    chunks.append(np.zeros(1 + k + k * md + k * md * md))
                    continue
                ld = _log_dens(xm, mix)
                top = ld.max(axis=1, keepdims=True)
                lse = top[:, 0] + np.log(np.exp(ld - top).sum(axis=1))
                resp = np.exp(ld - lse[:, None])
                chunks.append(np.concatenate([[lse.sum()], resp.sum(axis=0),
                                              (resp.T @ xm).ravel(),
                                              np.einsum("nk,na,nb->kab", resp, xm, xm).ravel()]))
            vec = np.concatenate(chunks)
            acc = vec if acc is None else acc + vec
        if acc is not None:
            yield pd.DataFrame({"place": np.arange(len(acc)), "value": acc})
    return run


def summed_by_place(rows: DataFrame, run) -> np.ndarray | None:
    """The vectors that ``run`` gives per task, added up by place on the executors: what
    reaches the driver has the length of one vector, whatever the number of tasks."""
    sums = rows.mapInPandas(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    if not sums.num_rows:
        return None
    total = np.zeros(sums.num_rows)
    total[sums["place"].to_numpy()] = sums["value"].to_numpy()
    return total


def _m_step_arrays(chunk: np.ndarray, k: int, d: int, cov: str) -> Mixture:
    nk = np.maximum(chunk[1:1 + k], 1e-12)
    means = chunk[1 + k:1 + k + k * d].reshape(k, d) / nk[:, None]
    second = chunk[1 + k + k * d:].reshape(k, d, d) / nk[:, None, None]
    full = second - np.einsum("ja,jb->jab", means, means)
    eye = np.eye(d)
    if cov == "full":
        covs = full + REG_COVAR * eye
    elif cov == "diag":
        covs = np.stack([np.diag(np.diag(c)) for c in full]) + REG_COVAR * eye
    elif cov == "spherical":
        covs = np.stack([np.trace(c) / d * eye for c in full]) + REG_COVAR * eye
    else:  # tied: one pooled covariance
        pooled = np.einsum("j,jab->ab", nk, full) / nk.sum()
        covs = np.stack([pooled] * k) + REG_COVAR * eye
    return Mixture(nk / nk.sum(), means, covs)


def fit_em_many(df: DataFrame, vector: str, key: str, specs: dict, dims: int,
                group: str | None = None, max_iter: int = 30, tol: float = 1e-3,
                seed: int = 12345) -> dict:
    """Fit several mixtures at once: ``specs`` maps a name to (group value,
    components, covariance type[, model dims]); each model sees only the rows
    of its group and the first ``model dims`` (default ``dims``) coordinates of
    ``vector``, so models of different dimensionality share the same passes.

    Every EM round of every model is ONE pass over the rows: a mapInPandas
    E-step computes, per partition, the responsibility-weighted sufficient
    statistics of all models, an aggregate adds them up by place, and the driver
    runs the closed-form M-step. A whole parameter
    search costs ``max_iter`` scans, and only parameters and statistics
    (models x components x dims^2 numbers) cross the driver.
    Returns name -> (Mixture, mean log-likelihood history).
    """
    x = df.select(key, vector, *([group] if group else [])).cache()
    try:
        xs = [F.get(F.col(vector), a).cast("double") for a in range(dims)]
        # Initialisation for every group in two small jobs: the first k_max rows
        # of each group in a seeded hash order, and per-group counts/variances.
        gcol = F.col(group) if group else F.lit(0)
        specs = {n: (tuple(v) + (dims,))[:4] for n, v in specs.items()}
        k_max = max(v[1] for v in specs.values())
        order = Window.partitionBy(gcol).orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key))
        picks: dict = {}
        for row in x.select(gcol.alias("_g"), *[xs[a].alias(f"_x{a}") for a in range(dims)],
                            F.row_number().over(order).alias("_rn")) \
                    .where(F.col("_rn") <= k_max).orderBy("_g", "_rn").collect():
            picks.setdefault(row["_g"], []).append([float(row[f"_x{a}"]) for a in range(dims)])
        stats = {row["_g"]: row for row in x.groupBy(gcol.alias("_g")).agg(
            F.count(F.lit(1)).alias("_n"), *[F.var_pop(xs[a]).alias(f"_v{a}") for a in range(dims)]
        ).collect()}
        state = {}
        for name, (g, k, cov, md) in specs.items():
            if cov not in COV_TYPES or not 1 <= md <= dims:
                raise ValueError((cov, md))
            gk = g if group else 0
            st_row = stats.get(gk)
            if st_row is None or len(picks.get(gk, [])) < k:
                raise ValueError(f"group {g!r} has fewer than {k} rows")
            base_cov = np.diag([max(float(st_row[f"_v{a}"] or 0.0), 1e-3) + REG_COVAR
                                for a in range(md)])
            mix = Mixture(np.full(k, 1.0 / k), np.array(picks[gk][:k])[:, :md],
                          np.stack([base_cov] * k))
            state[name] = {"mix": mix, "hist": [], "done": False, "n": st_row["_n"],
                           "g": g, "k": k, "cov": cov, "d": md}
        names = list(state)
        rows = x.select((F.col(group) if group else F.lit(0)).alias("_g"),
                        *[xs[a].alias(f"_x{a}") for a in range(dims)])
        for _ in range(max_iter):
            active = [n for n in names if not state[n]["done"]]
            if not active:
                break
            params = [(state[n]["g"] if group else 0, state[n]["mix"]) for n in active]
            total = summed_by_place(rows, _partial_stats(params, dims))
            offset = 0
            for name, (_, mix) in zip(active, params):
                st = state[name]
                k, md = st["k"], st["d"]
                size = 1 + k + k * md + k * md * md
                chunk = total[offset:offset + size] if total is not None else np.zeros(size)
                offset += size
                st["hist"].append(chunk[0] / max(st["n"], 1))
                st["mix"] = _m_step_arrays(chunk, k, md, st["cov"])
                if len(st["hist"]) > 1 and abs(st["hist"][-1] - st["hist"][-2]) < tol:
                    st["done"] = True
        return {name: (st["mix"], st["hist"]) for name, st in state.items()}
    finally:
        x.unpersist()


def fit_em(df: DataFrame, vector: str, key: str, k: int, cov: str = "full", dims: int | None = None,
           max_iter: int = 30, tol: float = 1e-3, seed: int = 12345) -> tuple[Mixture, list[float]]:
    """EM for one k-component mixture with the given covariance type.

    Returns the mixture and the mean log-likelihood after each round (it does
    not decrease, up to the covariance regulariser)."""
    d = dims or len(df.select(vector).first()[0])
    out = fit_em_many(df, vector, key, {"m": (None, k, cov)}, d, None, max_iter, tol, seed)
    return out["m"]


def density_prediction(models: dict, vector: str) -> Column:
    """The class whose mixture gives the larger log density (ties: the smaller
    class label), as a column expression."""
    labels = sorted(models)
    first = next(iter(models.values()))
    d = first.means.shape[1]
    xs = [F.get(F.col(vector), a).cast("double") for a in range(d)]
    scores = [log_sum_exp(models[c].log_density_terms(xs)) for c in labels]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    pick = F.lit(None)
    for c, s in reversed(list(zip(labels, scores))):
        pick = F.when(s == best, F.lit(c)).otherwise(pick)
    return pick


def classify_by_density(test: DataFrame, models: dict, vector: str, out: str = "prediction") -> DataFrame:
    """L-14: the class whose mixture gives the larger log density (ties: the
    smaller class label)."""
    return test.withColumn(out, density_prediction(models, vector))


def mllib_full_mixture(df: DataFrame, vector: str, k: int, seed: int = 12345) -> Mixture:
    """Fit MLlib's GaussianMixture (full covariance) and return its parameters."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector

    model = GaussianMixture(k=k, seed=seed).fit(df.select(array_to_vector(vector).alias("features")))
    g = model.gaussians
    return Mixture(np.array(model.weights), np.array([m.mean.toArray() for m in g]),
                   np.array([m.cov.toArray() for m in g]))


def accuracy_many(test: DataFrame, vector: str, label: str, settings: list[dict]) -> list[float]:
    """Accuracy of many density classifiers (each a {class: Mixture} dict) on
    the same rows in one pass: each partition scores every setting with numpy
    and emits one row of correct counts; the driver adds them up."""
    dims = max(next(iter(m.values())).means.shape[1] for m in settings)
    xs = [F.get(F.col(vector), a).cast("double").alias(f"_x{a}") for a in range(dims)]

    def run(batches):
        acc = None
        for pdf in batches:
            x = pdf[[f"_x{a}" for a in range(dims)]].to_numpy(dtype=float)
            y = pdf["_y"].to_numpy()
            hits = []
            for models in settings:
                labels = sorted(models)
                md = models[labels[0]].means.shape[1]
                scores = []
                for c in labels:
                    ld = _log_dens(x[:, :md], models[c])
                    top = ld.max(axis=1, keepdims=True)
                    scores.append(top[:, 0] + np.log(np.exp(ld - top).sum(axis=1)))
                pred = np.asarray(labels)[np.argmax(np.vstack(scores), axis=0)]
                hits.append(float((pred == y).sum()))
            vec = np.array([float(len(y))] + hits)
            acc = vec if acc is None else acc + vec
        if acc is not None:
            yield pd.DataFrame({"place": np.arange(len(acc)), "value": acc})

    total = summed_by_place(test.select(F.col(label).alias("_y"), *xs), run)
    if total is None:
        return [0.0] * len(settings)
    return [h / total[0] if total[0] else 0.0 for h in total[1:]]
