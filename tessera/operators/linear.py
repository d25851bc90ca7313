"""One-vs-rest logistic regression with a penalised intercept, for many strengths at once (L-02).

Per class and strength C the objective is

    l2:  1/2 |w|^2 + C sum log(1 + exp(-y w.x))        l1:  |w|_1 + C sum log(1 + exp(-y w.x))

with y = 1 for the class and -1 for the rest, and a constant 1 appended to x whose
weight is penalised like the others. A pass over the rows gives the loss, gradient and
curvature matrix of every problem of the sweep, added up by place on the executors. The
driver takes a Newton step (for l1 the best step of the quadratic model plus the penalty,
by coordinate descent), halved while it does not lower the objective. What reaches the
driver depends on the problems and the square of the vector length alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.mixture import summed_by_place
from tessera.session import cut_lineage


@dataclass
class _Problem:
    penalty: str
    c: float
    label: object
    w: np.ndarray
    step: np.ndarray | None = None
    size: float = 1.0
    objective: float = np.inf
    gradient: np.ndarray | None = None
    done: bool = False
    history: list = field(default_factory=list)

    def at(self) -> np.ndarray:
        """The weights that the next pass looks at."""
        return self.w if self.step is None else self.w + self.size * self.step

    def penalised(self, w: np.ndarray, loss: float) -> float:
        return loss + (0.5 * float(w @ w) if self.penalty == "l2" else float(np.abs(w).sum()))

    def take(self, loss: float, gradient: np.ndarray, curvature: np.ndarray, tol: float) -> None:
        """Accept the weights looked at, or halve the step."""
        w = self.at()
        objective = self.penalised(w, loss)
        if objective > self.objective * (1 + 1e-14):
            self.size /= 2
            self.done = self.size < 1e-9
            return
        gain, self.objective = self.objective - objective, objective
        self.history.append(objective)
        self.w, self.gradient, self.size = w, gradient, 1.0
        self.step = _newton(w, gradient, curvature) if self.penalty == "l2" else _l1_step(w, gradient, curvature)
        self.done = gain <= tol * max(abs(objective), 1.0) or not self.step.any()


def _newton(w: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.linalg.solve(h + np.eye(len(w)), -(g + w))


def _l1_step(w: np.ndarray, g: np.ndarray, h: np.ndarray, cycles: int = 1000) -> np.ndarray:
    """argmin over d of g.d + d.h.d / 2 + |w + d|_1, a coordinate at a time."""
    d, hd = np.zeros_like(w), np.zeros_like(w)
    diagonal = np.maximum(np.diag(h), 1e-12)
    for _ in range(cycles):
        moved = 0.0
        for j in range(len(w)):
            centre = w[j] + d[j] - (g[j] + hd[j]) / diagonal[j]
            new = np.sign(centre) * max(abs(centre) - 1 / diagonal[j], 0.0) - w[j]
            change = new - d[j]
            if change:
                d[j] = new
                hd += change * h[:, j]
                moved = max(moved, abs(change))
        if moved <= 1e-10 * (1 + np.abs(w + d).max()):
            break
    return d


def _pass(rows: DataFrame, problems: list[_Problem], dims: int) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Loss, gradient and curvature of each problem at the weights it looks at."""
    weights = np.stack([p.at() for p in problems])
    kinds = [(p.c, p.label) for p in problems]
    size = 1 + dims + dims * dims

    def run(batches):
        total = np.zeros((len(kinds), size))
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.column_stack([np.stack(pdf["x"].to_numpy()).astype(float), np.ones(len(pdf))])
            labels = pdf["y"].to_numpy()
            z = x @ weights.T
            for k, (c, label) in enumerate(kinds):
                y = labels == label
                p = 1 / (1 + np.exp(-np.clip(z[:, k], -500, 500)))
                total[k, 0] += c * np.logaddexp(0, np.where(y, -z[:, k], z[:, k])).sum()
                total[k, 1:1 + dims] += c * (x.T @ (p - y))
                total[k, 1 + dims:] += c * (x.T @ (x * (p * (1 - p))[:, None])).ravel()
        yield pd.DataFrame({"place": np.arange(total.size), "value": total.ravel()})

    total = summed_by_place(rows, run).reshape(len(kinds), size)
    return [(float(t[0]), t[1:1 + dims], t[1 + dims:].reshape(dims, dims)) for t in total]


def one_vs_rest(df: DataFrame, vector: str, label: str, cs: Sequence[float], penalties: Sequence[str] = ("l2", "l1"),
                max_rounds: int = 100, tol: float = 1e-12) -> list[_Problem]:
    """The fitted problems, one per penalty, strength and label. Rows with a null vector
    or label are left out; vectors have one length."""
    rows = cut_lineage(df.where(F.col(vector).isNotNull() & F.col(label).isNotNull()).select(
        F.col(vector).cast("array<double>").alias("x"), F.col(label).alias("y")))
    labels = sorted(r["y"] for r in rows.select("y").distinct().collect())
    if not labels:
        return []
    dims = rows.select(F.max(F.size("x"))).first()[0] + 1
    problems = [_Problem(p, float(c), y, np.zeros(dims)) for p in penalties for c in cs for y in labels]
    for _ in range(max_rounds):
        active = [p for p in problems if not p.done]
        if not active:
            break
        for problem, found in zip(active, _pass(rows, active, dims)):
            problem.take(*found, tol)
    return problems


def residual(problem: _Problem) -> float:
    """How far the weights are from optimal: the largest violation of the conditions for a
    minimum, relative to the strength of the loss's pull at zero weights."""
    w, g = problem.w, problem.gradient
    if problem.penalty == "l2":
        return float(np.abs(w + g).max() / (1 + np.abs(w).max()))
    off = np.where(w != 0, np.abs(g + np.sign(w)), np.maximum(np.abs(g) - 1, 0.0))
    return float(off.max())
