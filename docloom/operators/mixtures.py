"""Gaussian mixtures of full covariance, fitted for many numbers of components at once: one pass over the rows is one step of all.

Starts come from k-means on a bounded sample; every step and the choice between the models use all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Mixture(NamedTuple):
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray


def log_densities(x: np.ndarray, m: Mixture) -> np.ndarray:
    """(rows, components): log of weight times density."""
    out = np.empty((len(x), len(m.weights)))
    for j, (w, mean, cov) in enumerate(zip(*m, strict=True)):
        root = np.linalg.cholesky(cov)
        y = np.linalg.solve(root, (x - mean).T)
        out[:, j] = np.log(w) - np.log(np.diag(root)).sum() - 0.5 * (len(mean) * np.log(2 * np.pi) + (y**2).sum(axis=0))
    return out


def shares(x: np.ndarray, m: Mixture) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each component, and the log-likelihood, of each row."""
    logs = log_densities(x, m)
    top = logs.max(axis=1, keepdims=True)
    p = np.exp(logs - top)
    total = p.sum(axis=1, keepdims=True)
    return p / total, (top + np.log(total))[:, 0]


def sums(x: np.ndarray, m: Mixture, p: np.ndarray) -> np.ndarray:
    """By component: weight, first and second moment around its mean, in one row of numbers."""
    out = []
    for j, mean in enumerate(m.means):
        off = x - mean
        out.append(np.concatenate([[p[:, j].sum()], p[:, j] @ off, ((off * p[:, j : j + 1]).T @ off).ravel()]))
    return np.array(out)


def step(m: Mixture, s: np.ndarray, ridge: float) -> Mixture:
    d = m.means.shape[1]
    n = s[:, 0] + 10 * np.finfo(float).eps
    move = s[:, 1 : d + 1] / n[:, None]
    cov = s[:, d + 1 :].reshape(-1, d, d) / n[:, None, None] - move[:, :, None] * move[:, None, :] + ridge * np.eye(d)
    return Mixture(n / n.sum(), m.means + move, cov)


def start(x: np.ndarray, k: int, seed: int, ridge: float) -> Mixture:
    """k-means: seeds far from each other (the best of a few tries each), then Lloyd's steps."""
    rng = np.random.default_rng(seed)
    far = lambda c: ((x - c) ** 2).sum(axis=1)
    centres = [x[rng.integers(len(x))]]
    near = far(centres[0])
    for _ in range(k - 1):
        p = near / near.sum() if near.sum() > 0 else None
        picked = rng.choice(len(x), 2 + int(np.log(k)), p=p)
        tries = [np.minimum(near, far(x[i])) for i in picked]
        best = int(np.argmin([t.sum() for t in tries]))
        centres.append(x[picked[best]])
        near = tries[best]
    c, own = np.array(centres), None
    for _ in range(100):
        new = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        if own is not None and (new == own).all():
            break
        own = new
        c = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(k)])
    m = Mixture(np.full(k, 1 / k), c, np.array([np.eye(x.shape[1])] * k))
    return step(m, sums(x, m, np.eye(k)[own]), ridge)


def fitted(rows: DataFrame, vector: str, n: int, ks: list[int], seed: int, steps: int = 100, least_gain: float = 1e-3, ridge: float = 1e-6, sample: int = 10_000) -> Mixture:
    """The mixture with the lowest BIC among ks. rows are read once a step: keep them cached."""
    first = rows.orderBy(F.xxhash64(*rows.columns)).select(vector).limit(sample).collect()
    x = np.array([r[0] for r in first], dtype=float)
    d = x.shape[1]
    open_ = {k: start(x, k, seed, ridge) for k in ks}
    before, best = dict.fromkeys(ks, -np.inf), (np.inf, None)

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b) for b in group["sums"]], axis=0)
        return pd.DataFrame({"k": group["k"].iloc[:1].to_numpy(), "sums": [total.tobytes()]})

    for done in range(1, steps + 1):
        models = dict(open_)

        def part(batches: Iterator[pd.DataFrame], models: dict[int, Mixture] = models) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                if len(batch):
                    v = np.stack(batch[vector].to_numpy()).astype(float)
                    for k, m in models.items():
                        p, logs = shares(v, m)
                        total[k] = total.get(k, 0) + np.append(sums(v, m, p).ravel(), logs.sum())
            yield pd.DataFrame({"k": list(total), "sums": [s.tobytes() for s in total.values()]}).astype({"k": "int32"})

        for r in rows.select(vector).mapInPandas(part, "k int, sums binary").groupBy("k").applyInPandas(added, "k int, sums binary").collect():
            s, k = np.frombuffer(r["sums"]), r["k"]
            if s[-1] / n - before[k] < least_gain or done == steps:
                free = k - 1 + k * d + k * d * (d + 1) / 2
                best = min(best, (free * np.log(n) - 2 * s[-1], open_.pop(k)), key=lambda b: b[0])
            else:
                before[k] = s[-1] / n
                open_[k] = step(open_[k], s[:-1].reshape(k, -1), ridge)
        if not open_:
            break
    return best[1]
