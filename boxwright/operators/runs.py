"""Run logs: best generation, curves up to the best row, trimmed frame logs, smoothing, evolution of hyper-parameters."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_row(runs: DataFrame, value: str = "fit", order: str = "epoch") -> DataFrame:
    """run_id, order column, value of the first row that reaches the run's maximum."""
    best = F.max_by(F.struct(order, value), F.struct(value, -F.col(order)))
    return runs.groupBy("run_id").agg(best.alias("b")).select("run_id", f"b.{order}", f"b.{value}")


def until_best(runs: DataFrame, value: str = "fit", order: str = "epoch") -> DataFrame:
    """Rows of each run up to its best one."""
    w = Window.partitionBy("run_id")
    top = F.max_by(F.col(order), F.struct(F.col(value), -F.col(order))).over(w)
    return runs.withColumn("__top", top).where(F.col(order) <= F.col("__top")).drop("__top")


def trimmed(runs: DataFrame, head: int, tail: int, time: str, order: str = "epoch") -> DataFrame:
    """Rows but the first and last ones of each run, with elapsed since the first that is left."""
    w = Window.partitionBy("run_id")
    rows = runs.withColumns({"__k": F.row_number().over(w.orderBy(order)), "__n": F.count("*").over(w)}).where((F.col("__k") > head) & (F.col("__k") <= F.col("__n") - tail))
    return rows.withColumn("elapsed", F.col(time) - F.min(time).over(w)).drop("__k", "__n")


def gaussian(runs: DataFrame, value: str, sigma: float = 3.0, truncate: float = 4.0, order: str = "epoch") -> DataFrame:
    """run_id, order column, smooth: a normalised Gaussian kernel; the ends are mirrored with the edge value repeated."""
    radius = int(truncate * sigma + 0.5)
    kernel = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    rows = runs.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct(order, F.col(value).cast("double").alias("v")))).alias("xs"))

    def smooth(x, i):
        n, out = F.size("xs"), F.lit(0.0)
        for k, g in enumerate(kernel):
            at = F.pmod(i + (k - radius), 2 * n)
            out = out + F.get(F.col("xs"), F.when(at < n, at).otherwise(2 * n - 1 - at))["v"] * (g / sum(kernel))
        return F.struct(x[order].alias(order), out.alias("smooth"))

    return rows.select("run_id", F.explode(F.transform("xs", smooth)).alias("s")).select("run_id", f"s.{order}", "s.smooth")


def next_population(log: DataFrame, fit: str, bounds: dict[str, tuple[float, float]], size: int = 20, elite: int = 2, contest: int = 3, rate: float = 0.3, spread: float = 0.1, seed: int = 0) -> list[dict[str, float]]:
    """Hyper-parameters to try next, from a log of those tried with their fitness.

    ``bounds``: name to (low, high). The ``elite`` fittest rows stay as they are. Every other one has two parents, each the
    fittest of ``contest`` rows drawn at random; it takes the values before a random cut from one and the rest from the
    other, and each value then moves, with the chance ``rate``, by a normal step of ``spread`` of its range, reflected at
    the bounds. Only the ``size`` fittest rows reach the driver; ties go to the values in order.
    """
    import random

    names = list(bounds)
    top = log.select(fit, *names).orderBy(F.desc(fit), *names).limit(size).collect()
    if not top:
        raise ValueError("the log has no rows")
    draw = random.Random(seed)
    out = [{n: float(r[n]) for n in names} for r in top[:elite]]
    while len(out) < size:
        father, mother = (top[min(draw.randrange(len(top)) for _ in range(contest))] for _ in range(2))
        cut = draw.randrange(1, len(names)) if len(names) > 1 else 1
        child = {}
        for k, n in enumerate(names):
            low, high = bounds[n]
            v = float((father if k < cut else mother)[n])
            if draw.random() < rate and high > low:
                v = low + abs((v - low + draw.gauss(0.0, spread * (high - low))) % (2 * (high - low)))
                v = v if v <= high else 2 * high - v
            child[n] = min(high, max(low, v))
        out.append(child)
    return out


def best_settings(log: DataFrame, fit: str, names: list[str]) -> str:
    """YAML text of the fittest row: its generation and fitness as a note, then a line a value."""
    r = log.orderBy(F.desc(fit), *names).select(fit, *names).first()
    if r is None:
        raise ValueError("the log has no rows")
    return "\n".join([f"# fitness: {r[fit]:.5g}", *(f"{n}: {r[n]:.5g}" for n in names), ""])


def butterworth(order: int, cutoff: float):
    """Coefficients (b, a) of a low-pass filter; the cutoff is a share of half the sampling rate. Gain 1 at rest."""
    import numpy as np

    if not 0 < cutoff < 1:
        raise ValueError("the cutoff lies between 0 and 1")
    turn = np.exp(1j * math.pi * (2 * np.arange(1, order + 1) + order - 1) / (2 * order))
    poles = 4 * math.tan(math.pi * cutoff / 2) * turn  # of the analogue filter, warped for the bilinear map
    a = np.poly((4 + poles) / (4 - poles)).real
    b = np.poly(-np.ones(order))
    return b * a.sum() / b.sum(), a


def zero_phase(runs: DataFrame, value: str, cutoff: float, order: int = 5, by: str = "epoch") -> DataFrame:
    """run_id, order column, smooth: a low-pass filter run forwards and backwards, so nothing is delayed.

    Ends are extended by their point mirror and the filter starts at rest there. The recursion is sequential in a run, so
    a run is one group in Python; many runs are spread. A null value counts as the one before it (the first ones: 0).
    """
    import numpy as np
    import pandas as pd

    b, a = butterworth(order, cutoff)
    companion = np.eye(order) - np.vstack([np.hstack([-a[1:, None], np.eye(order)[:, : order - 1]])])
    rest = np.linalg.solve(companion, b[1:] - a[1:] * b[0])  # state that a constant input of 1 keeps

    def passed(x):
        state, out = rest * x[0], np.empty(len(x))
        for i, v in enumerate(x):
            y = b[0] * v + state[0]
            state = np.append(state[1:], 0.0) + b[1:] * v - a[1:] * y
            out[i] = y
        return out

    def smooth(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(by)
        x = rows[value].astype(float).ffill().fillna(0.0).to_numpy()
        pad = min(3 * (order + 1), len(x) - 1)
        wide = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]]) if pad else x
        y = passed(passed(wide)[::-1])[::-1]
        return pd.DataFrame({"run_id": rows["run_id"], by: rows[by], "smooth": y[pad : pad + len(x)]})

    kinds = {f.name: f.dataType.simpleString() for f in runs.schema}
    return runs.select("run_id", by, value).groupBy("run_id").applyInPandas(smooth, f"run_id {kinds['run_id']}, {by} {kinds[by]}, smooth double")
