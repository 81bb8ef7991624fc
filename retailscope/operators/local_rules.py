"""Local explanations by bins: which conditions on its features move an instance's score.

Training values are cut at their quartiles. Around an instance, rows are drawn bin by bin as often as training
rows fall into each; a weighted linear fit of the score on "in the instance's bin or not" gives every
condition its weight. The weighted normal equations are plain sums per instance, so perturbed rows never meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailscope.functions.ranks import exact_quantiles
from retailscope.operators.explain import Scorer
from retailscope.sources.shared import materialize

SAMPLES = 5000
SAMPLES_AT_ONCE = 500
SELECTION_PENALTY, FINAL_PENALTY = 0.01, 1.0
KERNEL = 0.75  # times the square root of the number of features


@dataclass
class Bins:
    """One feature's cut points, and of each bin the share of training rows, mean, deviation and range."""

    feature: str
    cuts: list[float]
    share: list[float]
    mean: list[float]
    deviation: list[float]
    low: list[float]
    high: list[float]

    def of(self, value: float) -> int:
        return int(np.searchsorted(self.cuts, value))

    def rule(self, place: int) -> str:
        """The condition that a bin stands for."""
        if not self.cuts:
            return self.feature
        if place == 0:
            return f"{self.feature} <= {self.cuts[0]:.2f}"
        if place == len(self.cuts):
            return f"{self.feature} > {self.cuts[-1]:.2f}"
        return f"{self.cuts[place - 1]:.2f} < {self.feature} <= {self.cuts[place]:.2f}"

    def draw(self, draws: np.random.Generator, places: np.ndarray) -> np.ndarray:
        """A value of each bin: normal with the bin's mean and deviation, cut off at its range."""
        normal, out = NormalDist(), np.empty(len(places))
        for place in np.unique(places):
            at = np.flatnonzero(places == place)
            mean, deviation, low, high = self.mean[place], self.deviation[place], self.low[place], self.high[place]
            if deviation <= 0 or high <= low:
                out[at] = mean
                continue
            first, last = (normal.cdf((edge - mean) / deviation) for edge in (low, high))
            chance = np.clip(first + draws.random(len(at)) * (last - first), 1e-12, 1 - 1e-12)
            out[at] = np.clip([mean + deviation * normal.inv_cdf(c) for c in chance.tolist()], low, high)
        return out


def training_bins(rows: DataFrame, features: Sequence[str]) -> list[Bins]:
    """Quartile bins of every feature, from two passes over all rows; four bins a feature reach the driver."""
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    values = rows.select(F.inline(F.array(*entries)))
    quartiles = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    cuts = materialize(exact_quantiles(values, F.col("value"), quartiles, ["feature"]), "quartiles")
    place = sum(((F.col("value") > F.col(q)).cast("int") for q in quartiles), F.lit(0))
    stats = values.join(F.broadcast(cuts), "feature").groupBy("feature", place.alias("place")).agg(  # one row a feature
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"),
        F.min("value").alias("low"), F.max("value").alias("high"), *[F.max(q).alias(q) for q in quartiles])
    found = stats.toPandas()
    out = []
    for feature in features:
        own = found[found["feature"] == feature].sort_values("place")
        edges = sorted(set(own[list(quartiles)].iloc[0].tolist()))
        own = own.assign(place=np.searchsorted(edges, own["low"]))  # equal quartiles leave fewer bins
        table = own.set_index("place").reindex(range(len(edges) + 1))
        table[["n", "deviation"]] = table[["n", "deviation"]].fillna(0.0)
        out.append(Bins(feature, edges, (table["n"] / table["n"].sum()).tolist(), *(table[c].tolist() for c in ("mean", "deviation", "low", "high"))))
    return out


def perturbed(bins: Sequence[Bins], instance: Sequence[float], seed: Sequence[int], size: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """(rows, whether each value is in the instance's bin); the very first row is the instance itself."""
    draws = np.random.default_rng(list(seed))
    rows, same = np.empty((size, len(bins))), np.empty((size, len(bins)), dtype=bool)
    for column, (own, value) in enumerate(zip(bins, instance)):
        places = draws.choice(len(own.share), size=size, p=own.share)
        rows[:, column], same[:, column] = own.draw(draws, places), places == own.of(value)
    if first:
        rows[0], same[0] = instance, True
    return rows, same


def proximity(same: np.ndarray) -> np.ndarray:
    """Weights that fall with the number of conditions a row breaks."""
    broken = (~same).sum(axis=1)
    return np.sqrt(np.exp(-broken / (KERNEL**2 * same.shape[1])))


def solved(normal: np.ndarray, moment: np.ndarray, used: Sequence[int], penalty: float) -> np.ndarray:
    """(intercept, weights) of a ridge fit on some columns of the weighted normal equations."""
    at = np.array([0, *(u + 1 for u in used)])
    ridge = penalty * np.eye(len(at))
    ridge[0, 0] = 0.0
    return np.linalg.solve(normal[np.ix_(at, at)] + ridge, moment[at])


def strongest_rules(normal: np.ndarray, moment: np.ndarray, top_n: int) -> list[tuple[int, float]]:
    """(feature, weight) by size: the ``top_n`` features of a nearly unpenalised fit, fitted again alone."""
    features = len(moment) - 1
    first = solved(normal, moment, range(features), SELECTION_PENALTY)[1:]
    used = sorted(np.argsort(-np.abs(first), kind="stable")[:top_n].tolist())
    weights = solved(normal, moment, used, FINAL_PENALTY)[1:]
    return sorted(zip(used, weights.tolist()), key=lambda pair: (-abs(pair[1]), pair[0]))


def local_rules(
    instances: DataFrame, scorer: Scorer, training: DataFrame, features: Sequence[str],
    samples: int = SAMPLES, top_n: int = 10, seed: int = 42, row_id: str = "customer_id",
) -> DataFrame:
    """(row_id, rank, feature, rule, weight): the conditions that move each instance's score most.

    ``training`` gives the bins. Draws are fixed by seed and row id, whatever the partitioning.
    """
    bins, names, width = training_bins(training, features), list(features), len(features)
    starts = range(0, samples, SAMPLES_AT_ONCE)

    def perturb(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own in batch.itertuples(index=False):
                size = min(SAMPLES_AT_ONCE, samples - own.start)
                rows, same = perturbed(bins, own.vector, (seed, abs(own.row), own.start), size, own.start == 0)
                out = pd.DataFrame(rows, columns=names)
                out["row"], out["same"], out["near"] = own.row, list(same), proximity(same)
                yield out

    asked = instances.select(
        F.col(row_id).cast("bigint").alias("row"), F.array(*[F.col(f).cast("double") for f in features]).alias("vector"),
        F.explode(F.array(*[F.lit(s) for s in starts])).alias("start"))
    drawn = asked.mapInPandas(perturb, ", ".join(f"{f} double" for f in features) + ", row bigint, same array<boolean>, near double")
    scored = scorer(drawn)
    columns = [F.lit(1.0)] + [F.col("same")[i].cast("double") for i in range(width)]
    upper = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    sums = scored.groupBy("row").agg(
        F.array(*[F.sum(F.col("near") * columns[i] * columns[j]) for i, j in upper]).alias("normal"),
        F.array(*[F.sum(F.col("near") * c * F.col("probability")) for c in columns]).alias("moment"),
    )
    given = instances.select(F.col(row_id).cast("bigint").alias("row"), F.array(*[F.col(f).cast("double") for f in features]).alias("vector"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for own in batch.itertuples(index=False):
                normal = np.zeros((width + 1, width + 1))
                for (i, j), total in zip(upper, own.normal):
                    normal[i, j] = normal[j, i] = total
                found = strongest_rules(normal, np.asarray(own.moment, dtype=float), top_n)
                out += [(own.row, r, names[f], bins[f].rule(bins[f].of(own.vector[f])), w) for r, (f, w) in enumerate(found, 1)]
            yield pd.DataFrame(out, columns=[row_id, "rank", "feature", "rule", "weight"])

    return sums.join(given, "row").mapInPandas(solve, f"{row_id} bigint, rank int, feature string, rule string, weight double")
