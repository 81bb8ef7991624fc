"""Explanations of scores: additive attributions, importance, partial dependence, local surrogates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.functions.ranks import exact_quantiles
from retailscope.operators.prep import one_row
from retailscope.sources.shared import materialize

# How a feature is named in a sentence.
READABLE_NAMES = {
    "recency_days": "days since their last purchase",
    "frequency": "how often they order",
    "monetary_total": "their total spend",
    "return_rate": "how often they return items",
    "engagement_score": "their overall engagement score",
    "discount_sensitivity": "how much they rely on discounts",
    "seasonal_concentration": "how seasonal their buying pattern is",
    "purchase_trend_slope": "whether their ordering is speeding up or slowing down",
}

ROWS_SCORED = 500_000  # rows that one task makes of its input and scores

Scorer = Callable[[DataFrame], DataFrame]
"""Adds a ``probability`` column to a table of feature columns."""


def long_attributions(rows: DataFrame, terms: Mapping[str, Column]) -> DataFrame:
    """Attributions as (customer_id, feature, attribution) rows."""
    entries = [F.struct(F.lit(c).alias("feature"), t.alias("attribution")) for c, t in terms.items()]
    return rows.select("customer_id", F.inline(F.array(*entries)))


def global_importance(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first; one row per feature."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))
        .orderBy(F.desc("mean_abs_attribution"), "feature")
    )


def representatives(scores: DataFrame, probability: str = "churn_probability") -> DataFrame:
    """The lowest, highest and most borderline score; ties go to the smaller customer id."""
    p, who = F.col(probability), F.col("customer_id")
    kinds = {"low_risk": p, "high_risk": -p, "borderline": F.abs(p - 0.5)}
    picked = scores.agg(
        *[F.min(F.struct(key.alias("key"), who, p.alias("probability"))).alias(kind) for kind, key in kinds.items()]
    )
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(f"{kind}.customer_id").alias("customer_id"),
            F.col(f"{kind}.probability").alias("probability"),
        )
        for kind in kinds
    ]
    return picked.select(F.inline(F.array(*entries)))


def readable(feature: str) -> str:
    return READABLE_NAMES.get(feature, feature.replace("_", " "))


def plain_number(value: Column) -> Column:
    """Two decimals, rounded half up through an exact decimal."""
    return value.cast("decimal(24,6)").cast("decimal(22,2)").cast("string")


def plain_language(terms: Mapping[str, Column], values: Mapping[str, Column], top_n: int = 3) -> Column:
    """One sentence naming the ``top_n`` strongest drivers of a row's score."""
    drivers = F.sort_array(
        F.array(
            *[
                F.struct(
                    (-F.abs(term)).alias("weakness"),
                    F.lit(c).alias("feature"),
                    F.concat(
                        F.lit(readable(c) + " ("), F.coalesce(plain_number(values[c]), F.lit("N/A")), F.lit(") "),
                        F.when(term > 0, "increases").otherwise("decreases"), F.lit(" churn risk"),
                    ).alias("clause"),
                )
                for c, term in terms.items()
            ]
        )
    )
    clauses = F.transform(F.slice(drivers, 1, top_n), lambda d: d.getField("clause"))
    return F.concat(
        F.lit("This customer's churn risk is driven mainly by: "), F.array_join(clauses, "; "), F.lit(".")
    )


def partial_dependence(
    rows: DataFrame, scorer: Scorer, features: Sequence[str], grid_points: int = 100, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """Average score with a feature set to each of ``grid_points`` evenly spaced values, for every feature.

    A feature's grid spans its ``low`` to ``high`` quantile; those of all features come from one pass. Every
    row is scored once for each point of every grid inside its task and averaged map-side, in one plan, so
    only a partial sum per point and task is shuffled. Rows are dealt by what they become, not by their bytes.
    """
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    edges = exact_quantiles(rows.select(F.inline(F.array(*entries))), F.col("value"), {"low": low, "high": high}, ["feature"])
    step = (F.col("high") - F.col("low")) / F.lit(float(grid_points - 1))
    points = materialize(edges, "grid-edges").withColumn("grid_point", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
    points = points.select("feature", "grid_point", (F.col("low") + F.col("grid_point") * step).alias("grid_value"))
    # the value of the feature that moves, null for the others: short code, which the JVM compiles
    values = [F.when(F.col("feature") == f, F.col("grid_value")).alias(f"set_{i}") for i, f in enumerate(features)]
    points = points.select("feature", "grid_point", "grid_value", *values)
    grid = points.agg(F.array_agg(F.struct(*points.columns))).scalar()  # fixed by the parameters
    asked = rows.select(*[F.col(f).cast("double").alias(f"own_{i}") for i, f in enumerate(features)])
    parts = max(1, -(-asked.count() * len(features) * grid_points // ROWS_SCORED))
    moved = asked.repartition(parts).select("*", F.inline(grid)).select(
        "feature", "grid_point", "grid_value", *[F.coalesce(f"set_{i}", f"own_{i}").alias(f) for i, f in enumerate(features)]
    )
    return (
        scorer(moved)
        .groupBy("feature", "grid_point")
        .agg(F.max("grid_value").alias("grid_value"), F.avg("probability").alias("average_prediction"))
    )


def background_sample(rows: DataFrame, features: Sequence[str], size: int = 100) -> list[tuple[float, ...]]:
    """At most ``size`` background rows, picked by hash of the customer: small enough for the driver."""
    picked = rows.orderBy(F.xxhash64("customer_id"), "customer_id").limit(size)
    return [tuple(float(v) for v in r) for r in picked.select(*features).collect()]


def sampled_attributions(
    rows: DataFrame,
    scorer: Scorer,
    features: Sequence[str],
    background: Sequence[Sequence[float]],
    permutations: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Shapley attributions of any scorer by permutation sampling.

    A walk starts at a background row and switches one feature after another to the customer's value;
    each switch's change in score is credited to its feature. Every walk position is one row to score,
    contributing its score to the feature just switched and, negatively, to the one switched next, so the
    result is a plain sum per customer and feature. Walks are fixed by ``seed`` and shared by all rows;
    they start from the background rows in turn, from each once unless ``permutations`` says otherwise.

    A customer makes a thousand and more rows to score, so customers are dealt by what they become and not by
    their own bytes; all rows of a customer stay in its task, and only finished sums leave it.
    """
    generator = np.random.default_rng(seed)
    permutations = len(background) if permutations is None else permutations
    walks = []
    for w in range(permutations):
        order = [int(i) for i in generator.permutation(len(features))]
        start = [float(v) for v in background[w % len(background)]]
        walks.append((order, start))
    # the start's value of a feature, null once the feature is switched: short code, which the JVM compiles
    starts = [f"start_{i}" for i in range(len(features))]
    schema = "credited int, debited int, " + ", ".join(f"{s} double" for s in starts)
    steps = []
    for order, start in walks:
        for step in range(len(features) + 1):
            taken = set(order[:step])
            steps.append((
                order[step - 1] if step else None,
                order[step] if step < len(features) else None,
                *[None if i in taken else v for i, v in enumerate(start)],
            ))
    plan = rows.sparkSession.createDataFrame(steps, schema)
    plan_array = plan.agg(F.array_agg(F.struct(*plan.columns)).alias("steps")).scalar()
    asked = rows.select("customer_id", *[F.col(f).cast("double").alias(f) for f in features])
    parts = max(1, -(-asked.count() * len(steps) // ROWS_SCORED))
    spread = asked.repartition(parts, "customer_id").select("*", F.inline(plan_array))
    mixed = spread.select(
        "customer_id", "credited", "debited", *[F.coalesce(s, f).alias(f) for s, f in zip(starts, features)]
    )
    share = F.col("probability") / permutations
    changes = F.array(
        F.struct(F.col("credited").alias("feature"), share.alias("change")),
        F.struct(F.col("debited").alias("feature"), (-share).alias("change")),
    )
    names = F.array(*[F.lit(f) for f in features])
    return (
        scorer(mixed)
        .select("customer_id", F.inline(changes))
        .where(F.col("feature").isNotNull())
        .groupBy("customer_id", "feature")
        .agg(F.sum("change").alias("attribution"))
        .select("customer_id", names[F.col("feature")].alias("feature"), "attribution")
    )


def hashed_normal(seed: int, *parts: Column) -> Column:
    """A standard normal draw fixed by its inputs, whatever the partitioning."""

    def uniform(stream: int) -> Column:
        digits = F.pmod(F.xxhash64(*parts, F.lit(seed), F.lit(stream)), F.lit(2**52))
        return (digits.cast("double") + 0.5) / float(2**52)

    return F.sqrt(-2 * F.log(uniform(0))) * F.cos(2 * np.pi * uniform(1))


def local_surrogate(
    instances: DataFrame,
    scorer: Scorer,
    scaler: DataFrame,
    features: Sequence[str],
    samples: int = 5000,
    top_n: int = 10,
    seed: int = 42,
    ridge: float = 1.0,
) -> DataFrame:
    """A weighted linear fit of the scorer around each instance; its ``top_n`` strongest features.

    Each instance is perturbed ``samples`` times in standard units and scored; proximity weights fall off
    with distance at the kernel width 0.75·√d. The weighted normal equations are plain sums per instance,
    so perturbations never meet in one task; only the finished (d+1)×(d+1) systems reach the solver.
    """
    width = 0.75 * float(np.sqrt(len(features)))
    noise = {f"{f}_noise": hashed_normal(seed, F.col("customer_id"), F.col("sample"), F.lit(f)) for f in features}
    spread = (
        instances.select("customer_id", *[F.col(f).cast("double").alias(f) for f in features])
        .withColumn("scaler", one_row(scaler))
        .withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
        .withColumns({n: F.when(F.col("sample") == 0, 0.0).otherwise(z) for n, z in noise.items()})
    )
    moved = spread.withColumns(
        {f: F.col(f) + F.col(f"{f}_noise") * F.col(f"scaler.{f}_std") for f in features}
    ).drop("scaler")
    scored = scorer(moved)
    squares = sum((F.col(f"{f}_noise") * F.col(f"{f}_noise") for f in features), F.lit(0.0))
    weighted = scored.withColumn("weight", F.exp(-squares / (2 * width * width)))
    columns = [F.lit(1.0)] + [F.col(f"{f}_noise") for f in features]
    size = len(columns)
    upper = [(i, j) for i in range(size) for j in range(i, size)]  # the normal matrix is symmetric
    sums = weighted.groupBy("customer_id").agg(
        F.array(*[F.sum(F.col("weight") * columns[i] * columns[j]) for i, j in upper]).alias("normal"),
        F.array(*[F.sum(F.col("weight") * columns[i] * F.col("probability")) for i in range(size)]).alias("moment"),
    )
    names = list(features)

    def solve(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                normal = np.zeros((size, size))
                for (i, j), total in zip(upper, row.normal):
                    normal[i, j] = normal[j, i] = total
                penalty = ridge * np.eye(size)
                penalty[0, 0] = 0.0
                weights = np.linalg.solve(normal + penalty, np.asarray(row.moment, dtype=float))[1:]
                strongest = np.argsort(-np.abs(weights), kind="stable")[:top_n]
                out += [(row.customer_id, r + 1, names[i], float(weights[i])) for r, i in enumerate(strongest)]
            yield pd.DataFrame(out, columns=["customer_id", "rank", "feature", "weight"])

    return sums.mapInPandas(solve, "customer_id bigint, rank int, feature string, weight double")
