"""Thinning of edges: keyed sampling, histogram matching, and the three-stage reduction per pathway."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.functions.bins import value_bins
from edgeworks.functions.random import keyed_uniform

# fixed values: keys of the random numbers
REDUCE, CUT, ACTIVE, SPINE, TOUCH = 0x100, 0x101, 0x102, 0x200, 0x202
#: Reduction factor where the mean and sd alone are given.
DEFAULT_REDUCTION = 0.04
SOLVER_STEPS = 60


def keyed_sample(df: DataFrame, rate: float, seed: int, key: int = TOUCH, row_id: str = "synapse_id") -> DataFrame:
    """Rows whose keyed number is at most rate."""
    return df.where(keyed_uniform(seed, key, row_id) <= rate)


def histogram_survival(df: DataFrame, column: str, edges: list[float], cumulative: list[float]) -> DataFrame:
    """(bin, survival): how much of each bin to keep so that what is kept has the wanted shares."""
    have = df.groupBy(value_bins(F.col(column), edges).alias("bin")).agg(F.count("*").alias("have"))
    wanted = [(i, b - a) for i, (a, b) in enumerate(zip(cumulative[:-1], cumulative[1:], strict=True))]
    want = df.sparkSession.createDataFrame(wanted, "bin int, want double")
    ratio = have.join(want, "bin").withColumn("ratio", F.try_divide(F.col("want"), F.col("have")))
    top = ratio.agg(F.max("ratio").alias("top"))
    # one row on the right
    return ratio.crossJoin(top).select("bin", F.coalesce(F.try_divide("ratio", "top"), F.lit(0.0)).alias("survival"))


def match_histogram(df: DataFrame, column: str, edges: list[float], cumulative: list[float], seed: int, key: int = SPINE, row_id: str = "synapse_id") -> DataFrame:
    """Keyed sample of df whose column follows the cumulative shares; values outside all bins go."""
    survival = histogram_survival(df, column, edges, cumulative)
    binned = df.withColumn("bin", value_bins(F.col(column), edges)).join(survival, "bin")
    return binned.where(keyed_uniform(seed, key, row_id) <= F.col("survival")).drop("bin", "survival")


def _given(name: str) -> Column:
    """Zero counts as missing for these fields."""
    return F.col(name).isNotNull() & (F.col(name) != 0)


def _bisect(low: Column, high: Column, too_low: Callable[[Column], Column]) -> Column:
    """Middle of an interval that is halved SOLVER_STEPS times, towards where too_low turns false."""
    start = F.struct(low.alias("low"), high.alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = (state["low"] + state["high"]) / 2
        up = too_low(middle)
        return F.struct(F.when(up, middle).otherwise(state["low"]).alias("low"), F.when(up, state["high"]).otherwise(middle).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(SOLVER_STEPS)), start, halve, lambda s: (s["low"] + s["high"]) / 2)


def _reduction(p: Column, mean: Column, mu: Column) -> Column:
    """Reduction factor for a mean of connections after thinning and a cut at mu."""
    miss = 1 - 1 / mean
    return p / (1 - p) * (mu * F.pow(miss, mu) + F.pow(miss, mu + 1) * mean)


def reduce_params(stats: DataFrame, rules: DataFrame) -> DataFrame:
    """stats with p_a, pmu_a, brf and active_fraction, from the first case that a pathway's rule supports.

    rules has pathway_i and the nullable fields brf, cv, mean, sd, af, prob, p_a and pmu_a. All cases are
    column expressions; the case with a wanted reduction and active fraction is solved by bisection.
    """
    r = stats.join(rules.withColumnsRenamed({"p_a": "rule_p_a", "pmu_a": "rule_pmu_a", "brf": "rule_brf"}).withColumn("__rule", F.lit(True)), "pathway_i", "left")
    m, cv, brf, af = F.col("structural_mean"), F.col("cv"), F.col("rule_brf"), F.col("af")
    p = F.try_divide(F.lit(1.0), m)
    none = F.col("__rule").isNull() | (m == 0)
    both = _given("rule_brf") & _given("cv")

    # a wanted reduction and active fraction
    q = F.when(p >= 1, p + 1e-5).otherwise(p)
    target = brf / af
    mu_of = lambda mean: 1 - 0.5 / cv + (1 / cv - 1) * mean
    top = F.greatest(1 / q, F.lit(1.0 + 1e-9))
    inside = _reduction(q, top, mu_of(top)) >= target
    mean_solved = F.when(inside, _bisect(F.lit(1.0 + 1e-9), top, lambda x: _reduction(q, x, mu_of(x)) < target)).otherwise(top)
    mu_solved = F.when(inside, mu_of(mean_solved)).otherwise(_bisect(F.lit(1.0), F.greatest(F.lit(1.0), mu_of(top)), lambda x: _reduction(q, top, x) > target))
    p_solved = q / (1 - q) * (mean_solved - 1)

    # a wanted mean
    spread = F.when(both, F.least(F.col("mean") * cv, m - 0.5)).otherwise(F.col("sd"))
    p_after = F.when(both, 1 / (F.sqrt(spread * spread + 0.25) + 0.5)).otherwise(F.try_divide(F.lit(1.0), spread + 0.5))
    p_mean = F.when(p == 1, 1.0).otherwise(F.try_divide(p, 1 - p) * (1 - p_after) / p_after)
    mu_mean = 0.5 + F.col("mean") - spread

    # a wanted probability
    modifier = F.try_divide(brf, F.col("prob"))
    p_prob = modifier * cv
    mu_prob = F.greatest((m - cv * m + cv) * modifier, F.lit(1.0))
    af_prob = F.try_divide(F.exp((1 - cv) / cv) * brf * (m - 1), m * modifier)

    cases = (
        (none, 1.0, None, None, None),
        (both & _given("af"), p_solved, mu_solved, af, brf),
        (both & _given("mean"), p_mean, mu_mean, 0.5, brf),
        (both & _given("prob"), p_prob, mu_prob, af_prob, brf),
        (both, 1.0, None, None, brf),
        (_given("rule_brf") & F.col("rule_p_a").isNotNull() & F.col("rule_pmu_a").isNotNull(), F.col("rule_p_a"), 0.5 + F.col("rule_pmu_a"), 0.5, brf),
        (_given("mean") & _given("sd"), p_mean, mu_mean, af, DEFAULT_REDUCTION),
    )

    def pick(i: int, default: Column) -> Column:
        out = None
        for case in cases:
            value = case[i] if isinstance(case[i], Column) else F.lit(case[i]).cast("double")
            out = F.when(case[0], value) if out is None else out.when(case[0], value)
        return out.otherwise(default)

    nothing = F.lit(None).cast("double")
    return r.select(
        *stats.columns,
        F.least(pick(1, F.lit(1.0)), F.lit(1.0)).alias("p_a"),
        (pick(2, nothing) - 0.5).alias("pmu_a"),
        pick(4, brf).alias("brf"),
        F.when(pick(3, nothing).isNotNull(), F.least(pick(3, nothing), F.lit(1.0))).alias("active_fraction"),
    )


def reduce_step(df: DataFrame, params: DataFrame, seed: int) -> DataFrame:
    """Edges whose number is under their pathway's p_a."""
    return df.join(params.select("pathway_i", "p_a"), "pathway_i").where(F.col("p_a") > keyed_uniform(seed, REDUCE, "synapse_id")).drop("p_a")


def connection_counts(reduced: DataFrame) -> DataFrame:
    """(pathway_i, src, dst, n, first_id) of the connections that are left."""
    return reduced.groupBy("src", "dst").agg(F.min("pathway_i").alias("pathway_i"), F.count("*").alias("n"), F.min("synapse_id").alias("first_id"))


def cut_step(connections: DataFrame, params: DataFrame, seed: int) -> DataFrame:
    """Connections that survive the cut at pmu_a; pathways without one lose all of theirs."""
    joined = connections.join(params.select("pathway_i", "pmu_a").where("pmu_a IS NOT NULL"), "pathway_i")
    sigma = F.col("pmu_a") / 4
    survival = F.when(sigma == 0, 1.0).otherwise(1 / (1 + F.exp(-4 / sigma * (F.col("n") - F.col("pmu_a")))))
    kept = joined.withColumn("survival", survival)
    return kept.where((F.col("survival") > 0) & (F.col("survival") > keyed_uniform(seed, CUT, "first_id"))).drop("pmu_a")


def active_fractions(survivors: DataFrame, params: DataFrame) -> DataFrame:
    """(pathway_i, actual, fraction): what share of the surviving connections stays active."""
    left = survivors.groupBy("pathway_i").agg(F.sum("n").alias("left"))
    joined = left.join(params, "pathway_i").withColumn("actual", F.col("left") / F.col("total_touches"))
    brf = F.col("brf")
    fraction = F.when(brf.isNull(), F.col("active_fraction")).when(brf > F.col("actual"), 1.0).otherwise(F.try_divide(brf, F.col("actual")))
    return joined.select("pathway_i", "actual", fraction.alias("fraction"))


def active_step(survivors: DataFrame, fractions: DataFrame, seed: int) -> DataFrame:
    return survivors.join(fractions, "pathway_i").where(keyed_uniform(seed, ACTIVE, "first_id") < F.col("fraction")).drop("actual", "fraction")


def reduce_and_cut(df: DataFrame, params: DataFrame, seed: int) -> DataFrame:
    """Edges of the connections that stay after reduction, cut and activation.

    The reduced edges are dealt by (src, dst) once; grouping and the last join share that exchange.
    """
    reduced = reduce_step(df, params, seed).repartition("src", "dst")
    survivors = cut_step(connection_counts(reduced), params, seed)
    kept = active_step(survivors, active_fractions(survivors, params), seed).select("src", "dst")
    return reduced.join(kept, ["src", "dst"], "left_semi")
