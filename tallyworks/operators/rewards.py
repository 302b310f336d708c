"""Logged rewards ``(run, day, arm, reward)``: what choice rules would have earned, and arm scores.

Days and arms count from 0 and every arm has a reward on every day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.scan import OrderedScan
from tallyworks.operators.windows import running_mean


def replay_uniform(log: DataFrame, arms: int, seed: int) -> DataFrame:
    """One arm per run and day, drawn by a hash of run, day and seed."""
    key = F.concat_ws("-", "run", "day", F.lit(seed))
    draw = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % arms
    return log.where(F.col("arm") == draw)


def replay_commit(log: DataFrame, arms: int) -> DataFrame:
    """Every arm once in order, then the arm with the best of these rewards (first on a tie)."""
    tried = log.where((F.col("day") < arms) & (F.col("arm") == F.col("day")))
    best = tried.groupBy("run").agg(F.min_by("arm", F.struct(-F.col("reward"), F.col("arm"))).alias("__best"))
    kept = log.where(F.col("day") >= arms).join(best, "run").where("arm = __best").drop("__best")
    return tried.unionByName(kept)


def cumulative(choices: DataFrame, parts: int | None = None) -> DataFrame:
    """Adds the reward collected so far in each run."""
    return OrderedScan(choices, ["run"], ["day"], parts).running_sum(F.col("reward"), "collected").result()


def regret(choices: DataFrame, log: DataFrame, best_arm: int) -> DataFrame:
    """Per run: reward of always taking ``best_arm``, reward collected, and what was missed."""
    best = log.where(F.col("arm") == best_arm).groupBy("run").agg(F.sum("reward").alias("best"))
    got = choices.groupBy("run").agg(F.sum("reward").alias("collected"))
    return best.join(got, "run").withColumn("regret", F.col("best") - F.col("collected"))


def mean_regret(regrets: DataFrame) -> DataFrame:
    return regrets.agg((F.avg("best") - F.avg("collected")).alias("mean_regret"))


def _arm_sums(choices: DataFrame, arms: int) -> DataFrame:
    """Count and sum of every arm of every run, arms without choice included."""
    runs = choices.select("run").distinct()
    every = runs.select("run", F.explode(F.sequence(F.lit(0), F.lit(arms - 1))).alias("arm"))
    seen = choices.groupBy("run", "arm").agg(F.count(F.lit(1)).alias("n"), F.sum("reward").alias("total"))
    return every.join(seen, ["run", "arm"], "left").fillna({"n": 0, "total": 0.0})


def ucb_scores(choices: DataFrame, arms: int, day: int) -> DataFrame:
    """Mean plus sqrt(2 ln(day) / count) of each arm; without bound for an arm not tried yet.

    ``chosen`` marks the arm to take next, the first one on a tie.
    """
    scored = _arm_sums(choices, arms).withColumn(
        "bound",
        F.when(F.col("n") == 0, F.lit(float("inf"))).otherwise(
            F.try_divide("total", "n") + F.sqrt(F.try_divide(F.lit(2.0) * F.ln(F.lit(float(day))), F.col("n")))
        ),
    )
    top = scored.groupBy("run").agg(F.min_by("arm", F.struct(-F.col("bound"), F.col("arm"))).alias("__top"))
    return scored.join(top, "run").withColumn("chosen", F.col("arm") == F.col("__top")).drop("__top")


def running_bounds(choices: DataFrame, parts: int | None = None) -> DataFrame:
    """Bound of the chosen arm before each of its choices, from the choices made so far."""
    rows = running_mean(choices, ["run", "arm"], ["day"], "reward", inclusive=False, parts=parts)
    width = F.sqrt(F.try_divide(F.lit(2.0) * F.ln(F.greatest(F.col("day"), F.lit(1)).cast("double")), F.col("seen")))
    return rows.withColumn(
        "bound", F.when(F.col("seen") == 0, F.lit(float("inf"))).otherwise(F.col("mean_so_far") + width)
    )


def greedy_arm(choices: DataFrame) -> DataFrame:
    """Arm with the highest mean of each run, the smallest arm on a tie."""
    means = choices.groupBy("run", "arm").agg(F.avg("reward").alias("mean"))
    best = F.min_by(F.struct("arm", "mean"), F.struct(-F.col("mean"), F.col("arm")))
    return means.groupBy("run").agg(best.alias("__b")).select("run", "__b.*")


def posterior(choices: DataFrame, arms: int, prior_sd: float = 100.0) -> DataFrame:
    """Normal posterior of each arm's mean under a wide prior and unit noise: variance and mean."""
    variance = 1.0 / (1.0 / prior_sd**2 + F.col("n"))
    return _arm_sums(choices, arms).select("run", "arm", "n", variance.alias("variance"), (variance * F.col("total")).alias("mean"))
