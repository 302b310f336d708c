"""Queries on rewards: the mean event value of a day is the reward of the event type."""

from pyspark.sql import functions as F

from tallyworks.operators import rewards
from tallyworks.plans.registry import query

_ARMS = ["click", "error", "purchase", "signup", "view"]


def log(t):
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    arm = F.array_position(F.array(*[F.lit(a) for a in _ARMS]), F.col("event_type")).cast("int") - 1
    return t.events.groupBy((F.col("user_id") % 5).cast("int").alias("run"), day.alias("day"), arm.alias("arm")).agg(
        F.round(F.avg("value"), 3).alias("reward")
    )


LOG = f"""(SELECT CAST(user_id % 5 AS INTEGER) AS run, CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS INTEGER) AS day,
CAST(list_position([{', '.join(repr(a) for a in _ARMS)}], event_type) - 1 AS INTEGER) AS arm, round(avg(value), 3) AS reward FROM events GROUP BY 1, 2, 3)"""

UNIFORM = f"(SELECT * FROM {LOG} WHERE arm = ('0x' || substr(md5(run || '-' || day || '-' || 42), 1, 8))::BIGINT % 5)"

COMMIT = f"""(SELECT g.* FROM {LOG} g JOIN (SELECT run, arg_min(arm, (-reward, arm)) AS best FROM {LOG} WHERE day < 5 AND arm = day GROUP BY 1) b USING (run)
WHERE (day < 5 AND arm = day) OR (day >= 5 AND arm = best))"""


@query("b01_replay_uniform", f"SELECT * FROM {UNIFORM}")
def b01(t):
    return rewards.replay_uniform(log(t), 5, 42)


@query("b02_replay_commit", f"SELECT * FROM {COMMIT}")
def b02(t):
    return rewards.replay_commit(log(t), 5)


@query(
    "b03_cumulative",
    f"SELECT run, day, round(sum(reward) OVER (PARTITION BY run ORDER BY day), 3) AS collected FROM {COMMIT}",
)
def b03_cumulative(t):
    out = rewards.cumulative(rewards.replay_commit(log(t), 5))
    return out.select("run", "day", F.round("collected", 3).alias("collected"))


def regret_sql(choices: str) -> str:
    return f"""(SELECT run, best, collected, best - collected AS regret FROM (SELECT run, sum(reward) AS best FROM {LOG} WHERE arm = 2 GROUP BY 1)
JOIN (SELECT run, sum(reward) AS collected FROM {choices} GROUP BY 1) USING (run))"""


@query(
    "b03_regret",
    f"SELECT run, round(best, 3) AS best, round(collected, 3) AS collected, round(regret, 3) AS regret FROM {regret_sql(COMMIT)}",
)
def b03(t):
    out = rewards.regret(rewards.replay_commit(log(t), 5), log(t), 2)
    return out.select("run", *[F.round(c, 3).alias(c) for c in ("best", "collected", "regret")])


@query("b03_mean_regret", f"SELECT round(avg(best) - avg(collected), 4) AS mean_regret FROM {regret_sql(UNIFORM)}")
def b03_mean(t):
    out = rewards.mean_regret(rewards.regret(rewards.replay_uniform(log(t), 5, 42), log(t), 2))
    return out.select(F.round("mean_regret", 4).alias("mean_regret"))


def sums_sql(choices: str, before: int) -> str:
    return f"""(SELECT run, arm, count(reward) AS n, coalesce(sum(reward), 0) AS total FROM (SELECT DISTINCT run FROM {choices} WHERE day < {before})
JOIN (SELECT CAST(unnest(range(5)) AS INTEGER) AS arm) ON true LEFT JOIN (SELECT * FROM {choices} WHERE day < {before}) USING (run, arm) GROUP BY 1, 2)"""


@query(
    "b04_ucb_scores",
    f"""SELECT run, arm, n, bound = 'Infinity' AS unbounded, CASE WHEN bound < 1e300 THEN round(bound, 4) END AS bound, row_number() OVER (PARTITION BY run ORDER BY bound DESC, arm) = 1 AS chosen
FROM (SELECT run, arm, n, CASE WHEN n = 0 THEN CAST('Infinity' AS DOUBLE) ELSE total / n + sqrt(2 * ln((SELECT max(day) + 1 FROM {UNIFORM})) / n) END AS bound FROM {sums_sql(UNIFORM, 2**31 - 1)})""",
)
def b04(t):
    choices = rewards.replay_uniform(log(t), 5, 42)
    bound = F.col("bound")
    days = choices.agg(F.max("day") + 1).first()[0]
    return rewards.ucb_scores(choices, 5, days).select(
        "run", "arm", "n", (bound == float("inf")).alias("unbounded"), F.when(bound < 1e300, F.round(bound, 4)).alias("bound"), "chosen"
    )


@query(
    "b04_running_bounds",
    f"""SELECT run, day, arm, seen, CASE WHEN seen > 0 THEN round(mean + sqrt(2 * ln(greatest(day, 1)) / seen), 4) END AS bound FROM (
SELECT run, day, arm, count(reward) OVER w AS seen, avg(reward) OVER w AS mean FROM {UNIFORM}
WINDOW w AS (PARTITION BY run, arm ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
)
def b04_running(t):
    out = rewards.running_bounds(rewards.replay_uniform(log(t), 5, 42))
    return out.select(
        "run", "day", "arm", "seen", F.when(F.col("seen") > 0, F.round("bound", 4)).alias("bound")
    )


@query(
    "b05_greedy_arm",
    f"""SELECT run, arm, round(mean, 4) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY mean DESC, arm) AS r FROM (
SELECT run, arm, avg(reward) AS mean FROM {UNIFORM} GROUP BY 1, 2)) WHERE r = 1""",
)
def b05(t):
    best = rewards.greedy_arm(rewards.replay_uniform(log(t), 5, 42))
    return best.select("run", "arm", F.round("mean", 4).alias("mean"))


@query(
    "b06_posterior",
    f"""SELECT run, arm, n, round(1 / (0.0001::DOUBLE + n), 6) AS variance, round(total / (0.0001::DOUBLE + n), 4) AS mean FROM {sums_sql(UNIFORM, 1000)}""",
)
def b06(t):
    out = rewards.posterior(rewards.replay_uniform(log(t), 5, 42), 5)
    return out.select("run", "arm", "n", F.round("variance", 6).alias("variance"), F.round("mean", 4).alias("mean"))
