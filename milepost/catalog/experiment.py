"""Cohort comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from milepost.catalog import derive
from milepost.catalog.registry import load, query, rounded
from milepost.functions.statistics import poisson_steps
from milepost.operators import experiment
from milepost.operators.profile import group_mean

_SUMS = list(derive.AB_METRICS)
_METRICS = ["day", *_SUMS]
_T_SQL = """(mean_a - mean_b) / nullif(sqrt(
  ((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2) * (1.0e0 / n_a + 1.0e0 / n_b)), 0)"""
_CHANGE_SQL = "CASE WHEN a = 0 THEN NULL ELSE (b - a) / a * 100 END"
_RATIO_SQL = """CASE WHEN b = 0 THEN greatest(a, b) WHEN least(a, b) = 0 THEN NULL
  ELSE round_even(greatest(a, b) / least(a, b) * 100, 0) - 100 END"""


def _users(spark, sf_dir):
    return experiment.user_rollup(
        derive.ab_daily(spark, sf_dir), "user_id", "cohort", _SUMS, counts=["day"]
    )


@query(
    "ab_user_rollup",
    f"""WITH {derive.AB_SQL}
    SELECT user_id, cohort, day, round(revenue, 2) + 0.0e0 AS revenue, big, urgent, only_a FROM per_user""",
)
def ab_user_rollup(spark, sf_dir):
    return rounded(_users(spark, sf_dir), ["revenue"], 2)


@query(
    "ab_rollup",
    f"""WITH {derive.AB_SQL}
    SELECT cohort, CAST(sum(day) AS BIGINT) AS day, round(sum(revenue), 2) + 0.0e0 AS revenue, sum(big) AS big,
      sum(urgent) AS urgent, sum(only_a) AS only_a FROM per_user GROUP BY cohort""",
)
def ab_rollup(spark, sf_dir):
    totals = experiment.cohort_totals(_users(spark, sf_dir), "cohort", _METRICS)
    return rounded(totals, ["revenue"], 2)


@query(
    "ab_change",
    f"""WITH {derive.AB_SQL}
    SELECT metric, round(a, 2) + 0.0e0 AS a, round(b, 2) + 0.0e0 AS b,
      round({_CHANGE_SQL}, 2) + 0.0e0 AS change_pct, {_RATIO_SQL} + 0.0e0 AS ratio_pct FROM m""",
)
def ab_change(spark, sf_dir):
    moments = experiment.cohort_moments(_users(spark, sf_dir), "cohort", _METRICS, "A", "B")
    a, b = F.col("total_a"), F.col("total_b")
    out = moments.select(
        "metric", a.alias("a"), b.alias("b"),
        experiment.signed_change(a, b).alias("change_pct"),
        experiment.larger_by_smaller(a, b).alias("ratio_pct"),
    )
    return rounded(out, ["a", "b", "change_pct", "ratio_pct"], 2)


@query(
    "ab_ttest",
    f"""WITH {derive.AB_SQL}
    SELECT metric, n_a, n_b, round(mean_a, 4) + 0.0e0 AS mean_a, round(mean_b, 4) + 0.0e0 AS mean_b,
      n_a + n_b - 2 AS df, round({_T_SQL}, 6) + 0.0e0 AS t FROM m""",
)
def ab_ttest(spark, sf_dir):
    moments = experiment.cohort_moments(_users(spark, sf_dir), "cohort", _METRICS, "A", "B")
    tested = experiment.t_statistics(moments).select(
        "metric", "n_a", "n_b", "mean_a", "mean_b", "df", "t"
    )
    return rounded(rounded(tested, ["mean_a", "mean_b"]), ["t"], 6)


@query(
    "ttest_two_groups",
    """WITH m AS (
      SELECT count(*) FILTER (WHERE l_returnflag = 'A') AS n_a, count(*) FILTER (WHERE l_returnflag = 'R') AS n_b,
        avg(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS mean_a,
        avg(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS mean_b,
        var_samp(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS var_a,
        var_samp(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS var_b FROM lineitem)
    SELECT 'l_extendedprice' AS metric, n_a + n_b - 2 AS df, round(""" + _T_SQL + """, 6) + 0.0e0 AS t FROM m""",
)
def ttest_two_groups(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")
    moments = experiment.cohort_moments(items, "l_returnflag", ["l_extendedprice"], "A", "R")
    return rounded(experiment.t_statistics(moments).select("metric", "df", "t"), ["t"], 6)


# Two-sided p-value: one minus twice the density's integral up to |t|, by Simpson's rule.
_P_SQL = f"""tt AS (SELECT *, CAST(n_a + n_b - 2 AS DOUBLE) AS df, abs({_T_SQL}) AS t_abs FROM m),
pv AS (
  SELECT metric, greatest(0.0e0, 1.0e0 - 2.0e0 * any_value(t_abs) / 6000.0e0 * sum(
      CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
      * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
      * pow(1 + pow(t_abs * i / 2000.0e0, 2) / df, -(df + 1) / 2))) AS p_value
  FROM tt, range(0, 2001) s(i) GROUP BY metric
)"""


@query(
    "ttest_p_values",
    f"""WITH {derive.AB_SQL}, {_P_SQL}
    SELECT metric, round(mean_a, 4) + 0.0e0 AS mean_a, round(mean_b, 4) + 0.0e0 AS mean_b,
      n_a + n_b - 2 AS df, round(p_value, 6) + 0.0e0 AS p_value, p_value < 0.05 AS significant
    FROM m JOIN pv USING (metric)""",
)
def ttest_p_values(spark, sf_dir):
    out = experiment.t_test(_users(spark, sf_dir), "cohort", _METRICS, "A", "B").drop("t")
    return rounded(rounded(out, ["mean_a", "mean_b"]), ["p_value"], 6)


def _poisson_sql(u: str) -> str:
    steps = poisson_steps()
    whens = " ".join(f"WHEN {u} < {edge!r}e0 THEN {k}" for k, edge in enumerate(steps))
    return f"CASE {whens} ELSE {len(steps)} END"


#: Enough for 25 replicates beyond each end of a 95 % interval.
_REPLICATES = 1000

_BOOT_SQL = f"""draws AS (
  SELECT p.*, b, CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(b AS VARCHAR)), 1, 8)) AS BIGINT)
    / 4294967296.0e0 AS u
  FROM per_user p CROSS JOIN range(1, {_REPLICATES + 1}) r(b)
),
weighted AS (SELECT *, {_poisson_sql('u')} AS w FROM draws),
diffs AS (
  SELECT b, sum(w * revenue) FILTER (WHERE cohort = 'B') / sum(w) FILTER (WHERE cohort = 'B')
    - sum(w * revenue) FILTER (WHERE cohort = 'A') / sum(w) FILTER (WHERE cohort = 'A') AS difference
  FROM weighted GROUP BY b
)"""


def _draws(spark, sf_dir):
    return experiment.bootstrap_differences(
        _users(spark, sf_dir), "user_id", "cohort", "revenue", "A", "B", _REPLICATES, weights="md5"
    )


@query(
    "ab_bootstrap",
    f"""WITH {derive.AB_SQL}, {_BOOT_SQL}
    SELECT CAST(b AS INTEGER) AS replicate, round(difference, 1) + 0.0e0 AS difference FROM diffs""",
)
def ab_bootstrap(spark, sf_dir):
    # Quotients of cents by small counts often end on half a thousandth; in tenths none of these does.
    return rounded(_draws(spark, sf_dir), ["difference"], 1)


@query(
    "ab_bootstrap_interval",
    f"""WITH {derive.AB_SQL}, {_BOOT_SQL}
    SELECT round(quantile_cont(difference, 0.025), 3) + 0.0e0 AS ci_low,
      round(quantile_cont(difference, 0.975), 3) + 0.0e0 AS ci_high FROM diffs""",
)
def ab_bootstrap_interval(spark, sf_dir):
    return rounded(experiment.bootstrap_interval(_draws(spark, sf_dir)), ["ci_low", "ci_high"], 3)


@query(
    "ab_result",
    f"""WITH {derive.AB_SQL}, {_BOOT_SQL},
    ci AS (SELECT 'revenue' AS metric, quantile_cont(difference, 0.025) AS lo,
      quantile_cont(difference, 0.975) AS hi FROM diffs)
    SELECT metric, round(a, 2) + 0.0e0 AS a, round(b, 2) + 0.0e0 AS b,
      round({_CHANGE_SQL}, 2) + 0.0e0 AS change_pct, {_RATIO_SQL} + 0.0e0 AS ratio_pct,
      round(lo, 3) + 0.0e0 AS ci_low, round(hi, 3) + 0.0e0 AS ci_high
    FROM m LEFT JOIN ci USING (metric)""",
)
def ab_result(spark, sf_dir):
    """Final table without the p-value, which has no SQL form."""
    report = experiment.ab_report(
        derive.ab_daily(spark, sf_dir), "user_id", "cohort", _SUMS, "A", "B", counts=["day"],
        bootstrap={"revenue": _REPLICATES}, weights="md5",
    ).drop("p_value", "significant")
    report = rounded(report, ["a", "b", "change_pct", "ratio_pct"], 2)
    return rounded(report, ["ci_low", "ci_high"], 3)


@query(
    "ab_report",
    f"""WITH {derive.AB_SQL}, {_BOOT_SQL}, {_P_SQL},
    ci AS (SELECT 'revenue' AS metric, quantile_cont(difference, 0.025) AS lo,
      quantile_cont(difference, 0.975) AS hi FROM diffs)
    SELECT metric, round(a, 2) + 0.0e0 AS a, round(b, 2) + 0.0e0 AS b,
      round({_CHANGE_SQL}, 2) + 0.0e0 AS change_pct, {_RATIO_SQL} + 0.0e0 AS ratio_pct,
      round(p_value, 6) + 0.0e0 AS p_value, p_value < 0.05 AS significant,
      round(lo, 3) + 0.0e0 AS ci_low, round(hi, 3) + 0.0e0 AS ci_high
    FROM m JOIN pv USING (metric) LEFT JOIN ci USING (metric)""",
)
def ab_report(spark, sf_dir):
    """Whole report: totals, change, p-value and interval."""
    report = experiment.ab_report(
        derive.ab_daily(spark, sf_dir), "user_id", "cohort", _SUMS, "A", "B", counts=["day"],
        bootstrap={"revenue": _REPLICATES}, weights="md5",
    )
    report = rounded(report, ["a", "b", "change_pct", "ratio_pct"], 2)
    return rounded(rounded(report, ["ci_low", "ci_high"], 3), ["p_value"], 6)


@query(
    "cohort_means",
    f"""WITH {derive.AB_SQL} SELECT cohort, round(avg(revenue), 3) + 0.0e0 AS mean FROM per_user GROUP BY cohort""",
)
def cohort_means(spark, sf_dir):
    return rounded(group_mean(_users(spark, sf_dir), "cohort", "revenue"), ["mean"], 3)


@query(
    "cohort_lookup",
    f"""WITH {derive.AB_SQL} SELECT user_id, day, round(revenue, 2) + 0.0e0 AS revenue FROM per_user WHERE cohort = 'B'""",
)
def cohort_lookup(spark, sf_dir):
    """Rows of one cohort."""
    rows = _users(spark, sf_dir).where(F.col("cohort") == "B").select("user_id", "day", "revenue")
    return rounded(rows, ["revenue"], 2)
