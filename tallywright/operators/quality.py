"""Profiles, key checks, control limits and monitors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from tallywright.functions import money
from tallywright.operators import recon, windows

# Control limits as shares of 1.
MAX_ORPHAN_RATE = 0.001
MAX_AMOUNT_DIFF_RATE = 0.0001
MAX_DATE_DIFF_RATE = 0.01
MIN_MATCH_RATE = 0.95

# KPI name, alert side and limit.
KPI_ALERTS = {
    "completion_rate": ("below", 0.995),
    "orphan_rate": ("above", 0.005),
    "mean_resolution_hours": ("above", 48.0),
    "auto_handled_rate": ("below", 0.6),
}

# Limits of the sync monitors.
MAX_LATENCY_MINUTES = 5
MAX_FAILURE_RATE = 0.01
MAX_COUNT_CHANGE = 0.2
MAX_RESPONSE_SECONDS = 10
MAX_AUTH_FAILURES_PER_HOUR = 3

#: A run's orphans surge beyond so many standard deviations above the mean of at least so many earlier runs.
SURGE_DEVIATIONS, SURGE_RUNS = 3, 5


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns, one row."""
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def _missing(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    gone = value.isNull()
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        gone = gone | F.isnan(value)
    return F.count_if(gone)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column that has any, in one pass over the data."""
    counts = df.agg(F.count("*").alias("_all"), *(_missing(df, c).alias(c) for c in df.columns))
    tall = counts.unpivot(["_all"], [f"`{c}`" for c in df.columns], "column_name", "missing_count")
    return tall.where(F.col("missing_count") > 0).select(
        "column_name",
        "missing_count",
        F.bround(money.ratio(F.col("missing_count"), F.col("_all")) * 100, 2).alias("missing_pct"),
    )


def dedupe(df: DataFrame) -> DataFrame:
    """Rows that differ in at least one column."""
    return df.dropDuplicates()


def dedupe_summary(df: DataFrame) -> DataFrame:
    """Rows before and after :func:`dedupe`, from one grouping."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def orphan_fk(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry each.

    Counting first shrinks a hot child key to one row per task before the join.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("child_rows"))
    return used.join(parent.select(key), key, "left_anti")


def left_join_integrity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Does a left join keep every left row exactly once?  One row: counts and verdict.

    The join only has to be counted, so both sides meet as counts per key: the
    join gives left rows times the right rows of the key (or one without any).
    """
    lefts = left.groupBy(key).agg(F.count("*").alias("l"))
    rights = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("r"))
    per_key = lefts.join(rights, key, "left").withColumn("joined", F.col("l") * F.coalesce("r", F.lit(1)))
    counts = per_key.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("joined"), F.lit(0)).alias("joined_rows"),
        F.count(key).alias("distinct_keys"),
    )
    passed = F.col("left_rows") == F.col("joined_rows")
    return counts.withColumn("integrity", F.when(passed, "PASSED").otherwise("FAILED"))


# -- control limits over one comparison (recon.full) --------------------------


def _rates(compared: DataFrame, tolerance_days: int = recon.DATE_TOLERANCE_DAYS) -> DataFrame:
    status = F.col("status")
    pair = F.col("active") & F.col("live")
    return compared.agg(
        F.count("*").alias("all_rows"),
        F.count_if(F.col("active")).alias("active_orders"),
        F.count_if(pair).alias("pairs"),
        F.count_if(status == "OK").alias("ok"),
        F.count_if(status.isin("OPS_ONLY", "FIN_ONLY")).alias("orphans"),
        F.count_if(pair & (F.abs("days_apart") > tolerance_days)).alias("date_off"),
        F.sum(F.when(pair, F.col("amount_diff"))).alias("diff_sum"),
        F.sum(F.when(pair, F.col("sales"))).alias("sales_sum"),
    )


def control_checks(compared: DataFrame, orders: DataFrame, tolerance_days: int = recon.DATE_TOLERANCE_DAYS) -> DataFrame:
    """Measured rate, limit and verdict per control, NOT_COMPUTABLE without a base.

    ``tolerance_days`` is that of the comparison."""
    rates = _rates(compared, tolerance_days)

    def share(top: str, bottom: str) -> Column:
        return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))

    measured = [
        ("orphan_rate", share("orphans", "all_rows"), MAX_ORPHAN_RATE, "max"),
        ("amount_diff_rate", share("diff_sum", "sales_sum"), MAX_AMOUNT_DIFF_RATE, "max"),
        ("date_diff_rate", share("date_off", "pairs"), MAX_DATE_DIFF_RATE, "max"),
        ("match_rate", share("ok", "active_orders"), MIN_MATCH_RATE, "min"),
    ]
    rows = [
        F.struct(F.lit(n).alias("check_name"), v.alias("value"), F.lit(lim).alias("limit_value"), F.lit(side).alias("side"))
        for n, v, lim, side in measured
    ]
    keys = orders.groupBy("order_id").agg(F.count("*").alias("c"))
    unique = keys.agg(F.try_divide(F.count("*").cast("double"), F.sum("c").cast("double")).alias("value")).select(
        F.lit("unique_key_rate").alias("check_name"),
        "value",
        F.lit(1.0).alias("limit_value"),
        F.lit("min").alias("side"),
    )
    checks = rates.select(F.explode(F.array(*rows)).alias("c")).select("c.*").unionByName(unique)
    good = F.when(F.col("side") == "max", F.col("value") <= F.col("limit_value")).otherwise(
        F.col("value") >= F.col("limit_value")
    )
    verdict = F.when(F.col("value").isNull(), "NOT_COMPUTABLE").when(good, "PASS").otherwise("FAIL")
    return checks.select("check_name", F.bround("value", 6).alias("value"), "limit_value", verdict.alias("verdict"))


def kpis(compared: DataFrame, risk_flags: DataFrame) -> DataFrame:
    """Completion, orphan and auto-handled rates and mean resolution time, with alerts."""
    auto = (F.col("status") == "OPS_ONLY") | ((F.col("status") == "OK") & (F.col("days_apart") != 0))
    manual = F.col("status").isin("FIN_ONLY", "AMOUNT_MISMATCH", "DATE_MISMATCH")
    counts = compared.agg(
        F.count("*").alias("all_rows"),
        F.count_if(F.col("active")).alias("active_orders"),
        F.count_if(F.col("active") & F.col("live")).alias("pairs"),
        F.count_if(F.col("status").isin("OPS_ONLY", "FIN_ONLY")).alias("orphans"),
        F.count_if(auto).alias("auto_handled"),
        F.count_if(auto | manual).alias("exceptions"),
    )

    def share(top: str, bottom: str) -> Column:
        return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))

    named = {
        "completion_rate": share("pairs", "active_orders"),
        "orphan_rate": share("orphans", "all_rows"),
        "auto_handled_rate": share("auto_handled", "exceptions"),
    }
    rows = [F.struct(F.lit(name).alias("kpi"), value.alias("value")) for name, value in named.items()]
    seconds = F.unix_micros("resolved_at") - F.unix_micros("flag_date")
    resolution = risk_flags.agg(
        F.try_divide(F.sum(seconds).cast("double"), F.count(seconds) * F.lit(3_600_000_000.0)).alias("value")
    ).select(F.lit("mean_resolution_hours").alias("kpi"), "value")
    table = counts.select(F.explode(F.array(*rows)).alias("k")).select("k.*").unionByName(resolution)
    alert = F.lit(False)
    for name, (side, limit) in KPI_ALERTS.items():
        beyond = F.col("value") < limit if side == "below" else F.col("value") > limit
        alert = F.when(F.col("kpi") == name, beyond).otherwise(alert)
    return table.select("kpi", F.bround("value", 4).alias("value"), F.coalesce(alert, F.lit(False)).alias("alert"))


def alert_level(compared: DataFrame) -> DataFrame:
    """Alert level from the orphan rate; EMERGENCY when there is nothing to compare."""
    rate = F.try_divide(F.col("orphans") * 100.0, F.col("all_rows").cast("double"))
    level = (
        F.when(rate.isNull(), "EMERGENCY")
        .when(rate > 1, "CRITICAL")
        .when(rate > 0.5, "WARNING")
        .when(rate > 0.1, "INFO")
        .otherwise("NONE")
    )
    return _rates(compared).select(
        F.col("orphans"), F.col("all_rows"), F.bround(rate, 4).alias("orphan_rate_pct"), level.alias("alert_level")
    )


# -- sync monitors ------------------------------------------------------------


def sync_monitors(runs: DataFrame) -> DataFrame:
    """Per sync run: latency, response time and jump of the record count.

    ``runs``: system, table_name, run_ts, record_count, latency_minutes,
    response_seconds, failed, auth_failures.
    """
    compared = windows.previous_value(
        runs, ["system", "table_name"], "run_ts", "record_count", "previous_count", F.trunc("run_ts", "month")
    )
    change = F.try_divide(
        F.abs(F.col("record_count") - F.col("previous_count")).cast("double"), F.col("previous_count").cast("double")
    )
    return compared.select(
        "system",
        "table_name",
        "run_ts",
        "record_count",
        "previous_count",
        F.bround(change, 4).alias("count_change"),
        (F.col("latency_minutes") > MAX_LATENCY_MINUTES).alias("latency_alert"),
        (F.col("response_seconds") > MAX_RESPONSE_SECONDS).alias("response_alert"),
        F.coalesce(change > MAX_COUNT_CHANGE, F.lit(False)).alias("count_alert"),
    )


def orphan_runs(compared: DataFrame) -> DataFrame:
    """Orphans of each side and day, days without any included: ``side``, ``run_date``, ``orphans``."""
    sides = ("OPS_ONLY", "FIN_ONLY")
    days = compared.groupBy(F.coalesce("order_date", "invoice_date").alias("run_date")).agg(*[F.count_if(F.col("status") == side).alias(side) for side in sides])
    pairs = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("orphans")) for side in sides])).alias("pair")
    return days.where("run_date IS NOT NULL").select("run_date", pairs).select("pair.side", "run_date", "pair.orphans")


def orphan_surge(runs: DataFrame, deviations: int = SURGE_DEVIATIONS, least_runs: int = SURGE_RUNS) -> DataFrame:
    """Each run's orphans against those of all earlier runs of its side.

    ``runs``: side, run_date, orphans.  The test uses whole numbers only: with n earlier runs of sum s and
    squares q, x surges if n x > s and (n x - s)^2 > d^2 (n q - s^2).
    """
    seen = windows.earlier_moments(runs, ["side"], "run_date", "orphans", F.trunc("run_date", "month"))
    n, total = F.col("n").cast("decimal(9,0)"), F.col("sum").cast("decimal(18,0)")
    above = n * F.col("orphans").cast("decimal(9,0)") - total
    spread = n * F.col("squares").cast("decimal(27,0)") - total * total
    beyond = (above > 0) & (above * above > spread * (deviations * deviations))
    mean = F.try_divide(F.col("sum").cast("double"), F.col("n").cast("double"))
    return seen.select(
        "side",
        "run_date",
        "orphans",
        F.col("last").alias("previous_orphans"),
        F.col("n").alias("earlier_runs"),
        F.bround(mean, 4).alias("earlier_mean"),
        ((F.col("n") >= least_runs) & F.coalesce(beyond, F.lit(False))).alias("surge"),
    )


def sync_failures(runs: DataFrame) -> DataFrame:
    """Per system: failure rate over its runs, and the alert."""
    rate = money.ratio(F.col("failures"), F.col("runs"))
    return (
        runs.groupBy("system")
        .agg(F.count("*").alias("runs"), F.count_if("failed").alias("failures"))
        .select(
            "system",
            "runs",
            "failures",
            F.bround(rate, 4).alias("failure_rate"),
            (rate > MAX_FAILURE_RATE).alias("failure_alert"),
        )
    )


def auth_failures(attempts: DataFrame, ts: str = "ts", limit: int = MAX_AUTH_FAILURES_PER_HOUR) -> DataFrame:
    """Hours with more than ``limit`` failed sign-ins."""
    return (
        attempts.groupBy(F.date_trunc("hour", ts).alias("hour"))
        .agg(F.count("*").alias("failures"))
        .where(F.col("failures") > limit)
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


