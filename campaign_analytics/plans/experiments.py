"""A/B tests: group sizes, assignment and significance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import hash_slot
from ..functions.text import pct_text
from ..operators.numbering import global_row_number

# The two-sided 5 % bound, and the default shares of control and test group.
CRITICAL_Z = 1.96
DEFAULT_SHARES = {"control": 20, "test": 80}
SLOTS = 10_000


def group_size_check(groups: DataFrame) -> DataFrame:
    """Whether the group percentages of each test add up to 100."""
    total = groups.groupBy("test_id").agg(F.coalesce(F.sum("percent"), F.lit(0)).alias("total_percent"))
    return total.withColumn(
        "message",
        F.when(F.col("total_percent") == 100, F.lit("ok")).otherwise(F.lit("Group percentages must add up to 100")),
    )


def ab_significance(results: DataFrame) -> DataFrame:
    """Rates, pooled two-proportion z and verdict of each test group against its control.

    An undefined z, from empty groups or from no conversions at all, is not significant.
    """
    control = results.where("is_control").select(
        "test_id", F.col("users").alias("control_users"), F.col("conversions").alias("control_conversions")
    )
    rows = results.where("NOT is_control").join(control, "test_id")

    def rate(conversions: str, users: str):
        return F.try_divide(F.col(conversions).cast("double"), F.col(users).cast("double"))

    users = (F.col("users") + F.col("control_users")).cast("double")
    pooled = F.try_divide((F.col("conversions") + F.col("control_conversions")).cast("double"), users)
    spread = F.try_divide(F.lit(1.0), F.col("users").cast("double")) + F.try_divide(
        F.lit(1.0), F.col("control_users").cast("double")
    )
    error = F.sqrt(pooled * (1 - pooled) * spread)
    z = F.try_divide(F.col("test_rate") - F.col("control_rate"), F.when(~F.isnan(error), error))
    return (
        rows.withColumn("control_rate", rate("control_conversions", "control_users"))
        .withColumn("test_rate", rate("conversions", "users"))
        .withColumn("z", z)
        .select(
            "test_id",
            "group_name",
            "control_rate",
            "test_rate",
            pct_text(F.col("control_rate")).alias("control_rate_text"),
            pct_text(F.col("test_rate")).alias("test_rate_text"),
            "z",
            F.when(F.abs("z") > CRITICAL_Z, F.lit("Significant")).otherwise(F.lit("Not significant")).alias("result"),
        )
    )


def assign_groups(
    users: DataFrame, key: str, shares: dict[str, int] = DEFAULT_SHARES, seed: str = "", out: str = "group_name"
) -> DataFrame:
    """Random but repeatable split by percent shares. A row-wise hash: nothing is shuffled."""
    if sum(shares.values()) != 100:
        raise ValueError("Group percentages must add up to 100")
    slot = hash_slot(F.col(key), SLOTS, seed)
    group, upper = None, 0
    for name, share in shares.items():
        upper += share * SLOTS // 100
        group = (F if group is None else group).when(slot < upper, F.lit(name))
    return users.withColumn(out, group)


def split_in_half(users: DataFrame, key: str, seed: str = "", out: str = "team") -> DataFrame:
    """Random exact halves: team A has ``floor(n / 2)`` members, team B the others."""
    placed = global_row_number(users, key, out="_place", seed=seed, total="_n")
    team = F.when(F.col("_place") < F.floor(F.col("_n") / 2), F.lit("A")).otherwise(F.lit("B"))
    return placed.withColumn(out, team).drop("_place", "_n")
