"""Device class and operating system of user agents by a table of ranked rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.useragent import DEVICE_MARKS, OS_MARKS, ROBOT_MARKS, UNKNOWN
from cartwheel.operators.matching import matches

RULE = "kind string, rank int, mark string, result string"
DEVICE, SYSTEM = "device", "system"


def default_rules(spark: SparkSession) -> DataFrame:
    """The marks of the parse as a table; robots come before devices."""
    devices = [*[(m, "Robot") for m in ROBOT_MARKS], *DEVICE_MARKS]
    rows = [(kind, rank, mark, result) for kind, marks in ((DEVICE, devices), (SYSTEM, OS_MARKS)) for rank, (mark, result) in enumerate(marks)]
    return spark.createDataFrame(rows, RULE)


def classified(events: DataFrame, agent: str, rules: DataFrame) -> DataFrame:
    """``device_class`` and ``os_name``: of the rules that an agent meets, the one of the lowest rank.

    Rules are held against distinct agents, and the result is joined back. Equal ranks go by the mark.
    """
    found = matches(events, agent, rules, "mark")
    first = F.struct("rank", "mark")

    def best(kind: str) -> Column:
        of_kind = F.col("kind") == kind
        return F.min_by(F.when(of_kind, F.col("result")), F.when(of_kind, first))

    known = found.groupBy(F.col("_text").alias("_agent")).agg(best(DEVICE).alias("_device"), best(SYSTEM).alias("_system"))
    joined = events.join(known, F.col(agent) == F.col("_agent"), "left")
    return joined.select(*events.columns, F.coalesce("_device", F.lit(UNKNOWN)).alias("device_class"), F.coalesce("_system", F.lit(UNKNOWN)).alias("os_name"))
