"""What several operators share: session settings, intake of tables, words as bytes, connected components."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.plans.session import prepare as prepare_session
from cartwheel.sources.workspace import materialise, shared_root

LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
# rows that go to a Python worker at once: texts can be very long
BATCH_ROWS = 256
# rows of a few numbers each that may be sent to every executor
BROADCAST_ROWS = 500_000


def prepare(spark: SparkSession) -> SparkSession:
    prepare_session(spark)
    shared_root(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def small(table: DataFrame) -> DataFrame:
    """A written table with a broadcast hint if its rows are counted to be few; else a join deals both sides out."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges(a, b)``: columns ``node``, ``root``.

    Alternates the large-star and the small-star step; each keeps what is connected and draws edges to
    smaller nodes until every edge points at its component's smallest. Minima combine before the shuffle,
    joins by node are ordinary joins whose hot nodes the planner splits. Each round is a written table.
    """
    pairs = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        star = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        star = star.distinct()
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        joined = star.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        pairs = materialise(small.where("a != b").distinct(), "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
