"""The whole job: events in, feature table out, as one batch run or as streaming queries.

Events are parsed once, and once per event sent, into a canonical table, and the branches read narrow columns of it. In a stream that table is
written by a query of its own and read as a stream by one query per branch, each with its own checkpoint and all
window sizes of the branch in one state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cartwheel import schema
from cartwheel.config import CHECKPOINT_INTERVAL, WATERMARK_DELAY, FeatureConfig, RollingWindow
from cartwheel.operators import branches, canonical, lookups
from cartwheel.operators.repeats import without_repeats
from cartwheel.operators.reshape import reshape
from cartwheel.plans import grid_features, session_features
from cartwheel.plans.metrics import session_metrics, user_metrics
from cartwheel.plans.session import prepare, prepare_streaming
from cartwheel.sources.events import with_event_time
from cartwheel.sources.store import FeatureStore
from cartwheel.sources.workspace import make_folder, materialise
from cartwheel.streaming import open_sessions, panes

BATCH_FEATURES: dict[str, tuple[Callable, Callable]] = {
    "product": (branches.product_views, grid_features.product_grid),
    "category": (branches.category_views, grid_features.category_grid),
    "cart": (branches.cart_events, grid_features.cart_grid),
    "purchase": (branches.purchase_events, grid_features.purchase_grid),
}
STREAM_FEATURES: dict[str, Callable] = {
    "product": panes.product_features,
    "category": panes.category_features,
    "cart": panes.cart_features,
    "purchase": panes.purchase_features,
}


def parse(raw: DataFrame, reshaped: bool = True, contexts: Mapping[str, str] | None = None) -> DataFrame:
    """Parsed rows of JSON text; ``reshaped=False`` when ``raw`` still holds tracker events."""
    return canonical.parse_events(raw if reshaped else reshape(raw, full=False, names=contexts or None))


# what the branches and the bad rows need of a parsed event; the raw text of bad rows only
CANONICAL = [n for n in schema.SHOP_EVENT.names if n != "payload"]


def canonical_table(parsed: DataFrame) -> DataFrame:
    bad = F.col(canonical.ERROR).isNotNull()
    return parsed.select(*CANONICAL, canonical.ERROR, F.when(bad, F.col("value")).alias("value"), bad.alias("bad"))


def good(table: DataFrame) -> DataFrame:
    return table.where("NOT bad").select(*CANONICAL)


def bad(table: DataFrame) -> DataFrame:
    return table.where("bad").select("value", canonical.ERROR)


def jobs(config: FeatureConfig) -> dict[str, tuple[str, tuple[RollingWindow, ...]]]:
    """Name of each rolling job to its branch and windows."""
    return {branch: (branch, config.windows(branch)) for branch in BATCH_FEATURES if config.windows(branch)}


def _metrics(features: DataFrame, branch: str, windows: tuple[RollingWindow, ...]) -> DataFrame:
    return user_metrics(features, branch, {w.label: w.ttl_seconds for w in windows})


def located(events: DataFrame, places: DataFrame | None) -> DataFrame:
    """Events with the ``region`` of their address; ``places``: cidr, region. Without them as they are."""
    return events if places is None else lookups.with_region(events, F.col("enrichment.user.ip_address"), places, "region")


def batch_metrics(events: DataFrame, config: FeatureConfig, places: DataFrame | None = None) -> dict[str, DataFrame]:
    """Metric rows per job, sessions included, with locations where ``places`` are given."""
    out = {}
    for name, (branch, windows) in jobs(config).items():
        project, features = BATCH_FEATURES[branch]
        out[name] = _metrics(features(project(events), windows), branch, windows)
    rows, gap, ttl = branches.session_events(located(events, places)), config.session.gap_seconds, config.session.ttl_seconds
    out["session"] = session_metrics(session_features.shop_sessions(rows, gap), ttl)
    if places is not None:
        out["session"] = out["session"].unionByName(session_metrics(session_features.session_regions(rows, gap), ttl))
    return out


def stream_metrics(events: DataFrame, config: FeatureConfig, places: DataFrame | None = None) -> dict[str, DataFrame]:
    """Sessions are among the metrics while they are open, and once more when they close."""
    out = {}
    for name, (branch, windows) in jobs(config).items():
        out[name] = _metrics(STREAM_FEATURES[branch](events, windows), branch, windows)
    sessions = open_sessions.session_features(located(events, places), config.session.gap_seconds, config.session.emit_seconds)
    out["session"] = session_metrics(sessions, config.session.ttl_seconds, "as_of")
    return out


def stores(spark: SparkSession, path: str, config: FeatureConfig, buckets: int = 64) -> dict[str, FeatureStore]:
    """One feature table per job, as each numbers its batches by itself."""
    return {name: FeatureStore(spark, f"{path}/{name}", buckets) for name in [*jobs(config), "session"]}


def lookup(kept: dict[str, FeatureStore], names: Sequence[str] | DataFrame, as_of: Column) -> DataFrame:
    """Live values of metric names, whichever job wrote them."""
    parts = [store.lookup(names, as_of) for store in kept.values()]
    return reduce(DataFrame.unionByName, parts)


def run_batch(
    raw: DataFrame,
    config: FeatureConfig,
    store_path: str,
    bad_path: str | None = None,
    run: str | None = None,
    reshaped: bool = True,
    places: DataFrame | None = None,
) -> dict[str, FeatureStore]:
    """``run`` names this run: repeated under the same name it supersedes itself, any other run adds."""
    spark = prepare(raw.sparkSession)
    run = run or uuid.uuid4().hex
    table = materialise(without_repeats(canonical_table(parse(raw, reshaped, config.contexts))), "canonical")
    if bad_path:
        bad(table).write.mode("append").json(bad_path)
    kept = stores(spark, store_path, config)
    for name, metrics in batch_metrics(good(table), config, places).items():
        kept[name].upsert(metrics, 0, run)
    return kept


def stream_run(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of a checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def _upserting(store: FeatureStore, checkpoint: str, also: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    def upsert(metrics: DataFrame, batch_id: int) -> None:
        if also is not None:
            metrics = metrics.persist()  # computed once for both
            also(metrics, batch_id)
        store.upsert(metrics, batch_id, stream_run(store.spark, checkpoint))
        metrics.unpersist()

    return upsert


def run_stream(
    raw: DataFrame,
    config: FeatureConfig,
    store_path: str,
    checkpoint: str,
    bad_path: str | None = None,
    reshaped: bool = True,
    delay: str = WATERMARK_DELAY,
    once: bool = False,
    late_path: str | None = None,
    also: Callable[[DataFrame, int], None] | None = None,
    places: DataFrame | None = None,
) -> list[StreamingQuery]:
    """Start the queries; ``once`` works off what is there and stops.

    The first query parses into the stream table ``{checkpoint}/events``, the others read that. ``late_path`` gets the
    rows behind the watermark, with whether all windows have missed them. ``also`` gets each batch of metrics besides
    the feature table, such as ``sinks.external_store_writer``. ``places`` (cidr, region) adds the metrics of locations.
    """
    spark = prepare_streaming(raw.sparkSession)
    trigger = {"availableNow": True} if once else {"processingTime": CHECKPOINT_INTERVAL}
    parsed, path = without_repeats(canonical_table(parse(raw, reshaped, config.contexts))), f"{checkpoint}/events"
    make_folder(spark, path)

    def start(df: DataFrame, name: str, sink: Callable[[DataStreamWriter], DataStreamWriter]) -> StreamingQuery:
        writer = df.writeStream.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}").outputMode("append")
        return sink(writer).trigger(**trigger).start()

    def files(kind: str, folder: str, *partitions: str) -> Callable[[DataStreamWriter], DataStreamWriter]:
        return lambda writer: writer.format(kind).option("path", folder).partitionBy(*partitions)

    queries = [start(parsed, "parse", files("parquet", path, "bad"))]
    if once:
        queries[0].awaitTermination()
    table = spark.readStream.schema(parsed.schema).parquet(path)
    events = with_event_time(good(table), delay=delay)
    kept = stores(spark, store_path, config)
    for name, metrics in stream_metrics(events, config, places).items():
        upsert = _upserting(kept[name], f"{checkpoint}/{name}-metrics", also)
        queries.append(start(metrics, f"{name}-metrics", lambda writer, upsert=upsert: writer.foreachBatch(upsert)))
    if bad_path:
        queries.append(start(bad(table), "bad-rows", files("json", bad_path)))
    if late_path:
        windows = [w for _, of_branch in jobs(config).values() for w in of_branch]
        queries.append(start(panes.late_rows(events, windows), "late-rows", files("json", late_path)))
    return queries
