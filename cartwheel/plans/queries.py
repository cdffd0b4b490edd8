"""The registered batch queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.config import RollingWindow
from cartwheel.functions import enrich
from cartwheel.functions.text import number_of
from cartwheel.operators import agents, branches, canonical, lookups, sessions
from cartwheel.operators.repeats import without_repeats
from cartwheel.operators.reshape import reshape
from cartwheel.operators.rolling import rolling_features
from cartwheel.plans import event_features as by_event
from cartwheel.plans import grid_features as by_grid
from cartwheel.plans import session_features as by_session
from cartwheel.plans.metrics import session_metrics, user_metrics
from cartwheel.plans.pipeline import located
from cartwheel.sources.table_events import shop_events_from_table
from cartwheel.sources.workspace import materialise, new_folder

Query = Callable[[SparkSession, str], DataFrame]

DAY, HOUR = 86_400, 3_600
SIZES = {"1d": DAY, "3d": 3 * DAY, "7d": 7 * DAY}
GAP = 12 * HOUR
EMIT = 6 * HOUR
TTLS = {"1d": 900, "3d": 1800, "7d": 3600}
WINDOWS = [RollingWindow(label, seconds, EMIT, TTLS[label]) for label, seconds in SIZES.items()]
SESSION_TTL = 3600
USER_KEYS = ("user_id", "event_id", "ts", "window_size")
GRID_KEYS = ("user_id", "emit_ts", "window_size")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_events_from_table(table(spark, sf_dir, "events"))


def _r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


# -- projections ------------------------------------------------------------------------------------


def event_type_filter(spark, sf):
    return branches.branch(shop(spark, sf), "session").select("event_id", "event_type", "user_id", "ts")


def canonical_user_events(spark, sf):
    return shop(spark, sf).select(
        "event_id",
        "event_type",
        "session_id",
        "user_id",
        "ts",
        F.col("user_agent.platform").alias("device"),
        F.col("enrichment.platform").alias("platform"),
        F.col("enrichment.marketing.campaign").alias("campaign"),
        "product_id",
        "product_price",
        "category",
        "cart_total",
        "cart_price",
        "step",
        "page_url",
    )


def product_view_projection(spark, sf):
    return branches.product_views(shop(spark, sf))


def category_view_projection(spark, sf):
    return branches.category_views(shop(spark, sf))


def cart_projection(spark, sf):
    return branches.cart_events(shop(spark, sf))


# -- JSON path --------------------------------------------------------------------------------------

AGENTS = {
    "Desktop": "Mozilla/5.0 (Windows NT 10.0; Win64; x64)",
    "Phone": "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Mobile/15E148",
    "Tablet": "Mozilla/5.0 (iPad; CPU OS 16_0 like Mac OS X)",
}


CONTEXT_NAMES = {
    "product": "contexts_shop_ecommerce_product_1",
    "cart": "contexts_shop_ecommerce_cart_1",
    "checkout": "contexts_shop_ecommerce_checkout_step_1",
    "action": "unstruct_event_shop_ecommerce_action_1",
}


def tracker_json(events: DataFrame) -> DataFrame:
    """The shop events as raw tracker JSON, so that reshaping and parsing run over whole tables."""
    c, kind = F.col, F.col("event_type")
    device = c("user_agent.platform")
    agent = F.when(device == "Desktop", AGENTS["Desktop"]).when(device == "Phone", AGENTS["Phone"])
    in_cart = kind.isin(schema.ADD, schema.REMOVE)
    product = F.when(kind == schema.PRODUCT_VIEW, F.struct(c("product_id").alias("id"), c("product_price").alias("price"), "category"))
    product = product.when(
        in_cart, F.struct(F.lit("x").alias("id"), c("cart_price").alias("price"), F.lit("y").alias("category"))
    )
    action = F.when(kind != schema.PAGE_VIEW, F.struct(kind.alias("type"), F.when(kind == schema.LIST_VIEW, c("category")).alias("name")))
    row = F.struct(
        "event_id",
        F.when(kind == schema.PAGE_VIEW, kind).otherwise("unstruct").alias("event"),
        F.lit("shop_ecommerce_action").alias("event_name"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("derived_tstamp"),
        c("user_id").alias("domain_userid"),
        F.lit("").alias("user_id"),
        c("session_id").alias("domain_sessionid"),
        c("enrichment.platform").alias("platform"),
        agent.otherwise(AGENTS["Tablet"]).alias("useragent"),
        c("enrichment.marketing.campaign").alias("mkt_campaign"),
        "page_url",
        F.when(product.isNotNull(), F.array(product)).alias(CONTEXT_NAMES["product"]),
        F.when(in_cart, F.array(F.struct(c("cart_total").alias("total_value")))).alias(CONTEXT_NAMES["cart"]),
        F.when(kind == schema.CHECKOUT, F.array(F.struct("step"))).alias(CONTEXT_NAMES["checkout"]),
        action.alias(CONTEXT_NAMES["action"]),
    )
    return events.select(F.to_json(row).alias("value"))


def json_path(spark, sf):
    events = canonical.canonical_events(reshape(tracker_json(shop(spark, sf)), full=False, names=CONTEXT_NAMES))
    kind = F.col("event_type")
    return events.select(
        "event_id",
        "event_type",
        "session_id",
        "user_id",
        "ts",
        F.col("user_agent.platform").alias("device"),
        F.col("enrichment.platform").alias("platform"),
        F.col("enrichment.marketing.campaign").alias("campaign"),
        F.when(kind == schema.PRODUCT_VIEW, F.col("product_id")).alias("product_id"),
        F.when(kind == schema.PRODUCT_VIEW, F.col("product_price")).alias("product_price"),
        F.when(kind.isin(schema.PRODUCT_VIEW, schema.LIST_VIEW), F.col("category")).alias("category"),
        "cart_total",
        F.when(kind.isin(schema.ADD, schema.REMOVE), F.col("cart_price")).alias("cart_price"),
        "step",
        "page_url",
    )


def reshaped_blocks(spark, sf):
    """The full reshape, with a few fields read back from its JSON text."""
    out = reshape(tracker_json(shop(spark, sf)))
    fields = {
        "event_id": "$.id",
        "event_type": "$.type",
        "platform": "$.enrich.platform",
        "domain_userid": "$.enrich.user.domain_userid",
        "mkt_campaign": "$.enrich.marketing.mkt_campaign",
        "domain_sessionid": "$.session.domain_sessionid",
        "page_url": "$.enrich.client.page.page_url",
        "list_name": "$.payload.list_name",
    }
    return out.select(*[F.get_json_object("value", path).alias(n) for n, path in fields.items()])


def _cut_in_half(spark, sf):
    """Every row whose k is a multiple of 50 arrives cut in half."""
    text = tracker_json(shop(spark, sf))
    whole = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    cut = whole.where(k % 50 == 0).select(F.col("event_id").cast("string").alias("cut_id"))
    keyed = text.withColumn("cut_id", F.get_json_object("value", "$.event_id")).join(cut.withColumn("_cut", F.lit(True)), "cut_id", "left")
    broken = keyed.select(F.when(F.col("_cut"), F.substring("value", 1, 40)).otherwise(F.col("value")).alias("value"))
    return canonical.parse_events(reshape(broken, full=False))


def bad_rows_split(spark, sf):
    parsed = _cut_in_half(spark, sf)
    return parsed.groupBy(F.coalesce(canonical.ERROR, F.lit("good")).alias("outcome")).agg(F.count("*").alias("n"))


def field_length_limit(spark, sf):
    urls = table(spark, sf, "pages").select("page_id", "url", F.lit(None).cast("string").alias(canonical.ERROR))
    return canonical.limit_lengths(urls, {"url": 45}).select("page_id", canonical.ERROR)


# -- rolling windows as of each event ---------------------------------------------------------------


def _product(spark, sf):
    return by_event.product_stats(branches.product_views(shop(spark, sf)), SIZES)


def rolling_product_unique(spark, sf):
    return _product(spark, sf).select(*USER_KEYS, "unique_product_count")


def rolling_product_price_stats(spark, sf):
    return _product(spark, sf).select(*USER_KEYS, "min_price", "max_price", "view_count")


def rolling_product_avg_first_price(spark, sf):
    return _product(spark, sf).select(*USER_KEYS, _r("average_price"))


def rolling_category_unique(spark, sf):
    out = by_event.category_stats(branches.category_views(shop(spark, sf)), SIZES)
    return out.select(*USER_KEYS, "unique_category_count")


def rolling_cart(spark, sf):
    return by_event.cart_stats(branches.cart_events(shop(spark, sf)), SIZES)


def multi_size_cart(spark, sf):
    """Own aggregates through the extension point, all sizes side by side."""
    aggs = {
        "adds": F.count_if(F.col("event_type") == schema.ADD),
        "mean_price": F.avg("product_price"),
    }
    carts = branches.cart_events(shop(spark, sf))
    out = rolling_features(carts, ["user_id"], "ts", SIZES, aggs)
    return out.select(
        "user_id", "event_id", *[f"adds_{s}" for s in SIZES], *[_r(f"mean_price_{s}") for s in SIZES]
    )


def cart_value(spark, sf):
    out = by_event.cart_values(branches.cart_events(shop(spark, sf)))
    return out.select("user_id", "event_id", "ts", _r("cart_value"))


def purchase_orders(spark, sf):
    out = by_event.purchase_orders(branches.purchase_events(shop(spark, sf)), SIZES)
    return out.withColumn("order_value", _r("order_value"))


def _purchase(spark, sf):
    return by_event.purchase_stats(branches.purchase_events(shop(spark, sf)), SIZES)


def rolling_purchase(spark, sf):
    return _purchase(spark, sf).select(*USER_KEYS, "orders_count", _r("order_value"))


def avg_order_value(spark, sf):
    return _purchase(spark, sf).select(*USER_KEYS, "avg_order_value")


# -- rolling windows at emit times ------------------------------------------------------------------


def product_views_map_long(spark, sf):
    out = by_grid.product_item_views(branches.product_views(shop(spark, sf)), WINDOWS)
    return out.select(*GRID_KEYS, "product_id", "n")


def grid_product(spark, sf):
    out = by_grid.product_grid(branches.product_views(shop(spark, sf)), WINDOWS)
    return out.select(
        *GRID_KEYS,
        "unique_product_count",
        _r("average_price"),
        "min_price",
        "max_price",
        F.size("views").alias("viewed"),
        F.coalesce(F.aggregate(F.map_values("views"), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).alias("view_count"),
    )


def category_view_count(spark, sf):
    return by_grid.category_item_views(branches.category_views(shop(spark, sf)), WINDOWS)


def grid_category_zero_rows(spark, sf):
    out = by_grid.category_grid(branches.category_views(shop(spark, sf)), WINDOWS)
    return out.select(*GRID_KEYS, "unique_category_count", "most_viewed_category", F.size("views").alias("viewed"))


def rolling_top_category(spark, sf):
    out = by_grid.category_grid(branches.category_views(shop(spark, sf)), WINDOWS, empty_rows=False)
    return out.select(*GRID_KEYS, "unique_category_count", "most_viewed_category")


def grid_cart(spark, sf):
    out = by_grid.cart_grid(branches.cart_events(shop(spark, sf)), WINDOWS, empty_rows=False)
    return out.withColumn("cart_value", _r("cart_value"))


def grid_cart_zero_rows(spark, sf):
    out = by_grid.cart_grid(branches.cart_events(shop(spark, sf)), WINDOWS)
    return out.withColumn("cart_value", _r("cart_value"))


def grid_purchase(spark, sf):
    out = by_grid.purchase_grid(branches.purchase_events(shop(spark, sf)), WINDOWS, empty_rows=False)
    return out.select(*GRID_KEYS, "orders_count", _r("order_value"), "avg_order_value")


def grid_purchase_zero_rows(spark, sf):
    out = by_grid.purchase_grid(branches.purchase_events(shop(spark, sf)), WINDOWS)
    return out.select(*GRID_KEYS, "orders_count", _r("order_value"), "avg_order_value")


# -- sessions ---------------------------------------------------------------------------------------


def _sessions(spark, sf):
    return by_session.shop_sessions(branches.session_events(shop(spark, sf)), GAP)


def session_bounds(spark, sf):
    return _sessions(spark, sf).select("session_id", "session_start", "last_ts", "close_ts", "duration_ms", "active_ms")


def session_features(spark, sf):
    return _sessions(spark, sf).select(
        "session_id",
        "session_start",
        "user_id",
        "page_views",
        "searches",
        "product_views",
        "cart_adds",
        "latest_platform",
        "bounce",
        "cart_ratio",
        _r("cart_ratio_exact"),
    )


def session_first_campaign(spark, sf):
    return _sessions(spark, sf).select("session_id", "session_start", "campaign")


def session_device_types(spark, sf):
    return _sessions(spark, sf).select("session_id", "session_start", F.posexplode("device_types").alias("place", "device"))


def session_running(spark, sf):
    out = by_session.running_sessions(branches.session_events(shop(spark, sf)), GAP)
    return out.select(
        "session_id", "session_start", "event_id", "last_ts", *by_session.COUNTS, "campaign", "latest_platform", "duration_ms"
    )


def session_custom(spark, sf):
    """Own session measures through the extension point, on the carts' prices."""
    carts = branches.cart_events(shop(spark, sf))
    measures = {"carts": ("sum", F.lit(1)), "dearest": ("max", F.col("product_price"))}
    return sessions.session_features(carts, "user_id", "ts", GAP, measures)


# -- metrics and the feature table ------------------------------------------------------------------


def _all_metrics(spark, sf):
    """Metric rows, each with the list of the times (``emit_ts``) at which it holds."""
    events = shop(spark, sf)
    grids = {
        "product": by_grid.product_held(branches.product_views(events), WINDOWS),
        "category": by_grid.category_held(branches.category_views(events), WINDOWS),
        "cart": by_grid.cart_held(branches.cart_events(events), WINDOWS),
        "purchase": by_grid.purchase_held(branches.purchase_events(events), WINDOWS),
    }
    parts = [user_metrics(df, name, TTLS) for name, df in grids.items()]
    closed = session_metrics(by_session.shop_sessions(branches.session_events(events), GAP), SESSION_TTL)
    parts.append(closed.withColumn("emit_ts", F.array("emit_ts")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def metric_long(spark, sf):
    """Numbers rounded, so that engines agree on their text; other values as they are."""
    number = number_of(F.col("value"))
    held = _all_metrics(spark, sf).select(
        "name",
        "emit_ts",
        "ttl_seconds",
        F.round(number, 4).alias("number"),
        F.when(number.isNull(), F.col("value")).alias("words"),
    )
    return by_grid.spread(held)


def _cart_metrics(spark, sf):
    carts = by_grid.cart_held(branches.cart_events(shop(spark, sf)), WINDOWS)
    return by_grid.spread(user_metrics(carts, "cart", TTLS))


def _store(spark, sf):
    """Cart metrics written to a fresh feature table in three batches, by emit time."""
    from cartwheel.sources.store import FeatureStore

    store = FeatureStore(spark, new_folder(spark, "store"), buckets=8)
    metrics = materialise(_cart_metrics(spark, sf), "metrics")
    part = F.dayofmonth("emit_ts")
    for batch, chosen in enumerate([part <= 10, (part > 10) & (part <= 20), part > 20]):
        store.upsert(metrics.where(chosen), batch)
        if batch == 1:
            # nothing is old enough to be left out
            store.compact(F.lit("1970-01-01").cast("timestamp"))
    return store


def _stored_numbers(rows: DataFrame) -> DataFrame:
    return rows.select("name", F.round(F.col("value").cast("double"), 4).alias("number"), "emit_ts", "expires_at")


def feature_store_latest(spark, sf):
    return _stored_numbers(_store(spark, sf).latest())


def feature_store_lookup(spark, sf):
    """Two metrics of every customer key that occurs as a user, as of a fixed moment."""
    users = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("u"))
    names = users.select(F.explode(F.array(*[F.concat(F.lit("user:"), "u", F.lit(f":{m}")) for m in ("cart_add_count_7d", "cart_remove_count_1d")])).alias("name"))
    return _stored_numbers(_store(spark, sf).lookup(names, F.lit("2024-01-30 00:20:00").cast("timestamp")))


# -- enrichments ------------------------------------------------------------------------------------


def campaign_from_url(spark, sf):
    fields = enrich.campaign(F.col("url"))
    return table(spark, sf, "pages").select("page_id", fields.alias("_c")).select(
        "page_id", *[F.col(f"_c.{n}").alias(f"mkt_{n}") for n in enrich.CAMPAIGN_PARAMETERS]
    )


def event_fingerprint(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.try_parse_url("url", F.lit("QUERY")).alias("q"))
    return pages.select("page_id", enrich.fingerprint(F.col("q")).alias("fingerprint"))


def lookup_left_join(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return lookups.lookup(orders, customers, ["o_custkey"])


def referer_parser(spark, sf):
    """Hosts of pages named ``blog.*`` and ``m.*`` serve as the referer list."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    known = pages.select(host.alias("host")).where(host.rlike(r"^(blog|m)\.")).distinct()
    known = known.select("host", F.when(F.col("host").startswith("blog."), "social").otherwise("search").alias("medium"), F.col("host").alias("source"))
    return lookups.referer(pages, "url", known).select("page_id", "refr_medium", "refr_source")


def with_address(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    ip = F.concat_ws(".", F.lit("10"), (k % 30).cast("string"), (F.col("user_id") % 256).cast("string"), (F.col("event_id") % 256).cast("string"))
    return events.select(F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), F.col("ts").cast("timestamp").alias("ts"), ip.alias("ip"), "event_type", "value")


def address_ranges(spark, sf):
    nation = table(spark, sf, "nation")
    narrow = nation.select(F.concat(F.lit("10."), F.col("n_nationkey").cast("string"), F.lit(".0.0/16")).alias("cidr"), F.col("n_name").alias("place"))
    second = (F.col("r_regionkey") * 8).cast("string")
    wide = table(spark, sf, "region").select(F.concat(F.lit("10."), second, F.lit(".0.0/13")).alias("cidr"), F.col("r_name").alias("place"))
    return narrow.unionByName(wide)


def ip_lookup(spark, sf):
    found = lookups.ip_lookup(with_address(table(spark, sf, "events")), "ip", address_ranges(spark, sf), ["place"])
    return found.select("event_id", "ip", "place")


def shopper_regions(spark, sf):
    found = lookups.ip_lookup(with_address(table(spark, sf, "events")), "ip", address_ranges(spark, sf), ["place"])
    out = lookups.shopper_regions(found, "user_id", "ts", "place", DAY)
    return out.select("user_id", F.array_join("shopper_locations", ",").alias("shopper_locations"), "shopper_region_changes")


def shop_with_address(shop_events: DataFrame) -> DataFrame:
    """Shop events with the addresses of ``with_address``."""
    number = lambda name: F.col(name).cast("long")
    second = F.get_json_object("payload", "$.k").cast("int") % 30
    ip = F.concat_ws(".", F.lit("10"), second.cast("string"), (number("user_id") % 256).cast("string"), (number("event_id") % 256).cast("string"))
    return shop_events.withColumn("enrichment", F.col("enrichment").withField("user.ip_address", ip))


def places(spark, sf):
    return address_ranges(spark, sf).withColumnRenamed("place", "region")


def session_locations(spark, sf):
    """Metric rows of the sessions' regions and of their changes, as the job writes them."""
    events = located(shop_with_address(shop(spark, sf)), places(spark, sf))
    return session_metrics(by_session.session_regions(branches.session_events(events), GAP), SESSION_TTL)


def _patterns(spark, *patterns):
    return spark.createDataFrame([(p,) for p in patterns], "pattern string")


# user agents for the events, by k: all device classes
LISTED_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64)",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X)",
    "Mozilla/5.0 (Linux; Android 14; SM-X700) Tablet",
    "Mozilla/5.0 (compatible; Googlebot/2.1) Linux",
    "curl/8.4.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7)",
)


def device_class_os(spark, sf):
    """Classes by the table of rules."""
    k = F.get_json_object("props", "$.k").cast("int")
    agent = F.element_at(F.array(*[F.lit(a) for a in LISTED_AGENTS]), F.coalesce(F.pmod(k, F.lit(len(LISTED_AGENTS))), F.lit(0)) + 1)
    events = table(spark, sf, "events").select("event_id", agent.alias("agent"))
    return agents.classified(events, "agent", agents.default_rules(spark)).select("event_id", "device_class", "os_name")


def events_deduplicated(spark, sf):
    """A third of the events sent twice, and a fifth of their ids used again for another event."""
    events = shop(spark, sf)
    number = F.col("event_id").cast("long")
    again = events.where(number % 3 == 0)
    other = events.where(number % 5 == 0).withColumn("page_url", F.lit("/other"))
    kept = without_repeats(events.unionByName(again).unionByName(other))
    return kept.select("event_id", "event_type", "user_id", "ts", "page_url")


def bad_rows(spark, sf):
    """The rows themselves, with their reasons."""
    found = canonical.bad_rows(_cut_in_half(spark, sf))
    return found.select(F.regexp_extract("value", '"event_id":"([0-9]+)"', 1).alias("event_id"), canonical.ERROR)


def grid_unique_approx(spark, sf):
    return by_grid.unique_products_approx(branches.product_views(shop(spark, sf)), WINDOWS)


def robot_filter(spark, sf):
    """Addresses of nations count as listed; event types play the user agents."""
    ranges = address_ranges(spark, sf).where(F.col("cidr").endswith("/16"))
    events = with_address(table(spark, sf, "events"))
    kept = lookups.without_robots(events, ip="ip", agent="event_type", ip_table=ranges, include=_patterns(spark, "CLICK", "view", "err"), exclude=_patterns(spark, "err"))
    return kept.select("event_id", "user_id")


def currency_conversion(spark, sf):
    """Event types play the currencies, their daily highest values the rates."""
    events = with_address(table(spark, sf, "events"))
    day = F.to_date("ts")
    rates = events.groupBy(F.col("event_type").alias("currency"), day.alias("rate_date")).agg(F.max("value").alias("rate"))
    out = lookups.convert_currency(events, "value", "event_type", "ts", rates, base="signup")
    return out.select("event_id", F.round("amount_base", 4).alias("amount_base"))


def pii_pseudonym(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", enrich.pseudonym(F.col("c_name"), "salty").alias("pseudonym"))


def ip_anonymous(spark, sf):
    return with_address(table(spark, sf, "events")).select("event_id", enrich.anonymous_ip(F.col("ip")).alias("ip"))


BATCH: dict[str, Query] = {
    f.__name__: f
    for f in (
        event_type_filter,
        canonical_user_events,
        product_view_projection,
        category_view_projection,
        cart_projection,
        json_path,
        reshaped_blocks,
        bad_rows_split,
        field_length_limit,
        rolling_product_unique,
        rolling_product_price_stats,
        rolling_product_avg_first_price,
        rolling_category_unique,
        rolling_cart,
        multi_size_cart,
        cart_value,
        purchase_orders,
        rolling_purchase,
        avg_order_value,
        product_views_map_long,
        grid_product,
        category_view_count,
        grid_category_zero_rows,
        rolling_top_category,
        grid_cart,
        grid_cart_zero_rows,
        grid_purchase,
        grid_purchase_zero_rows,
        session_bounds,
        session_features,
        session_first_campaign,
        session_device_types,
        session_running,
        session_custom,
        metric_long,
        feature_store_latest,
        feature_store_lookup,
        campaign_from_url,
        event_fingerprint,
        lookup_left_join,
        referer_parser,
        ip_lookup,
        shopper_regions,
        session_locations,
        robot_filter,
        device_class_os,
        events_deduplicated,
        bad_rows,
        grid_unique_approx,
        currency_conversion,
        pii_pseudonym,
        ip_anonymous,
    )
}
