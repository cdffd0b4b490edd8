"""JSON events (column ``value``) to canonical shop events, each row parsed once for all branches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.functions.useragent import user_agent
from cartwheel.functions.variants import get, is_number, is_text, number, parsed_once, present, text, text_or_empty

AMOUNT_LIMIT = 1e19
"""Amounts are summed as decimals with room for twelve places, ten million of this size in a total; larger ones make a bad row."""

ERROR = "parse_error"
MARKETING_FIELDS = ("campaign", "source", "medium", "term", "content")


def parse_events(raw: DataFrame) -> DataFrame:
    """Canonical columns plus ``value`` and ``parse_error`` (null for good rows)."""
    v = F.col("v")
    parsed = raw.select("value", parsed_once(v=F.try_parse_json("value")))
    picked = parsed.select(
        "value",
        v.isNull().alias("_malformed"),
        text_or_empty(v, "$.id").alias("event_id"),
        text_or_empty(v, "$.type").alias("event_type"),
        _first_text(v, "$.session.sessionId", "$.session.domain_sessionid").alias("session_id"),
        _first_text(v, "$.enrich.user.user_id", "$.enrich.user.domain_userid").alias("user_id"),
        _to_millis(F.try_to_timestamp(text(v, "$.timestamp"))).alias("ts"),
        F.to_json(get(v, "$.payload")).alias("payload"),
        user_agent(text_or_empty(v, "$.enrich.client.useragent")).alias("user_agent"),
        enrichment(v).alias("enrichment"),
        text_or_empty(v, "$.payload.product.id").alias("product_id"),
        product_price(v).alias("product_price"),
        category(v).alias("category"),
        number(get(v, "$.payload.cart.total_value")).alias("cart_total"),
        number(get(v, "$.payload.product.price")).alias("cart_price"),
        number(get(v, "$.payload.checkout_step.step")).try_cast("int").alias("step"),
        F.when(is_text(get(v, "$.payload.page_url")), text(v, "$.payload.page_url")).alias("page_url"),
    )
    return picked.withColumn(ERROR, parse_error()).drop("_malformed")


def _first_text(v: Column, *paths: str) -> Column:
    return F.coalesce(*[F.nullif(text(v, p), F.lit("")) for p in paths], F.lit(""))


def _to_millis(ts: Column) -> Column:
    return F.timestamp_millis(F.unix_millis(ts))


def enrichment(v: Column) -> Column:
    given = get(v, "$.enrich.marketing")
    fields = F.struct(*[text_or_empty(given, f"$.mkt_{n}").alias(n) for n in MARKETING_FIELDS])
    ip = _first_text(v, "$.enrich.user.ipAddress", "$.enrich.user.ip_address")
    return F.struct(
        text_or_empty(v, "$.enrich.platform").alias("platform"),
        F.when(present(given), fields).alias("marketing"),
        F.struct(ip.alias("ip_address")).alias("user"),
    )


def product_price(v: Column) -> Column:
    """Only a JSON number is a price here; text is not."""
    price = get(v, "$.payload.product.price")
    return F.when(is_number(price), F.try_variant_get(price, "$", "double")).otherwise(0.0)


def category(v: Column) -> Column:
    """A list name counts when its key is there, even as null; then the product's category; else null."""
    list_name, product = get(v, "$.payload.list_name"), get(v, "$.payload.product")
    return F.when(list_name.isNotNull(), text_or_empty(list_name)).when(
        product.isNotNull(), text_or_empty(product, "$.category")
    )


def parse_error() -> Column:
    in_cart = F.col("event_type").isin(schema.ADD, schema.REMOVE)
    amounts = ("product_price", "cart_total", "cart_price")
    too_large = F.lit(False)
    for name in amounts:
        fits = F.coalesce(F.abs(F.col(name)) < AMOUNT_LIMIT, F.lit(True)) & ~F.isnan(F.coalesce(name, F.lit(0.0)))
        too_large = too_large | ~fits
    return (
        F.when(F.col("_malformed"), "malformed JSON")
        .when(F.col("ts").isNull(), "no event time")
        .when(in_cart & (F.col("cart_total").isNull() | F.col("cart_price").isNull()), "cart event without amounts")
        .when(too_large, "amount out of range")
    )


def limit_lengths(parsed: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text field longer than allowed become bad rows."""
    error = F.col(ERROR)
    for name, most in limits.items():
        error = F.coalesce(error, F.when(F.length(name) > most, f"{name} longer than {most}"))
    return parsed.withColumn(ERROR, error)


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(ERROR).isNull()).select(*schema.SHOP_EVENT.names)


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(ERROR).isNotNull()).select("value", ERROR)


def canonical_events(raw: DataFrame) -> DataFrame:
    return good_rows(parse_events(raw))
