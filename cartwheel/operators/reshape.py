"""Raw tracker events to the JSON the feature job reads.

A raw event is one JSON object: flat fields, arrays of context objects, and possibly an ecommerce action.
Context fields are read by the exact names that the job is configured with: two publishers can use the same ending,
and a name is a path, where an ending asks for every field. Without names they are found by the start and
end, the first of them if there are several. Missing fields stay missing and explicit nulls stay null, as the
parser tells them apart.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.variants import (
    elements,
    empty_object,
    get,
    if_truthy,
    null_value,
    object_of,
    parsed_once,
    text,
    truthy,
)

# Name endings of the contexts read, and of the ecommerce action.
CONTEXTS = {
    "product": "_ecommerce_product_1",
    "cart": "_ecommerce_cart_1",
    "checkout": "_ecommerce_checkout_step_1",
    "promotion": "_ecommerce_promotion_1",
    "specification": "_event_specification_1",
    "browser": "_browser_context_2",
    "timing": "_performance_navigation_timing_1",
    "session": "_client_session_1",
}
CONTEXT_START = "contexts_"
ACTION_START, ACTION_END = "unstruct_event_", "_ecommerce_action_1"
ACTION_EVENT_NAME_END = "ecommerce_action"
MARKETING_START = "mkt_"
METADATA_FIELDS = (
    "event_version",
    "event_format",
    "event_fingerprint",
    "event_vendor",
    "app_id",
    "etl_tstamp",
    "collector_tstamp",
    "v_tracker",
    "v_collector",
    "v_etl",
    "name_tracker",
)
DEVICE_FIELDS = {
    "created_tstamp": "dvce_created_tstamp",
    "sent_tstamp": "dvce_sent_tstamp",
    "screen_width": "dvce_screenwidth",
    "screen_height": "dvce_screenheight",
    "os_timezone": "os_timezone",
}


def reshape(raw: DataFrame, full: bool = True, names: Mapping[str, str] | None = None) -> DataFrame:
    """``value`` in, ``value`` out. ``full=False`` leaves out the blocks the feature job never reads.

    ``names``: field name per key of ``CONTEXTS``, and of the ``action``; a key without a name is never there.
    """
    contexts = _found(raw) if names is None else _named(raw, names)
    typed = contexts.select("*", event_type().alias("kind"), merged_products().alias("products"))
    v = F.col("v")
    client = {"useragent": get(v, "$.useragent")}
    if full:
        client |= {"browser": browser(), "device": device(), "page": page()}
    enrich = {
        "client": _struct(**client),
        "user": user(),
        "marketing": marketing(),
        "platform": get(v, "$.platform"),
    }
    if full:
        enrich["performance"] = _first_item("c_timing")
    body = {
        "id": get(v, "$.event_id"),
        "type": F.col("kind"),
        "timestamp": event_timestamp(),
        "payload": payload(),
        "enrich": _struct(**enrich),
        "session": session(),
    }
    if full:
        body["metadata"] = _struct(**{n: get(v, f"$.{n}") for n in METADATA_FIELDS})
    # text that is no JSON goes on as it is, for the parser to set aside
    return typed.select(F.when(v.isNull(), F.col("value")).otherwise(F.to_json(_struct(**body))).alias("value"))


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


ACTION = "action"


def _found(raw: DataFrame) -> DataFrame:
    """Contexts and action by the start and end of their names: every field of a row is asked."""
    named = F.map_filter(
        F.from_json("value", "map<string,variant>"),
        lambda k, _: k.startswith(MARKETING_START)
        | k.startswith(CONTEXT_START)
        | (k.startswith(ACTION_START) & k.endswith(ACTION_END)),
    )
    parsed = raw.select("value", parsed_once(v=F.try_parse_json("value"), m=named))
    return parsed.select(
        "v",
        "value",
        _marketing("m"),
        *[_by_name(CONTEXT_START, end).alias(f"c_{name}") for name, end in CONTEXTS.items()],
        _first_or_self(_by_name(ACTION_START, ACTION_END)).alias(ACTION),
    )


def _named(raw: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Contexts and action by their names; all fields are read of rows with marketing fields only."""
    marketed = F.exists(F.json_object_keys("value"), lambda k: k.startswith(MARKETING_START))
    fields = F.when(marketed, F.from_json("value", "map<string,variant>"))
    parsed = raw.select("value", parsed_once(v=F.try_parse_json("value"), m=fields))

    def field(key: str) -> Column:
        return get(F.col("v"), f"$.{names[key]}") if key in names else F.lit(None).cast("variant")

    return parsed.select("v", "value", _marketing("m"), *[field(name).alias(f"c_{name}") for name in CONTEXTS], _first_or_self(field(ACTION)).alias(ACTION))


def _marketing(fields: str) -> Column:
    return F.map_filter(fields, lambda k, _: k.startswith(MARKETING_START)).alias("marketing")


def _by_name(start: str, end: str) -> Column:
    found = F.map_filter("m", lambda k, _: k.startswith(start) & k.endswith(end))
    return F.try_element_at(F.map_values(found), F.lit(1))


def _first_or_self(v: Column) -> Column:
    """An action comes as an object or as an array holding it."""
    return F.when(F.is_variant_null(v), None).otherwise(F.coalesce(if_truthy(get(v, "$[0]")), if_truthy(get(v, "$"))))


def _first_item(context: str) -> Column:
    return F.coalesce(if_truthy(get(F.col(context), "$[0]")), empty_object())


def event_timestamp() -> Column:
    v = F.col("v")
    return F.coalesce(if_truthy(get(v, "$.derived_tstamp")), get(v, "$.collector_tstamp"))


def event_type() -> Column:
    v = F.col("v")
    event = text(v, "$.event")
    is_action = (event == "unstruct") & text(v, "$.event_name").endswith(ACTION_EVENT_NAME_END)
    kind = get(F.col("action"), "$.type")
    return (
        F.when(event == "page_view", "page_view")
        .when(is_action, F.when(truthy(kind), text(kind)).otherwise("unknown_ecommerce"))
        .when(truthy(get(v, "$.event")), event)
        .otherwise("unknown")
    )


def merged_products() -> Column:
    return F.concat(elements(F.col("c_product")), elements(get(F.col("action"), "$.products")))


def structured_event() -> Column:
    v = F.col("v")
    parts = {n: if_truthy(get(v, f"$.se_{n}")) for n in ("category", "action", "label", "property")}
    parts["value"] = get(v, "$.se_value")
    some = parts["value"].isNotNull()
    for c in parts.values():
        some = some | c.isNotNull()
    return F.when(some, _struct(**parts))


def payload() -> Column:
    v, kind = F.col("v"), F.col("kind")

    def only(value: Column, *kinds: str) -> Column:
        return F.when(kind.isin(*kinds), value)

    first_product = F.try_element_at("products", F.lit(1))
    product = F.coalesce(if_truthy(first_product), empty_object())
    carts = ("add_to_cart", "remove_from_cart")
    lists = ("list_view", "list_click")
    return _struct(
        se_data=structured_event(),
        page_title=only(get(v, "$.page_title"), "page_view"),
        page_url=only(get(v, "$.page_url"), "page_view"),
        referrer=only(get(v, "$.page_referrer"), "page_view"),
        product=only(product, "product_view", *carts),
        cart=only(_first_item("c_cart"), "checkout_step", *carts),
        checkout_step=only(_first_item("c_checkout"), "checkout_step"),
        products=only(F.col("products"), *lists),
        list_name=only(F.coalesce(get(F.col("action"), "$.name"), null_value()), *lists),
        promotion=only(_first_item("c_promotion"), "promo_view", "promo_click"),
        specification=get(F.col("c_specification"), "$[0]"),
    )


def browser() -> Column:
    v = F.col("v")

    def by(w: str, h: str) -> Column:
        width, height = get(v, f"$.{w}"), get(v, f"$.{h}")
        return F.when(truthy(width) & truthy(height), F.concat_ws("x", text(width), text(height)))

    own = object_of(
        viewport=by("br_viewwidth", "br_viewheight"),
        resolution=by("dvce_screenwidth", "dvce_screenheight"),
        color_depth=get(v, "$.br_colordepth"),
        cookies_enabled=get(v, "$.br_cookies"),
        language=get(v, "$.br_lang"),
    )
    return F.coalesce(get(F.col("c_browser"), "$[0]"), own)


def user() -> Column:
    v = F.col("v")
    ids = {n: get(v, f"$.{n}") for n in ("user_id", "domain_userid", "network_userid")}
    return _struct(**ids, ip_address=get(v, "$.user_ipaddress"))


def page() -> Column:
    return _struct(**{n: get(F.col("v"), f"$.{n}") for n in ("page_url", "page_title", "page_referrer")})


def device() -> Column:
    return _struct(**{n: get(F.col("v"), f"$.{field}") for n, field in DEVICE_FIELDS.items()})


def marketing() -> Column:
    """Every field whose name starts like a marketing field; null when there is none."""
    fields = F.col("marketing")
    return F.when(F.size(fields) > 0, F.to_variant_object(fields)).otherwise(null_value())


def session() -> Column:
    v = F.col("v")
    own = object_of(
        domain_sessionid=get(v, "$.domain_sessionid"), domain_sessionidx=get(v, "$.domain_sessionidx")
    )
    return F.coalesce(get(F.col("c_session"), "$[0]"), own)
