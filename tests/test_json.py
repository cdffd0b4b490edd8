"""Reshaping and parsing: every quirk of the JSON path."""

import json

import pytest

from pyspark.sql import functions as F

from cartwheel.operators.canonical import bad_rows, canonical_events, good_rows, limit_lengths, parse_events
from cartwheel.operators.reshape import reshape

BASE = {"event_id": "e", "derived_tstamp": "2024-01-01T00:00:00.123Z", "event": "unstruct", "event_name": "shop_ecommerce_action"}
ACTION = "unstruct_event_shop_ecommerce_action_1"
PRODUCTS = "contexts_shop_ecommerce_product_1"
CART = "contexts_shop_ecommerce_cart_1"


def lines(spark, *objects):
    rows = [(o if isinstance(o, str) else json.dumps(o),) for o in objects]
    return spark.createDataFrame(rows, "value string").coalesce(1)


def reshaped(spark, **fields):
    return json.loads(reshape(lines(spark, {**BASE, **fields})).first().value)


def test_event_types(spark):
    cases = [
        ({"event": "page_view"}, "page_view"),
        ({ACTION: {"type": "list_view"}}, "list_view"),
        ({ACTION: [{"type": "product_view"}]}, "product_view"),
        ({ACTION: {"type": ""}}, "unknown_ecommerce"),
        ({}, "unknown_ecommerce"),
        ({"event_name": "other"}, "unstruct"),
        ({"event": "struct"}, "struct"),
        ({"event": ""}, "unknown"),
        ({"event": None}, "unknown"),
    ]
    out = reshape(lines(spark, *[{**BASE, **c} for c, _ in cases])).collect()
    assert [json.loads(r.value)["type"] for r in out] == [want for _, want in cases]


def test_timestamp_falls_back_when_empty(spark):
    assert reshaped(spark, derived_tstamp="", collector_tstamp="c")["timestamp"] == "c"
    assert reshaped(spark, collector_tstamp="c")["timestamp"] == BASE["derived_tstamp"]


def test_products_merge_in_order(spark):
    out = reshaped(spark, **{ACTION: {"type": "list_click", "products": [{"id": "b"}]}, PRODUCTS: [{"id": "a"}]})
    assert out["payload"] == {"products": [{"id": "a"}, {"id": "b"}], "list_name": None}


def test_payloads(spark):
    assert reshaped(spark, **{ACTION: {"type": "product_view"}})["payload"] == {"product": {}}
    add = {ACTION: {"type": "add_to_cart"}, PRODUCTS: [{"id": "a", "price": 2}], CART: [{"total_value": 5}, {"total_value": 6}]}
    assert reshaped(spark, **add)["payload"] == {"product": {"id": "a", "price": 2}, "cart": {"total_value": 5}}
    step = {ACTION: {"type": "checkout_step"}, "contexts_shop_ecommerce_checkout_step_1": [{"step": 2}]}
    assert reshaped(spark, **step)["payload"] == {"checkout_step": {"step": 2}, "cart": {}}
    promo = {ACTION: {"type": "promo_view"}, "contexts_shop_ecommerce_promotion_1": [{"id": "x"}]}
    assert reshaped(spark, **promo)["payload"] == {"promotion": {"id": "x"}}
    page = reshaped(spark, event="page_view", page_title="t", page_url=None)
    assert page["payload"] == {"page_title": "t", "page_url": None}
    spec = reshaped(spark, event="page_view", contexts_any_event_specification_1=[{"id": "s"}])
    assert spec["payload"] == {"specification": {"id": "s"}}


def test_structured_event_block(spark):
    out = reshaped(spark, event="struct", se_category="c", se_action="", se_label=None, se_value=0)
    assert out["payload"]["se_data"] == {"category": "c", "value": 0}
    assert "se_data" not in reshaped(spark, event="struct", se_action="")["payload"]


def test_contexts_and_their_fallbacks(spark):
    out = reshaped(
        spark,
        br_viewwidth=10,
        br_viewheight=20,
        dvce_screenwidth=0,
        dvce_screenheight=5,
        br_cookies=True,
        br_lang="en",
        dvce_created_tstamp="d",
        os_timezone="z",
        page_url="u",
        user_id="me",
        user_ipaddress="1.2.3.4",
        mkt_source="s",
        mkt_term=None,
        domain_sessionid="ds",
        domain_sessionidx=3,
        app_id="app",
        v_etl="1",
    )
    assert out["enrich"]["client"]["browser"] == {"viewport": "10x20", "cookies_enabled": True, "language": "en"}
    assert out["enrich"]["client"]["device"] == {"created_tstamp": "d", "screen_width": 0, "screen_height": 5, "os_timezone": "z"}
    assert out["enrich"]["client"]["page"] == {"page_url": "u"}
    assert out["enrich"]["user"] == {"user_id": "me", "ip_address": "1.2.3.4"}
    assert out["enrich"]["marketing"] == {"mkt_source": "s", "mkt_term": None}
    assert out["enrich"]["performance"] == {}
    assert out["session"] == {"domain_sessionid": "ds", "domain_sessionidx": 3}
    assert out["metadata"] == {"app_id": "app", "v_etl": "1"}
    own = reshaped(
        spark,
        contexts_x_browser_context_2=[{"viewport": "1x1"}],
        contexts_org_performance_navigation_timing_1=[{"t": 1}],
        contexts_x_client_session_1=[{"sessionId": "S"}],
    )
    assert own["enrich"]["client"]["browser"] == {"viewport": "1x1"}
    assert own["enrich"]["performance"] == {"t": 1}
    assert own["session"] == {"sessionId": "S"}
    assert own["enrich"]["marketing"] is None


def event(kind="page_view", payload=None, user=None, **more):
    enrich = {"user": user if user is not None else {"user_id": "u"}, "platform": "web"} | more.pop("enrich", {})
    return {"id": "1", "type": kind, "timestamp": "2024-01-01T00:00:00.123456Z", "payload": payload or {}, "enrich": enrich, "session": {}} | more


def parsed(spark, **kwargs):
    return parse_events(lines(spark, event(**kwargs))).first()


@pytest.mark.parametrize(
    "user, want",
    [
        ({"user_id": "u", "domain_userid": "d"}, "u"),
        ({"user_id": "", "domain_userid": "d"}, "d"),
        ({"user_id": None, "domain_userid": "d"}, "d"),
        ({"domain_userid": "d"}, "d"),
        ({}, ""),
    ],
)
def test_user_falls_back(spark, user, want):
    assert parsed(spark, user=user).user_id == want


def test_session_and_address_under_both_names(spark):
    assert parsed(spark, session={"sessionId": "a", "domain_sessionid": "b"}).session_id == "a"
    assert parsed(spark, session={"domain_sessionid": "b"}).session_id == "b"
    assert parsed(spark, user={"ip_address": "9"}).enrichment.user.ip_address == "9"
    assert parsed(spark, user={"ipAddress": "8", "ip_address": "9"}).enrichment.user.ip_address == "8"


def test_marketing(spark):
    assert parsed(spark).enrichment.marketing is None
    assert parsed(spark, enrich={"marketing": None}).enrichment.marketing is None
    assert parsed(spark, enrich={"marketing": {"mkt_campaign": "c"}}).enrichment.marketing.asDict() == {
        "campaign": "c", "source": "", "medium": "", "term": "", "content": "",
    }
    assert parsed(spark, enrich={"marketing": {"mkt_source": "s"}}).enrichment.marketing.campaign == ""


def test_time_in_milliseconds(spark):
    assert parsed(spark).ts.microsecond == 123000


@pytest.mark.parametrize(
    "price, as_product, as_cart", [(2.5, 2.5, 2.5), (3, 3.0, 3.0), ("4.5", 0.0, 4.5), ("x", 0.0, 0.0), (None, 0.0, 0.0)]
)
def test_prices(spark, price, as_product, as_cart):
    r = parsed(spark, kind="product_view", payload={"product": {"id": "p", "price": price}})
    assert (r.product_price, r.cart_price) == (as_product, as_cart)


@pytest.mark.parametrize(
    "payload, want",
    [
        ({"list_name": "l", "product": {"category": "c"}}, "l"),
        ({"list_name": None, "product": {"category": "c"}}, ""),
        ({"product": {"category": "c"}}, "c"),
        ({"product": {}}, ""),
        ({}, None),
    ],
)
def test_category(spark, payload, want):
    assert parsed(spark, kind="product_view", payload=payload).category == want


@pytest.mark.parametrize("step, want", [({"step": 2}, 2), ({"step": "2"}, 2), ({"step": 2.7}, 2), ({}, None), (None, None)])
def test_step(spark, step, want):
    r = parsed(spark, kind="checkout_step", payload={"checkout_step": step})
    assert r.step == want and r.parse_error is None


def test_page_url_must_be_text(spark):
    assert parsed(spark, payload={"page_url": "/search?q=1"}).page_url == "/search?q=1"
    assert parsed(spark, payload={"page_url": 5}).page_url is None


def test_good_and_bad_rows(spark):
    cart = {"cart": {"total_value": 1}, "product": {"price": 2}}
    rows = lines(
        spark,
        event(),
        event("add_to_cart", cart),
        '{"id": "1", "ty',
        event(timestamp="yesterday"),
        event(timestamp=None),
        event("add_to_cart", {"cart": {}, "product": {"price": 2}}),
        event("remove_from_cart", {"cart": {"total_value": 1}}),
        event("add_to_cart", {"cart": {"total_value": 1e300}, "product": {"price": 2}}),
        event("add_to_cart", {"cart": {"total_value": 2e15}, "product": {"price": 9e18}}),
    )
    out = parse_events(rows)
    assert good_rows(out).count() == 3
    assert sorted(r.parse_error for r in bad_rows(out).collect()) == [
        "amount out of range",
        "cart event without amounts",
        "cart event without amounts",
        "malformed JSON",
        "no event time",
        "no event time",
    ]


def test_long_fields_make_bad_rows(spark):
    out = limit_lengths(parse_events(lines(spark, event(), event(user={"user_id": "x" * 300}))), {"user_id": 255})
    assert [r.parse_error for r in bad_rows(out).collect()] == ["user_id longer than 255"]


def test_json_is_parsed_once(spark):
    """Filters on parsed fields must not be pushed below the parse and repeat it."""
    events = canonical_events(lines(spark, event())).where("event_type = 'page_view'").select("event_id")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


NAMES = {
    "product": PRODUCTS,
    "cart": CART,
    "checkout": "contexts_shop_ecommerce_checkout_step_1",
    "promotion": "contexts_shop_ecommerce_promotion_1",
    "specification": "contexts_any_event_specification_1",
    "browser": "contexts_x_browser_context_2",
    "timing": "contexts_org_performance_navigation_timing_1",
    "session": "contexts_x_client_session_1",
    "action": ACTION,
}


def test_exact_names_equal_endings(spark):
    """With one publisher both give the same; of two publishers only the one that is named counts."""
    from cartwheel.operators.reshape import reshape

    rows = [
        {**BASE, ACTION: {"type": "add_to_cart", "products": [{"id": "q"}]}, PRODUCTS: [{"id": "p", "price": 1}], CART: [{"total_value": 2}]},
        {**BASE, ACTION: [{"type": "list_view", "name": None}], "mkt_clickid": "c", "mkt_source": None, "contexts_x_client_session_1": [{"sessionId": "S"}]},
        {"event": "page_view", "mkt_campaign": "a", "contexts_any_event_specification_1": [{"id": 1}], "contexts_x_browser_context_2": [{"viewport": "1x1"}]},
        {**BASE, ACTION: {"type": "promo_view"}, NAMES["promotion"]: [{"id": "x"}], NAMES["timing"]: [{"t": 1}], NAMES["checkout"]: []},
        {},
    ]
    raw = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("broken {",), (None,)], "value string")
    for full in (True, False):
        assert sorted(map(str, reshape(raw, full, NAMES).collect())) == sorted(map(str, reshape(raw, full).collect()))
    two = {**BASE, ACTION: {"type": "product_view"}, "contexts_aaa_ecommerce_product_1": [{"id": "other"}], PRODUCTS: [{"id": "mine"}]}
    frame = spark.createDataFrame([(json.dumps(two),)], "value string")
    assert json.loads(reshape(frame, False, NAMES).first().value)["payload"]["product"] == {"id": "mine"}
    assert json.loads(reshape(frame, False, {"action": ACTION}).first().value)["payload"]["product"] == {}


def test_many_very_large_orders_are_added(spark):
    from cartwheel.plans.event_features import purchase_stats

    rows = []
    for i in range(40):
        rows += [(f"a{i:02d}", "u", "add_to_cart", 9e18, 9e18, False, 2 * i), (f"b{i:02d}", "u", "checkout_step", 0.0, 0.0, True, 2 * i + 1)]
    events = spark.createDataFrame(rows, "event_id string, user_id string, event_type string, cart_total double, cart_price double, completed boolean, s int")
    out = purchase_stats(events.withColumn("ts", F.timestamp_seconds("s")).drop("s"), {"1h": 3600})
    last = max((r.orders_count, r.order_value) for r in out.collect())
    assert last[0] == 40 and last[1] == 40 * 1.8e19


def test_locations_are_metrics_of_the_job(spark, tmp_path):
    """The narrowest range gives the region; addresses outside all ranges, and none, count as no sighting."""
    from cartwheel.config import FeatureConfig, SessionWindow
    from cartwheel.plans import pipeline

    addresses = ["10.1.0.5", "10.1.0.6", None, "10.2.3.4", "99.0.0.1", "10.1.0.5"]
    sent = [
        event(id=str(i), timestamp=f"2024-01-01T00:0{i}:00Z", user={"user_id": "u", "ip_address": ip}, session={"sessionId": "s"}) for i, ip in enumerate(addresses)
    ]
    sent.append(event(id="9", timestamp="2024-01-01T00:00:00Z", user={"user_id": "u"}, session={"sessionId": "t"}))
    places = spark.createDataFrame([("10.0.0.0/8", "wide"), ("10.1.0.0/16", "narrow"), ("10.1.0.0/24", "narrowest"), ("x/8", "none")], "cidr string, region string")
    kept = pipeline.run_batch(lines(spark, *sent), FeatureConfig(SessionWindow(600, 60, 900)), str(tmp_path / "s"), run="r", places=places)
    found = {r.name: r.value for r in kept["session"].latest().where("name LIKE '%:shopper_locations' OR name LIKE '%changes'").collect()}
    assert found == {"session:s:shopper_locations": "[narrowest, wide]", "session:s:shopper_region_changes": "2"}
