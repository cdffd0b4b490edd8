"""The registered queries again, as plain SQL over the same tables, for side-by-side checks."""

from __future__ import annotations

SHOP = """
WITH ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE event_type WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'list_view' ELSE 'product_view' END
      WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
      WHEN 'purchase' THEN 'checkout_step' WHEN 'signup' THEN 'page_view' END AS kind
  FROM events),
shop AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, kind AS event_type, CAST(user_id AS VARCHAR) AS user_id,
    CAST(user_id AS VARCHAR) AS session_id, ts,
    CASE WHEN kind = 'product_view' THEN 'p' || (k % 20) END AS product_id,
    CASE WHEN kind = 'product_view' THEN value END AS product_price,
    CASE WHEN kind = 'list_view' AND k % 10 = 0 THEN ''
      WHEN kind IN ('list_view', 'product_view') THEN 'c' || (k % 7) END AS category,
    CASE WHEN kind IN ('add_to_cart', 'remove_from_cart') THEN round(value * (1 + k % 5), 2) END AS cart_total,
    CASE WHEN kind IN ('add_to_cart', 'remove_from_cart') THEN value END AS cart_price,
    CASE WHEN kind = 'checkout_step' THEN CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END END AS step,
    CASE WHEN kind = 'page_view' THEN CASE WHEN k % 4 = 0 THEN '/search?q=' || k ELSE '/home' END END AS page_url,
    CASE k % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Phone' ELSE 'Tablet' END AS device,
    CASE WHEN k % 2 = 0 THEN 'web' ELSE 'mob' END AS platform,
    k % 5 = 0 AS has_marketing,
    CASE WHEN k % 5 = 0 THEN 'camp' || (k % 10) END AS campaign, k
  FROM ev),
sizes AS (SELECT * FROM (VALUES ('1d', INTERVAL 1 DAY), ('3d', INTERVAL 3 DAY), ('7d', INTERVAL 7 DAY))
  AS s(window_size, span)),
product AS (SELECT * FROM shop WHERE event_type = 'product_view'),
category AS (SELECT * FROM shop WHERE event_type IN ('list_view', 'product_view')),
cart AS (SELECT *, CASE WHEN event_type = 'add_to_cart' THEN cart_total + cart_price
    ELSE cart_total - cart_price END AS cart_value
  FROM shop WHERE event_type IN ('add_to_cart', 'remove_from_cart')),
purchase AS (SELECT * FROM shop WHERE event_type IN ('add_to_cart', 'remove_from_cart', 'checkout_step')),
steps AS (
  SELECT *, count(*) FILTER (WHERE step = 2) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS grp
  FROM purchase WHERE event_type <> 'checkout_step' OR step = 2),
orders_made AS (
  SELECT c.user_id, c.event_id AS order_id, b.event_id AS cart_event_id, b.ts AS cart_ts, c.ts AS order_ts,
    CASE WHEN b.event_type = 'add_to_cart' THEN b.cart_total + b.cart_price
      ELSE b.cart_total - b.cart_price END AS order_value
  FROM steps c JOIN (
      SELECT user_id, grp, arg_max(event_id, ts) AS event_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type,
        arg_max(cart_total, ts) AS cart_total, arg_max(cart_price, ts) AS cart_price
      FROM steps WHERE event_type <> 'checkout_step' GROUP BY user_id, grp) b
    ON b.user_id = c.user_id AND b.grp = c.grp
  WHERE c.event_type = 'checkout_step')
"""

def _avg_order(source: str, *keys: str) -> str:
    """Half-even mean of ``cents`` over ``n`` in whole numbers; whole tenths give one decimal."""
    return f"""
SELECT {", ".join(keys)}, CASE WHEN n = 0 THEN 0.0
  ELSE (a // n + CASE WHEN 2 * (a % n) > n OR (2 * (a % n) = n AND (a // n) % 2 = 1) THEN 1 ELSE 0 END) * unit / 100.0
  END AS avg_order_value
FROM (SELECT *, cents // unit AS a FROM (
  SELECT *, CASE WHEN cents % 10 = 0 AND cents < 1000000000 THEN 10 ELSE 1 END AS unit FROM {source}))"""


def _as_of(branch: str, body: str) -> str:
    """Every event x of a branch with the branch's events y in its window, for each size."""
    return f"""{SHOP}
SELECT x.user_id, x.event_id, x.ts, s.window_size, {body}
FROM {branch} x CROSS JOIN sizes s
JOIN {branch} y ON y.user_id = x.user_id AND y.ts >= x.ts - s.span AND y.ts <= x.ts
GROUP BY x.user_id, x.event_id, x.ts, s.window_size"""


ORACLE: dict[str, str] = {
    "rolling_product_unique": _as_of("product", "count(DISTINCT y.product_id) AS unique_product_count"),
    "rolling_product_price_stats": _as_of(
        "product", "min(y.product_price) AS min_price, max(y.product_price) AS max_price, count(*) AS view_count"
    ),
    "rolling_product_avg_first_price": f"""{SHOP},
firsts AS (
  SELECT x.user_id, x.event_id, x.ts, s.window_size, y.product_id,
    arg_min(y.product_price, (y.ts, y.event_id)) AS price
  FROM product x CROSS JOIN sizes s
  JOIN product y ON y.user_id = x.user_id AND y.ts >= x.ts - s.span AND y.ts <= x.ts
  GROUP BY ALL)
SELECT user_id, event_id, ts, window_size, round(avg(price), 6) AS average_price
FROM firsts GROUP BY user_id, event_id, ts, window_size""",
    "rolling_category_unique": _as_of("category", "count(DISTINCT y.category) AS unique_category_count"),
    "rolling_cart": _as_of(
        "cart",
        """count(*) FILTER (WHERE y.event_type = 'add_to_cart') AS adds,
  count(*) FILTER (WHERE y.event_type = 'remove_from_cart') AS removes, count(*) AS update_frequency""",
    ),
    "cart_value": f"{SHOP} SELECT user_id, event_id, ts, round(cart_value, 6) AS cart_value FROM cart",
    "purchase_orders": f"""{SHOP}
SELECT user_id, order_id, cart_event_id, cart_ts, order_ts, round(order_value, 6) AS order_value FROM orders_made""",
    "rolling_purchase": f"""{SHOP}
SELECT x.user_id, x.event_id, x.ts, s.window_size, count(o.order_id) AS orders_count,
  round(coalesce(sum(o.order_value), 0), 6) AS order_value
FROM purchase x CROSS JOIN sizes s
LEFT JOIN orders_made o ON o.user_id = x.user_id AND o.cart_ts >= x.ts - s.span AND o.order_ts <= x.ts
GROUP BY x.user_id, x.event_id, x.ts, s.window_size""",
    "avg_order_value": f"""{SHOP},
totals AS (
  SELECT x.user_id, x.event_id, x.ts, s.window_size, count(o.order_id) AS n,
    CAST(round(coalesce(sum(o.order_value), 0) * 100) AS BIGINT) AS cents
  FROM purchase x CROSS JOIN sizes s
  LEFT JOIN orders_made o ON o.user_id = x.user_id AND o.cart_ts >= x.ts - s.span AND o.order_ts <= x.ts
  GROUP BY x.user_id, x.event_id, x.ts, s.window_size)
{_avg_order("totals", "user_id", "event_id", "ts", "window_size")}""",
}

GRID = f"""{SHOP},
steps_ahead AS (SELECT window_size, span, unnest(range(1, CAST(epoch(span) / 21600 AS BIGINT) + 1)) AS i FROM sizes)
"""


def _emits(branch: str, name: str) -> str:
    """The branch's events, each at every emit time whose window holds it."""
    return f"""{name} AS (
  SELECT x.*, s.window_size, time_bucket(INTERVAL 6 HOUR, x.ts) + s.i * INTERVAL 6 HOUR AS emit_ts
  FROM {branch} x CROSS JOIN steps_ahead s)"""


PRODUCT_ITEMS = f"""{GRID}, {_emits("product", "pe")},
pitems AS (
  SELECT user_id, emit_ts, window_size, product_id, count(*) AS n, arg_min(product_price, (ts, event_id)) AS first_price,
    min(product_price) AS low, max(product_price) AS high
  FROM pe GROUP BY ALL),
pfeat AS (
  SELECT user_id, emit_ts, window_size, count(*) AS unique_product_count, avg(first_price) AS average_price,
    min(low) AS min_price, max(high) AS max_price, count(*) AS viewed, CAST(sum(n) AS BIGINT) AS view_count,
    '{{' || string_agg(product_id || '=' || n, ', ' ORDER BY product_id) || '}}' AS views
  FROM pitems GROUP BY user_id, emit_ts, window_size)"""

CATEGORY_ITEMS = f"""{_emits("category", "ce")},
citems AS (SELECT user_id, emit_ts, window_size, category, count(*) AS n FROM ce GROUP BY ALL),
cfeat AS (
  SELECT user_id, emit_ts, window_size, count(*) AS unique_category_count,
    arg_min(category, (-n, category)) AS most_viewed_category,
    '{{' || string_agg(category || '=' || n, ', ' ORDER BY category) || '}}' AS views
  FROM citems GROUP BY user_id, emit_ts, window_size)"""

CART_ITEMS = f"""{_emits("cart", "ke")},
kfeat AS (
  SELECT user_id, emit_ts, window_size, count(*) FILTER (WHERE event_type = 'add_to_cart') AS adds,
    count(*) FILTER (WHERE event_type = 'remove_from_cart') AS removes, count(*) AS update_frequency,
    round(arg_max(cart_value, (ts, event_id)), 6) AS cart_value
  FROM ke GROUP BY user_id, emit_ts, window_size),
kzero AS (
  SELECT * FROM kfeat UNION ALL
  SELECT a.user_id, a.emit_ts + INTERVAL 6 HOUR, a.window_size, 0, 0, 0, NULL FROM kfeat a
  WHERE NOT EXISTS (SELECT 1 FROM kfeat b WHERE b.user_id = a.user_id AND b.window_size = a.window_size
    AND b.emit_ts = a.emit_ts + INTERVAL 6 HOUR))"""

PURCHASE_ITEMS = f"""{_emits("purchase", "ue")},
times AS (SELECT DISTINCT user_id, emit_ts, window_size FROM ue),
utotals AS (
  SELECT t.user_id, t.emit_ts, t.window_size, count(o.order_id) AS n, coalesce(sum(o.order_value), 0) AS total,
    CAST(round(coalesce(sum(o.order_value), 0) * 100) AS BIGINT) AS cents
  FROM times t JOIN sizes s USING (window_size)
  LEFT JOIN orders_made o ON o.user_id = t.user_id AND o.cart_ts >= t.emit_ts - s.span AND o.order_ts < t.emit_ts
  GROUP BY t.user_id, t.emit_ts, t.window_size),
uavg AS ({_avg_order("utotals", "user_id", "emit_ts", "window_size", "n AS orders_count", "round(total, 6) AS order_value")})"""

SESSIONS = """
srow AS (
  SELECT *, event_type = 'page_view' AND coalesce(contains(page_url, '/search?q='), false) AS searched,
    CASE WHEN ts - lag(ts) OVER w > INTERVAL 12 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM shop WHERE event_type IN ('page_view', 'product_view', 'add_to_cart', 'remove_from_cart')
  WINDOW w AS (PARTITION BY session_id ORDER BY ts)),
sev AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY ts) AS session_no FROM srow),
sess AS (
  SELECT session_id, session_no, min(ts) AS session_start, max(ts) AS last_ts, max(ts) + INTERVAL 12 HOUR AS close_ts,
    arg_max(user_id, ts) AS user_id, count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
    count(*) FILTER (WHERE searched) AS searches, count(*) FILTER (WHERE event_type = 'product_view') AS product_views,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds,
    arg_min(campaign, ts) FILTER (WHERE has_marketing) AS campaign, arg_max(platform, ts) AS latest_platform
  FROM sev GROUP BY session_id, session_no),
sdev AS (
  SELECT session_id, session_no, device, row_number() OVER (PARTITION BY session_id, session_no ORDER BY seen) - 1 AS place
  FROM (SELECT session_id, session_no, device, min(ts) AS seen FROM sev GROUP BY ALL)),
sfeat AS (
  SELECT *, epoch_us(close_ts) // 1000 - epoch_us(session_start) // 1000 AS duration_ms, epoch_us(last_ts) // 1000 - epoch_us(session_start) // 1000 AS active_ms,
    page_views < 2 AS bounce, CASE WHEN product_views = 0 THEN 0 ELSE cart_adds // product_views END AS cart_ratio,
    CASE WHEN product_views = 0 THEN 0.0 ELSE round(cart_adds / product_views, 6) END AS cart_ratio_exact
  FROM sess)"""


def _zero_rows(name: str, source: str, columns: str, values: str) -> str:
    """The rows of ``source``, and one row of ``values`` at the emit time after a window's last."""
    return f"""{name} AS (
  SELECT user_id, emit_ts, window_size, {columns} FROM {source} UNION ALL
  SELECT a.user_id, a.emit_ts + INTERVAL 6 HOUR, a.window_size, {values} FROM {source} a
  WHERE NOT EXISTS (SELECT 1 FROM {source} b WHERE b.user_id = a.user_id AND b.window_size = a.window_size
    AND b.emit_ts = a.emit_ts + INTERVAL 6 HOUR))"""


PRODUCT_ZERO = _zero_rows(
    "pzero", "pfeat", "unique_product_count, average_price, min_price, max_price, views", "0, 0.0, 0.0, 0.0, '{}'"
)
PRODUCT_ZERO_COUNTS = _zero_rows(
    "vzero", "pfeat", "unique_product_count, average_price, min_price, max_price, viewed, view_count", "0, 0.0, 0.0, 0.0, 0, 0"
)
CATEGORY_ZERO = _zero_rows(
    "czero", "cfeat", "unique_category_count, most_viewed_category, views", "0, NULL, '{}'"
)
PURCHASE_ZERO = _zero_rows("uzero", "uavg", "orders_count, order_value, avg_order_value", "0, 0.0, 0.0")


def _metric(prefix: str, name: str, source: str, value: str, suffix: str = " || '_' || window_size") -> str:
    ttl = "CASE window_size WHEN '1d' THEN 900 WHEN '3d' THEN 1800 ELSE 3600 END" if suffix else "3600"
    emit = "emit_ts" if suffix else "close_ts"
    return f"SELECT {prefix} || ':{name}'{suffix} AS name, {emit} AS emit_ts, {ttl} AS ttl_seconds, {value} FROM {source}"


def _number(value: str) -> str:
    return f"round(CAST({value} AS DOUBLE), 4) AS number, CAST(NULL AS VARCHAR) AS words"


def _words(value: str) -> str:
    return f"CAST(NULL AS DOUBLE) AS number, {value} AS words"


_USER, _SESSION = "'user:' || user_id", "'session:' || session_id"
_METRICS = " UNION ALL ".join(
    [
        _metric(_USER, "product_view_count", "pzero", _number("unique_product_count")),
        _metric(_USER, "avg_viewed_price", "pzero", _number("average_price")),
        _metric(_USER, "return_view_count", "pzero", _words("views")),
        _metric(_USER, "price_range_viewed", "pzero", _words("CAST(min_price AS VARCHAR) || '-' || CAST(max_price AS VARCHAR)")),
        _metric(_USER, "top_category", "czero", _words("most_viewed_category")) + " WHERE most_viewed_category IS NOT NULL",
        _metric(_USER, "unique_categories", "czero", _number("unique_category_count")),
        _metric(_USER, "category_view_count", "czero", _words("views")),
        _metric(_USER, "cart_add_count", "kzero", _number("adds")),
        _metric(_USER, "cart_remove_count", "kzero", _number("removes")),
        _metric(_USER, "cart_update_frequency", "kzero", _number("update_frequency")),
        _metric(_USER, "cart_value", "kzero", _number("cart_value")) + " WHERE cart_value IS NOT NULL",
        _metric(_USER, "orders_count", "uzero", _number("orders_count")),
        _metric(_USER, "order_value", "uzero", _number("order_value")),
        _metric(_USER, "avg_order_value", "uzero", _number("avg_order_value")),
        _metric(_SESSION, "session_duration", "sfeat", _number("duration_ms"), ""),
        _metric(_SESSION, "session_page_count", "sfeat", _number("page_views"), ""),
        _metric(_SESSION, "session_bounce", "sfeat", _words("CAST(bounce AS VARCHAR)"), ""),
        _metric(_SESSION, "session_marketing_campaign", "sfeat", _words("campaign"), "") + " WHERE campaign IS NOT NULL",
        _metric(_SESSION, "session_cart_ratio", "sfeat", _number("cart_ratio"), ""),
        _metric(_SESSION, "session_search_count", "sfeat", _number("searches"), ""),
        _metric(
            _SESSION,
            "shopper_device_types",
            "sfeat JOIN (SELECT session_id, session_no, '[' || string_agg(device, ', ' ORDER BY place) || ']' AS devices"
            " FROM sdev GROUP BY ALL) USING (session_id, session_no)",
            _words("devices"),
            "",
        ),
        _metric(_SESSION, "shopper_latest_platform", "sfeat", _words("latest_platform"), ""),
    ]
)

STORED = f"""{GRID}, {CART_ITEMS},
rows_written AS (
  {_metric(_USER, "cart_add_count", "kzero", "adds AS v")} UNION ALL
  {_metric(_USER, "cart_remove_count", "kzero", "removes AS v")} UNION ALL
  {_metric(_USER, "cart_update_frequency", "kzero", "update_frequency AS v")} UNION ALL
  {_metric(_USER, "cart_value", "kzero", "cart_value AS v")} WHERE cart_value IS NOT NULL),
stored AS (
  SELECT name, round(CAST(arg_max(v, emit_ts) AS DOUBLE), 4) AS number, max(emit_ts) AS emit_ts,
    max(emit_ts) + to_seconds(any_value(ttl_seconds)) AS expires_at
  FROM rows_written GROUP BY name)"""

_SHOP_COLUMNS = """event_id, event_type, session_id, user_id, {ts} AS ts, device, platform, campaign, product_id,
  product_price, category, cart_total, cart_price, step, page_url"""

ADDRESSED = """
WITH addressed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, ts, event_type, value,
    CAST(json_extract_string(props, '$.k') AS INTEGER) % 30 AS second,
    '10.' || second || '.' || (user_id % 256) || '.' || (event_id % 256) AS ip
  FROM events),
placed AS (
  SELECT a.*, coalesce(n.n_name, r.r_name) AS place
  FROM addressed a LEFT JOIN nation n ON n.n_nationkey = a.second LEFT JOIN region r ON r.r_regionkey = a.second // 8)"""


PLACED = ADDRESSED.strip().removeprefix("WITH ")

# Events of sessions with their region and the one before in the same session.
LOCATED = """
moved AS (
  SELECT s.session_id, s.session_no, s.ts, p.place,
    lag(p.place) OVER (PARTITION BY s.session_id, s.session_no ORDER BY s.ts, s.event_id) AS before
  FROM sev s JOIN placed p USING (event_id) WHERE p.place IS NOT NULL)"""


def _parameter(name: str) -> str:
    found = f"regexp_extract(query, '(^|&){name}=([^&]*)', 2)"
    return f"CASE WHEN regexp_matches(query, '(^|&){name}=') THEN url_decode({found}) END"


_QUERY_PART = "regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)"

ORACLE |= {
    "event_type_filter": f"""{SHOP} SELECT event_id, event_type, user_id, ts FROM shop
WHERE event_type IN ('page_view', 'product_view', 'add_to_cart', 'remove_from_cart')""",
    "canonical_user_events": f"{SHOP} SELECT {_SHOP_COLUMNS.format(ts='ts')} FROM shop",
    "product_view_projection": f"{SHOP} SELECT event_id, user_id, product_id, product_price, ts FROM product",
    "category_view_projection": f"{SHOP} SELECT event_id, user_id, category, ts FROM category",
    "cart_projection": f"""{SHOP} SELECT event_id, user_id, event_type, cart_total AS previous_price,
  cart_price AS product_price, ts FROM cart""",
    "json_path": f"{SHOP} SELECT {_SHOP_COLUMNS.format(ts=chr(39).join(['date_trunc(', 'millisecond', ', ts)']))} FROM shop",
    "reshaped_blocks": f"""{SHOP} SELECT event_id, event_type, platform, user_id AS domain_userid, campaign AS mkt_campaign,
  session_id AS domain_sessionid, page_url, CASE WHEN event_type = 'list_view' THEN category END AS list_name FROM shop""",
    "bad_rows_split": f"""{SHOP} SELECT CASE WHEN k % 50 = 0 THEN 'malformed JSON' ELSE 'good' END AS outcome, count(*) AS n
FROM shop GROUP BY 1""",
    "bad_rows": f"{SHOP} SELECT event_id, 'malformed JSON' AS parse_error FROM shop WHERE k % 50 = 0",
    "events_deduplicated": f"""{SHOP} SELECT event_id, event_type, user_id, ts, page_url FROM shop
UNION ALL SELECT event_id, event_type, user_id, ts, '/other' FROM shop WHERE CAST(event_id AS BIGINT) % 5 = 0""",
    "device_class_os": """SELECT event_id,
  CASE k WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Phone' WHEN 2 THEN 'Tablet' WHEN 3 THEN 'Robot' WHEN 4 THEN 'Unknown' ELSE 'Desktop' END AS device_class,
  CASE k WHEN 0 THEN 'Windows NT' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Android' WHEN 3 THEN 'Linux' WHEN 4 THEN 'Unknown' ELSE 'Mac OS' END AS os_name
FROM (SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER) % 6, 0) AS k FROM events)""",
    "grid_unique_approx": f"{PRODUCT_ITEMS} SELECT user_id, emit_ts, window_size, unique_product_count FROM pfeat",
    "field_length_limit": """SELECT page_id, CASE WHEN length(url) > 45 THEN 'url longer than 45' END AS parse_error FROM pages""",
    "multi_size_cart": f"""{SHOP} SELECT x.user_id, x.event_id,
  {", ".join(f"count(*) FILTER (WHERE y.event_type = 'add_to_cart' AND y.ts >= x.ts - INTERVAL {d} DAY) AS adds_{d}d" for d in (1, 3, 7))},
  {", ".join(f"round(avg(y.cart_price) FILTER (WHERE y.ts >= x.ts - INTERVAL {d} DAY), 6) AS mean_price_{d}d" for d in (1, 3, 7))}
FROM cart x JOIN cart y ON y.user_id = x.user_id AND y.ts >= x.ts - INTERVAL 7 DAY AND y.ts <= x.ts
GROUP BY x.user_id, x.event_id""",
    "product_views_map_long": f"{PRODUCT_ITEMS} SELECT user_id, emit_ts, window_size, product_id, n FROM pitems",
    "grid_product": f"""{PRODUCT_ITEMS},
full_grid AS (
  SELECT user_id, emit_ts, window_size, unique_product_count, round(average_price, 6) AS average_price, min_price, max_price,
    viewed, view_count FROM pfeat)
SELECT * FROM full_grid UNION ALL
SELECT a.user_id, a.emit_ts + INTERVAL 6 HOUR, a.window_size, 0, 0.0, 0.0, 0.0, 0, 0 FROM full_grid a
WHERE NOT EXISTS (SELECT 1 FROM full_grid b WHERE b.user_id = a.user_id AND b.window_size = a.window_size
  AND b.emit_ts = a.emit_ts + INTERVAL 6 HOUR)""",
    "category_view_count": f"{GRID}, {CATEGORY_ITEMS} SELECT * FROM citems",
    "grid_category_zero_rows": f"""{GRID}, {CATEGORY_ITEMS}, {CATEGORY_ZERO} SELECT user_id, emit_ts, window_size, unique_category_count,
  most_viewed_category, CASE WHEN views = '{{}}' THEN 0 ELSE unique_category_count END AS viewed FROM czero""",
    "rolling_top_category": f"""{GRID}, {CATEGORY_ITEMS}
SELECT user_id, emit_ts, window_size, unique_category_count, most_viewed_category FROM cfeat""",
    "grid_cart": f"{GRID}, {CART_ITEMS} SELECT * FROM kfeat",
    "grid_cart_zero_rows": f"{GRID}, {CART_ITEMS} SELECT * FROM kzero",
    "grid_purchase_zero_rows": f"{GRID}, {PURCHASE_ITEMS}, {PURCHASE_ZERO} SELECT * FROM uzero",
    "grid_purchase": f"{GRID}, {PURCHASE_ITEMS} SELECT * FROM uavg",
    "session_bounds": f"""{SHOP}, {SESSIONS}
SELECT session_id, session_start, last_ts, close_ts, duration_ms, active_ms FROM sfeat""",
    "session_features": f"""{SHOP}, {SESSIONS}
SELECT session_id, session_start, user_id, page_views, searches, product_views, cart_adds, latest_platform, bounce,
  cart_ratio, cart_ratio_exact FROM sfeat""",
    "session_first_campaign": f"{SHOP}, {SESSIONS} SELECT session_id, session_start, campaign FROM sfeat",
    "session_device_types": f"""{SHOP}, {SESSIONS}
SELECT session_id, session_start, place, device FROM sdev JOIN sess USING (session_id, session_no)""",
    "session_running": f"""{SHOP}, {SESSIONS}
SELECT session_id, min(ts) OVER w AS session_start, event_id, ts AS last_ts,
  count(*) FILTER (WHERE event_type = 'page_view') OVER w AS page_views, count(*) FILTER (WHERE searched) OVER w AS searches,
  count(*) FILTER (WHERE event_type = 'product_view') OVER w AS product_views,
  count(*) FILTER (WHERE event_type = 'add_to_cart') OVER w AS cart_adds,
  arg_min(campaign, ts) FILTER (WHERE has_marketing) OVER w AS campaign, platform AS latest_platform,
  epoch_us(ts) // 1000 - epoch_us(min(ts) OVER w) // 1000 AS duration_ms
FROM sev WINDOW w AS (PARTITION BY session_id, session_no ORDER BY ts)""",
    "session_custom": f"""{SHOP},
kopen AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 12 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM cart WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
kno AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM kopen)
SELECT user_id, min(ts) AS session_start, max(ts) AS last_ts, max(ts) + INTERVAL 12 HOUR AS close_ts, count(*) AS carts,
  max(cart_price) AS dearest
FROM kno GROUP BY user_id, session_no""",
    "metric_long": f"""{PRODUCT_ITEMS}, {PRODUCT_ZERO}, {CATEGORY_ITEMS}, {CATEGORY_ZERO}, {CART_ITEMS}, {PURCHASE_ITEMS}, {PURCHASE_ZERO}, {SESSIONS}
{_METRICS}""",
    "feature_store_latest": f"{STORED} SELECT name, number, emit_ts, expires_at FROM stored",
    "feature_store_lookup": f"""{STORED} SELECT s.name, s.number, s.emit_ts, s.expires_at FROM stored s JOIN (
  SELECT 'user:' || c_custkey || ':' || m AS name FROM customer
  CROSS JOIN (VALUES ('cart_add_count_7d'), ('cart_remove_count_1d')) AS t(m)) USING (name)
WHERE s.expires_at > TIMESTAMP '2024-01-30 00:20:00'""",
    "campaign_from_url": f"""SELECT page_id, {", ".join(f"{_parameter('utm_' + n)} AS mkt_{n}" for n in ("medium", "source", "term", "content", "campaign"))}
FROM (SELECT page_id, {_QUERY_PART} AS query FROM pages)""",
    "event_fingerprint": f"""SELECT page_id, CASE WHEN contains(split_part(url, '#', 1), '?') THEN sha1(array_to_string(list_sort(list_filter(
  string_split({_QUERY_PART}, '&'), lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ('cv', 'eid', 'nuid', 'stm'))), '&')) END
  AS fingerprint FROM pages""",
    "lookup_left_join": """SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""",
    "referer_parser": """SELECT page_id, CASE WHEN host LIKE 'blog.%' THEN 'social' WHEN host LIKE 'm.%' THEN 'search' END AS refr_medium,
  CASE WHEN host LIKE 'blog.%' OR host LIKE 'm.%' THEN host END AS refr_source
FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages)""",
    "ip_lookup": f"{ADDRESSED} SELECT event_id, ip, place FROM placed",
    "shopper_regions": f"""{ADDRESSED},
moves AS (SELECT user_id, place, lag(place) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM placed WHERE place IS NOT NULL)
SELECT user_id, string_agg(DISTINCT place, ',' ORDER BY place) AS shopper_locations,
  count(*) FILTER (WHERE before <> place) AS shopper_region_changes
FROM moves GROUP BY user_id""",
    "session_locations": f"""{SHOP}, {PLACED}, {SESSIONS}, {LOCATED},
told AS (
  SELECT session_id, close_ts, string_agg(DISTINCT place, ', ' ORDER BY place) AS seen, count(*) FILTER (WHERE place <> before) AS changes
  FROM moved JOIN sess USING (session_id, session_no) GROUP BY session_id, session_no, close_ts)
SELECT 'session:' || session_id || ':shopper_locations' AS name, '[' || seen || ']' AS value, CAST(3600 AS BIGINT) AS ttl_seconds, close_ts AS emit_ts FROM told
UNION ALL SELECT 'session:' || session_id || ':shopper_region_changes', CAST(changes AS VARCHAR), 3600, close_ts FROM told""",
    "robot_filter": f"""{ADDRESSED} SELECT event_id, user_id FROM addressed
WHERE second NOT IN (SELECT n_nationkey FROM nation) AND event_type IN ('click', 'view')""",
    "currency_conversion": """
WITH rates AS (
  SELECT event_type, CAST(ts AS DATE) AS rate_date, max(value) AS rate FROM events GROUP BY ALL)
SELECT CAST(e.event_id AS VARCHAR) AS event_id, round(e.value * CASE WHEN e.event_type = 'signup' THEN 1.0 ELSE (
  SELECT arg_max(r.rate, r.rate_date) FROM rates r
  WHERE r.event_type = e.event_type AND r.rate_date < CAST(e.ts AS DATE)) END, 4) AS amount_base
FROM events e""",
    "pii_pseudonym": "SELECT c_custkey, sha1(c_name || 'salty') AS pseudonym FROM customer",
    "ip_anonymous": f"{ADDRESSED} SELECT event_id, '10.' || second || '.' || split_part(ip, '.', 3) || '.x' AS ip FROM addressed",
}

# Streams end five seconds before the newest event kept by each query.
_PASSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 SECOND FROM {source})"


def _passed(column: str, source: str, strictly: bool = False) -> str:
    return f"{column} {'<' if strictly else '<='} {_PASSED.format(source=source)}"


# Emit times of sessions that the watermark has passed, and their close.
OPEN_AT = f"""bounds AS (SELECT *, {_PASSED.format(source='shop')} AS passed,
    time_bucket(INTERVAL 6 HOUR, session_start) + INTERVAL 6 HOUR AS first_emit FROM sess),
open_at AS (
  SELECT session_id, session_no, false AS closed, unnest(generate_series(first_emit, least(passed, close_ts), INTERVAL 6 HOUR)) AS as_of
  FROM bounds WHERE first_emit <= least(passed, close_ts)
  UNION ALL SELECT session_id, session_no, true, date_trunc('millisecond', last_ts) + INTERVAL 12 HOUR FROM bounds
  WHERE date_trunc('millisecond', last_ts) + INTERVAL 12 HOUR <= passed)"""

ORACLE |= {
    "stream_cart": f"{GRID}, {CART_ITEMS} SELECT * FROM kzero WHERE {_passed('emit_ts', 'shop')}",
    "stream_product": f"""{PRODUCT_ITEMS}, {PRODUCT_ZERO_COUNTS} SELECT user_id, emit_ts, window_size, unique_product_count,
  round(average_price, 6) AS average_price, min_price, max_price, viewed, view_count FROM vzero WHERE {_passed('emit_ts', 'shop')}""",
    "stream_category": f"""{GRID}, {CATEGORY_ITEMS}, {CATEGORY_ZERO} SELECT user_id, emit_ts, window_size, unique_category_count,
  most_viewed_category, CASE WHEN views = '{{}}' THEN 0 ELSE unique_category_count END AS viewed FROM czero WHERE {_passed('emit_ts', 'shop')}""",
    "stream_purchase": f"{GRID}, {PURCHASE_ITEMS}, {PURCHASE_ZERO} SELECT * FROM uzero WHERE {_passed('emit_ts', 'shop')}",
    "stream_sessions": f"""{SHOP}, {SESSIONS} SELECT session_id, session_start, last_ts, user_id, page_views, searches, product_views,
  cart_adds, campaign, devices, latest_platform, bounce, cart_ratio
FROM sfeat JOIN (SELECT session_id, session_no, string_agg(device, ',' ORDER BY place) AS devices FROM sdev GROUP BY ALL) USING (session_id, session_no)
WHERE close_ts <= {_PASSED.format(source='shop')}""",
    "stream_cart_exact": f"""{GRID}, {CART_ITEMS} SELECT user_id, emit_ts, window_size, adds, removes FROM kzero
WHERE {_passed('emit_ts', 'shop')}""",
    "stream_sessions_running": f"""{SHOP}, {SESSIONS}, {OPEN_AT}
SELECT o.session_id, o.as_of, o.closed, count(*) FILTER (WHERE v.event_type = 'page_view') AS page_views,
  count(*) FILTER (WHERE v.event_type = 'product_view') AS product_views,
  count(*) FILTER (WHERE v.event_type = 'add_to_cart') AS cart_adds
FROM open_at o JOIN sev v ON v.session_id = o.session_id AND v.session_no = o.session_no AND (o.closed OR v.ts < o.as_of)
GROUP BY o.session_id, o.session_no, o.as_of, o.closed""",
    "stream_sessions_metrics": f"""{SHOP}, {SESSIONS}, {OPEN_AT},
seen AS (
  SELECT o.session_id AS sid, o.session_no AS no, o.as_of, o.closed, v.* FROM open_at o
  JOIN sev v ON v.session_id = o.session_id AND v.session_no = o.session_no AND (o.closed OR v.ts < o.as_of)),
found AS (SELECT sid, no, as_of, closed, device, min(ts) AS first FROM seen GROUP BY ALL),
listed AS (SELECT sid, no, as_of, closed, string_agg(device, ',' ORDER BY first) AS devices FROM found GROUP BY ALL),
counted AS (
  SELECT sid, no, as_of, closed, min(ts) AS session_start, arg_max(user_id, ts) AS user_id,
    count(*) FILTER (WHERE event_type = 'page_view') AS page_views, count(*) FILTER (WHERE searched) AS searches,
    count(*) FILTER (WHERE event_type = 'product_view') AS product_views, count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds,
    arg_min(campaign, ts) FILTER (WHERE has_marketing) AS campaign, arg_max(platform, ts) AS latest_platform
  FROM seen GROUP BY ALL)
SELECT sid AS session_id, session_start, as_of, closed, user_id, page_views, searches, product_views, cart_adds, campaign, devices,
  latest_platform, epoch_us(as_of) // 1000 - epoch_us(session_start) // 1000 AS duration_ms, page_views < 2 AS bounce,
  CASE WHEN product_views = 0 THEN 0 ELSE cart_adds // product_views END AS cart_ratio
FROM counted JOIN listed USING (sid, no, as_of, closed)""",
    "stream_session_locations": f"""{SHOP}, {PLACED}, {SESSIONS}, {LOCATED}, {OPEN_AT}
SELECT o.session_id, o.as_of, o.closed, string_agg(DISTINCT m.place, ',' ORDER BY m.place) AS shopper_locations,
  count(*) FILTER (WHERE m.place <> m.before) AS shopper_region_changes
FROM open_at o JOIN moved m ON m.session_id = o.session_id AND m.session_no = o.session_no AND (o.closed OR m.ts < o.as_of)
GROUP BY o.session_id, o.session_no, o.as_of, o.closed""",
    "stream_deduplicated": f"""{SHOP} SELECT event_id, event_type, user_id, ts, page_url FROM shop
UNION ALL SELECT event_id, event_type, user_id, ts, '/other' FROM shop WHERE CAST(event_id AS BIGINT) % 5 = 0""",
    "stream_late_rows": f"""{SHOP},
parts AS (SELECT *, CAST(event_id AS BIGINT) % 3 AS part, epoch_us(ts) // 1000 AS ms FROM shop),
marks AS (
  SELECT 1 AS part, max(ms) - 5000 AS mark FROM parts WHERE part = 0 UNION ALL SELECT 2, max(ms) - 5000 FROM parts WHERE part <= 1)
SELECT event_id, event_type, user_id, session_id, make_timestamp(ms * 1000) AS ts, make_timestamp(mark * 1000) AS watermark,
  ms < (mark // 21600000 + 1) * 21600000 - 7 * 86400000 AS missed
FROM parts JOIN marks USING (part) WHERE ms < mark""",
}
