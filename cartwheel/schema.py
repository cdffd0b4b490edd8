"""Columns of the canonical shop event: what every branch, batch or stream, reads."""

from __future__ import annotations

from pyspark.sql import types as T

S, D = T.StringType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


MARKETING = _struct(campaign=S, source=S, medium=S, term=S, content=S)
USER_AGENT = _struct(platform=S, type=S)
ENRICHMENT = _struct(platform=S, marketing=MARKETING, user=_struct(ip_address=S))

SHOP_EVENT = _struct(
    event_id=S,
    event_type=S,
    session_id=S,
    user_id=S,
    ts=T.TimestampType(),
    payload=S,
    user_agent=USER_AGENT,
    enrichment=ENRICHMENT,
    # typed payload fields, null where the event type has none
    product_id=S,
    product_price=D,
    category=S,
    cart_total=D,
    cart_price=D,
    step=T.IntegerType(),
    page_url=S,
)

PRODUCT_VIEW = "product_view"
LIST_VIEW = "list_view"
ADD = "add_to_cart"
REMOVE = "remove_from_cart"
CHECKOUT = "checkout_step"
PAGE_VIEW = "page_view"
COMPLETED_STEP = 2
SEARCH_MARK = "/search?q="
