"""Manual event requests: eight text fields -> one typed event each.

Same rules as the web form endpoint: the server stamps the time, blank
category and brand become NULL, a blank session gets a random UUID, every
number must parse strictly. Works on batch or streaming request frames.
Manual events stay a frame of their own (they feed no aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import blank_to_null, blank_to_uuid, is_known_type, strict_decimal, strict_long
from tidemark.functions.time import to_wallclock
from tidemark.operators.validate import REASON, first_reason
from tidemark.schema import EVENT_COLUMNS


def normalize_requests(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """Request rows -> canonical events + ``reject_reason``.

    ``now`` defaults to ``current_timestamp()``: one server time per query or
    micro-batch (the original stamps each request as it arrives).
    """
    now = F.current_timestamp() if now is None else now
    c = F.col
    typed = {
        "event_time": to_wallclock(now),
        "event_type": c("eventType"),
        "product_id": strict_long(c("productId")),
        "category_id": strict_long(c("categoryId")),
        "category_code": blank_to_null(c("categoryCode")),
        "brand": blank_to_null(c("brand")),
        "price": strict_decimal(c("price")),
        "user_id": strict_long(c("userId")),
        "user_session": blank_to_uuid(c("userSession")),
    }
    # Checked in field order; a NULL text field fails where it is first used.
    checks = [
        (~F.coalesce(is_known_type(c("eventType")), F.lit(False)), "unknown_event_type"),
        (typed["product_id"].isNull(), "bad_product_id"),
        (typed["category_id"].isNull(), "bad_category_id"),
        (c("categoryCode").isNull(), "missing_category_code"),
        (c("brand").isNull(), "missing_brand"),
        (typed["price"].isNull(), "bad_price"),
        (typed["user_id"].isNull(), "bad_user_id"),
        (c("userSession").isNull(), "missing_user_session"),
    ]
    return requests.select(*[typed[n].alias(n) for n in EVENT_COLUMNS],
                           first_reason(checks).alias(REASON))
