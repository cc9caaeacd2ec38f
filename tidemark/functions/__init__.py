"""Column-level building blocks (pure ``Column -> Column`` expressions)."""

from tidemark.functions.scalar import (  # noqa: F401
    blank_to_null, blank_to_uuid, category_or_unknown, empty_to_null, is_blank,
    is_known_type, strict_decimal, strict_long, type_name, user_key,
)
from tidemark.functions.time import (  # noqa: F401
    epoch_seconds, from_epoch_seconds, parse_utc_text, text_utc, to_instant,
    to_wallclock, wallclock_micros,
)
