"""Column-level helpers: event time, money in cents, text formats."""

from cardstream.functions.timecols import (  # noqa: F401
    amount_cents, tumbling_end_ms, with_event_time,
)
from cardstream.functions import format  # noqa: F401
