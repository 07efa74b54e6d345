"""Scalar derivations of the event pipeline (all Catalyst expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the pipeline's outputs.
# value_category: below 50 "low", below 200 "medium", otherwise "high".
VALUE_BUCKETS = ((50, "low"), (200, "medium"))
VALUE_BUCKET_ELSE = "high"
# activity_tier: at least 10 events "power_user", at least 3 "regular_user",
# otherwise "casual_user".
ACTIVITY_TIERS = ((10, "power_user"), (3, "regular_user"))
ACTIVITY_TIER_ELSE = "casual_user"
# dayofweek: 1 = Sunday ... 7 = Saturday; the weekend is {1, 7}.
WEEKEND_DAYS = (1, 7)
# Dotted-quad check; "[.]" matches a literal dot without escape handling.
IP_PATTERN = "^[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}$"
# The pattern as it reaches SQL when "\\." is written inside a Python string:
# the dot is unescaped and matches any character.
IP_PATTERN_LOOSE = "^[0-9]{1,3}.[0-9]{1,3}.[0-9]{1,3}.[0-9]{1,3}$"


def is_weekend(ts: Column) -> Column:
    """CASE form on purpose: NULL timestamp gives FALSE, not NULL."""
    return F.when(F.dayofweek(ts).isin(*WEEKEND_DAYS), True).otherwise(False)


def value_category(v: Column) -> Column:
    out = None
    for bound, label in VALUE_BUCKETS:
        out = F.when(v < bound, label) if out is None else out.when(v < bound, label)
    return out.otherwise(VALUE_BUCKET_ELSE)  # NULL value falls through to "high"


def activity_tier(n: Column) -> Column:
    out = None
    for bound, label in ACTIVITY_TIERS:
        out = F.when(n >= bound, label) if out is None else out.when(n >= bound, label)
    return out.otherwise(ACTIVITY_TIER_ELSE)


def event_derivations(ts: str = "event_timestamp", value: str = "event_value") -> dict[str, Column]:
    t = F.col(ts)
    return {
        "event_date": F.to_date(t),
        "event_hour": F.hour(t),
        "day_of_week": F.dayofweek(t),
        "is_weekend": is_weekend(t),
        "value_category": value_category(F.col(value)),
    }


def ip_rule_sql(compat: bool = False) -> str:
    return f"source_ip RLIKE '{IP_PATTERN_LOOSE if compat else IP_PATTERN}'"
