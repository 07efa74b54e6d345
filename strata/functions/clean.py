"""Cleaning and standardisation helpers (Catalyst expressions only)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snake_case(name: str) -> str:
    """'Customer Name' / 'Nation-Key' / 'AcctBal' -> customer_name / nation_key / acct_bal."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"[^0-9A-Za-z]+", "_", s)
    return s.strip("_").lower()


def standardise_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = False) -> DataFrame:
    """Convert types; ``strict=False`` turns unconvertible values into NULL."""
    return df.withColumns({c: (F.col(c).cast(t) if strict else F.col(c).try_cast(t))
                           for c, t in types.items()})


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def clean_text(c: Column, case: str | None = None) -> Column:
    """Trim, collapse inner whitespace, optional ``upper`` / ``lower`` / ``title``."""
    out = F.regexp_replace(F.trim(c), r"\s+", " ")
    if case == "upper":
        out = F.upper(out)
    elif case == "lower":
        out = F.lower(out)
    elif case == "title":
        out = F.initcap(out)
    return out


def in_range(c: Column, low=None, high=None) -> Column:
    """TRUE inside ``[low, high]`` (open ends allowed); NULL stays NULL."""
    cond = F.lit(True)
    if low is not None:
        cond = cond & (c >= low)
    if high is not None:
        cond = cond & (c <= high)
    return cond


def parse_timestamp(c: Column, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def age_in_years(dob: Column, as_of: Column) -> Column:
    """Completed years between ``dob`` and an explicit ``as_of`` date."""
    return F.floor(F.months_between(as_of, dob) / 12).cast("int")


def split_to_rows(c: Column, pattern: str = r",\s*") -> Column:
    """1NF: one value per row (use in ``select`` as a generator); a NULL cell
    keeps its row with a NULL value."""
    return F.explode_outer(F.split(c, pattern))
