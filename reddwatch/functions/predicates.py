"""Membership that never yields NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_member(value: Column | str, allowed: Iterable[str]) -> Column:
    """True or false, with a NULL value counting as not a member."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value.isin(list(allowed)), F.lit(False))
