"""Text rules. White space is Unicode white space, which Spark's `trim` is not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EDGE_BLANKS_PATTERN, NON_BLANK_PATTERN


def non_blank(text: Column) -> Column:
    """True when the text is there and has a visible character; never null."""
    return F.coalesce(text.rlike(NON_BLANK_PATTERN), F.lit(False))


def strip_blanks(text: Column) -> Column:
    """The text without white space at either end."""
    return F.regexp_replace(text, EDGE_BLANKS_PATTERN, "")


def lower_trimmed(text: Column) -> Column:
    """Form in which header names are compared."""
    return F.lower(strip_blanks(text))
