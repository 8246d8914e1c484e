"""URL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CREDENTIALS_URL_PATTERN
from .text import strip_blanks


def is_credentials_url(url: Column) -> Column:
    """True when the URL names the credentials route; never null."""
    return F.coalesce(url.rlike(CREDENTIALS_URL_PATTERN), F.lit(False))


# http or https, then an authority: a plain one, or one with an IPv6 address in
# brackets.
_ENDPOINT_PATTERN = (
    r"^(?i:https?)://(?:[^/?#\[\]]+|(?:[^/?#\[\]]*@)?\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*\](?::[^/?#\[\]]*)?)(?:[/?#]|\z)"
)


def is_valid_endpoint(endpoint: Column) -> Column:
    """http or https with a non-empty authority; never null."""
    return F.coalesce(strip_blanks(endpoint).rlike(_ENDPOINT_PATTERN), F.lit(False))


def normalise_endpoint(endpoint: Column) -> Column:
    """The endpoint without blanks around it and without trailing slashes; null when invalid."""
    return F.when(
        is_valid_endpoint(endpoint), F.regexp_replace(strip_blanks(endpoint), r"/+\z", "")
    )
