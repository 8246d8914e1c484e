"""Removal of secrets: header allowlist and credentials-token mask."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import body_size, is_credentials_url, lower_trimmed, mask_bodies
from .admission import add_reason

Redactor = Callable[[DataFrame], DataFrame]


def normalise_header_names(names: Column) -> Column:
    """Trimmed, lower-cased, without blanks, each name once in first order; null is none."""
    cleaned = F.transform(names, lower_trimmed)
    kept = F.array_distinct(F.filter(cleaned, lambda name: F.coalesce(name != "", F.lit(False))))
    return F.coalesce(kept, F.array().cast("array<string>"))


def allowed_headers(headers: Column, extra: Iterable[str] | Column = ()) -> Column:
    """Keep the entries whose name is on the allowlist, in any letter case.

    `extra` lengthens the default list and can never shorten it: fixed names,
    or an array column of normalised names. A bare string is no list and adds
    nothing; entries that are not strings are passed over.
    """
    headers = F.coalesce(headers, F.create_map().cast("map<string,string>"))
    fixed = list(C.DEFAULT_HEADER_ALLOWLIST)
    if isinstance(extra, Column):
        more = F.coalesce(extra, F.array().cast("array<string>"))
        return F.map_filter(
            headers,
            lambda name, _: F.lower(name).isin(fixed) | F.array_contains(more, F.lower(name)),
        )
    given = () if isinstance(extra, str) else extra
    fixed += [name.strip().lower() for name in given if isinstance(name, str) and name.strip()]
    return F.map_filter(headers, lambda name, _: F.lower(name).isin(fixed))


def redact_headers(df: DataFrame, extra: Iterable[str] | Column = ()) -> DataFrame:
    """Apply the allowlist to both header maps."""
    return df.withColumns(
        {
            name: allowed_headers(F.col(name), extra)
            for name in ("request_headers", "response_headers")
        }
    )


def mask_credentials(df: DataFrame) -> DataFrame:
    """Mask the token in the bodies of credentials exchanges.

    Python sees a body only where the URL is a credentials URL and the row is
    still admitted. A body that could not be looked at (nested too deep, or no
    URL to judge by) rejects the message rather than letting a token through.
    """
    gate = is_credentials_url(F.col("url"))
    if "drop_reason" in df.columns:
        gate = gate & F.col("drop_reason").isNull()
    bodies = ("request_body", "response_body")
    unjudged = F.col("url").isNull() & ((body_size(F.col(bodies[0])) > 0) | (body_size(F.col(bodies[1])) > 0))
    masked = df.withColumn("__masked", mask_bodies(*[F.when(gate, F.col(body)) for body in bodies]))
    faulty = F.coalesce(F.col("__masked.fault"), F.lit(False)) | unjudged
    return add_reason(masked, F.when(faulty, F.lit(C.REDACT_FAULT))).withColumns(
        {body: F.coalesce(F.col(f"__masked.{body}"), F.col(body)) for body in bodies}
    ).drop("__masked")


def ocpi_redactor(extra: Iterable[str] | Column = ()) -> Redactor:
    """The OCPI redactor: both header maps and both bodies."""
    return lambda df: df.transform(redact_headers, extra).transform(mask_credentials)


def ocpp_redactor() -> Redactor:
    """The OCPP redactor: frames go through as they are."""
    return lambda df: df
