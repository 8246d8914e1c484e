"""Configuration of clients as a table: one row per client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import is_valid_endpoint, normalise_endpoint, value_or_default
from .admission import add_reason
from .redaction import normalise_header_names

# Field, smallest value that is accepted, default.
_TUNABLES = (
    ("buffer_capacity", C.MIN_BUFFER_CAPACITY, C.DEFAULT_BUFFER_CAPACITY),
    ("max_capture_bytes", C.MIN_MAX_CAPTURE_BYTES, C.DEFAULT_MAX_CAPTURE_BYTES),
    ("flush_interval", C.MIN_FLUSH_INTERVAL, C.DEFAULT_FLUSH_INTERVAL),
    ("drain_timeout", C.MIN_DRAIN_TIMEOUT, C.DEFAULT_DRAIN_TIMEOUT),
)


def _resolved(name: str, minimum, default) -> Column:
    return value_or_default(F.col(name), minimum, default)


def _known_codec() -> Column:
    return F.coalesce(F.col("compression").isin(*C.COMPRESSIONS), F.lit(False))


def _is_active() -> Column:
    return is_valid_endpoint(F.col("endpoint")) & F.coalesce("has_api_key", F.lit(False))


def resolve_config(config: DataFrame) -> DataFrame:
    """Every field with a usable value: the given one, or the default for a bad or absent one."""
    return config.select(
        "client_id",
        normalise_endpoint(F.col("endpoint")).alias("endpoint"),
        _is_active().alias("active"),
        *[_resolved(*tunable).alias(tunable[0]) for tunable in _TUNABLES],
        F.when(_known_codec(), F.col("compression"))
        .otherwise(F.lit(C.DEFAULT_COMPRESSION))
        .alias("compression"),
        F.coalesce("debug", F.lit(False)).alias("debug"),
        normalise_header_names(F.col("allowed_headers")).alias("allowed_headers"),
    )


def config_warnings(config: DataFrame) -> DataFrame:
    """Names of the fields whose value was replaced or skipped; null unless `debug` is on."""
    checks = [
        (F.col(name).isNotNull() & value_or_default(F.col(name), minimum, None).isNull(), name)
        for name, minimum, _ in _TUNABLES
    ]
    checks.append((F.col("compression").isNotNull() & ~_known_codec(), "compression"))
    checks.append((F.exists("allowed_headers", lambda name: name.isNull()), "allowed_headers"))
    found = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in checks]))
    return config.select(
        "client_id", F.when(F.coalesce("debug", F.lit(False)), found).alias("warnings")
    )


def active_clients(config: DataFrame) -> DataFrame:
    """Clients that capture at all: a valid endpoint, and an API key on file."""
    return config.where(_is_active()).select("client_id")


def exclude_inert(captures: DataFrame, config: DataFrame) -> DataFrame:
    """Messages of active clients."""
    return captures.join(active_clients(config), "client_id", "left_semi")


def only_inert(captures: DataFrame, config: DataFrame) -> DataFrame:
    """Messages of inert clients, with the reason they are lost."""
    lost = captures.join(active_clients(config), "client_id", "left_anti")
    return add_reason(lost, F.lit(C.INERT_CLIENT))


def with_config(captures: DataFrame, config: DataFrame) -> DataFrame:
    """Put each message beside its client's limits, as the struct `config`.

    Messages of inert or unknown clients get the reason they are lost. No hint:
    Spark broadcasts the configuration when its table is small, and otherwise
    sorts, where AQE splits a client that is too hot.
    """
    resolved = resolve_config(config).where("active").drop("active", "endpoint", "debug")
    limits = resolved.select("client_id", F.struct(*resolved.columns[1:]).alias("config"))
    joined = captures.join(limits, "client_id", "left")
    return add_reason(joined, F.when(F.col("config").isNull(), F.lit(C.INERT_CLIENT)))
