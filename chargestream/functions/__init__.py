"""Column helpers: text rules, wire normalisation, URL rules, token masking."""

from .text import lower_trimmed, non_blank, strip_blanks
from .tokens import mask_bodies
from .urls import is_credentials_url, is_valid_endpoint, normalise_endpoint
from .wire import (
    body_base64,
    body_size,
    encode_frame,
    headers_or_null,
    null_if_empty,
    null_if_zero,
    route,
    value_or_default,
    wire_timestamp,
)

__all__ = [
    "body_base64",
    "body_size",
    "encode_frame",
    "headers_or_null",
    "is_credentials_url",
    "is_valid_endpoint",
    "lower_trimmed",
    "mask_bodies",
    "non_blank",
    "normalise_endpoint",
    "null_if_empty",
    "null_if_zero",
    "route",
    "strip_blanks",
    "value_or_default",
    "wire_timestamp",
]
