"""Masking of the credentials token inside JSON bodies.

A masked body is written out again as compact, ASCII-only JSON, which no Spark
JSON function reproduces (key order, duplicate keys, number forms), so this is
the one place where rows go through Python. Callers pass null for every body
that needs no look, and only those that are left are parsed.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StructType

from ..constants import TOKEN_PLACEHOLDER


def _has_token(node: object) -> bool:
    return isinstance(node, dict) and isinstance(node.get("token"), str) and node["token"] != ""


def mask_token(body: bytes) -> bytes:
    """Mask the token at the root or, failing that, the one under `data`.

    The body comes back byte for byte when there is nothing to mask or when it
    is not a JSON object. A number too long to be read raises ValueError.
    """
    try:
        root = json.loads(body.decode("utf-8", errors="replace"))
    except json.JSONDecodeError:
        return body
    places = (root, root.get("data")) if isinstance(root, dict) else ()
    holder = next(filter(_has_token, places), None)
    if holder is None:
        return body
    holder["token"] = TOKEN_PLACEHOLDER
    return json.dumps(root, separators=(",", ":")).encode("ascii")


def _mask_series(bodies: pd.Series, fault: pd.Series) -> pd.Series:
    masked = bodies.copy()
    for at in bodies.index[bodies.notna()]:
        try:
            masked.at[at] = mask_token(bytes(bodies.at[at]))
        except (RecursionError, ValueError):
            fault.at[at] = True
    return masked


_MASKED = (
    StructType()
    .add("request_body", BinaryType())
    .add("response_body", BinaryType())
    .add("fault", BooleanType())
)


def _mask_bodies(request: pd.Series, response: pd.Series) -> pd.DataFrame:
    """Mask both bodies of an exchange; `fault` marks JSON that cannot be read: nested too deep, or with a number of thousands of digits."""
    fault = pd.Series(False, index=request.index)
    return pd.DataFrame(
        {
            "request_body": _mask_series(request, fault),
            "response_body": _mask_series(response, fault),
            "fault": fault,
        }
    )


# Declared non-deterministic (it is not) so that Spark does not copy the call
# into every expression and filter that reads its result: bodies go to Python once.
mask_bodies = F.pandas_udf(_mask_bodies, _MASKED).asNondeterministic()
