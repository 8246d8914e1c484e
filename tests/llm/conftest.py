"""Tables for the operators, and plain-Python versions of their words."""

from __future__ import annotations

import random
import re

import pytest

from chargestream.llm.queries import settings

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return settings(spark)


@pytest.fixture
def documents(llm):
    """(doc_id, text) pairs as a table with the columns of `documents`."""

    def build(*rows, more: str = ""):
        full = [(i, t, "en", "src1", None if t is None else len(t)) + (("x",) if more else ()) for i, t in rows]
        return llm.createDataFrame(full, DOCUMENT + more)

    return build


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def prose(rnd: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def edited(rnd: random.Random, text: list[str], edits: int) -> list[str]:
    out = list(text)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"e{rnd.randrange(10**6)}"
    return out
