"""Mixing sources to target weights with a budget that flows down a tree.

The tree is domain, language, source. A node's budget is shared among its
children by weight, none getting more than its subtree can supply (its tokens
times `max_epochs`). What a child cannot take is shared among its siblings, and
only when all of them are full does their parent fall short, whose shortage then
goes to the parent's own siblings. The shares have a closed form: siblings are
ordered by supply per weight, and a prefix of them is full. All amounts are
whole tokens; shares round down.

A leaf with budget b and t tokens is read b div t times in full; the rest is the
longest prefix of the next epoch that fits, in an order drawn from the seed, the
epoch and the doc_id. Where the prefix ends is found on narrow rows (one per
document, then running totals in buckets, so that a leaf with a third of all
rows is many groups). It becomes one value per leaf, a filter on the documents:
their texts are never shuffled.

Defined cases: null or empty text has no tokens and is never chosen. A null
language or source is a leaf of its own (shown as null). Documents equal in
leaf and doc_id enter a prefix together or not at all. A leaf without a weight
counts as weight 1, one of weight 0 gets nothing. Extra columns are kept;
domain, n_tokens and epochs are added, replacing columns of those names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import running_total
from ..session import stage

_LEVELS = ("__domain", "__lang", "__source")
_WORD = r"[^\x20\x09-\x0D]+"
# Order keys have 60 bits; a bucket of 2**48 values is one of 4096.
_BUCKET_BITS = 48
_WHOLE = "decimal(38,0)"


DOMAINS = ("web", "news", "books", "code")


class Mix(NamedTuple):
    """Weights by name and level (1 where a name is missing), and how much to take.

    `share` is the budget as a fraction (numerator, denominator) of all tokens.
    """

    domains: dict[str, int]
    languages: dict[str, int]
    sources: dict[str, int]
    share: tuple[int, int] = (1, 2)
    max_epochs: int = 3
    seed: int = 17


DEFAULT = Mix(
    domains={"web": 4, "news": 3, "books": 2, "code": 1},
    languages={"en": 5, "de": 2, "fr": 2, "es": 1},
    sources={},
)


def domain_of(source: Column) -> Column:
    """Domain of a source by the number its name ends in; `web` without one."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int")
    return F.element_at(F.array(*map(F.lit, DOMAINS)), F.coalesce(number % len(DOMAINS), F.lit(0)) + 1)


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _weight(name: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, weight in weights.items():
        out = F.when(F.col(name) == key, F.lit(weight)).otherwise(out)
    return out.cast(_WHOLE)


def shares(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Add `given`: each row's part of its parent's `budget`, by `weight`, at most `supply`.

    One row per node; rows with the same `parents` are siblings.
    """
    family = Window.partitionBy(*parents)
    ratio = F.when(F.col("weight") > 0, F.col("supply").cast("double") / F.col("weight").cast("double"))
    ordered = family.orderBy(ratio.asc_nulls_last(), F.col(name).asc_nulls_first())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    taken = F.coalesce(F.sum("supply").over(before), F.lit(0)).cast(_WHOLE)
    full = (F.col("weight") > 0) & (
        F.col("supply") * F.sum("weight").over(onward).cast(_WHOLE) <= (F.col("budget") - taken) * F.col("weight")
    )
    marked = nodes.withColumn("full", full)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(family), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    part = marked.withColumns({"left": left.cast(_WHOLE), "open_weight": open_weight.cast(_WHOLE)})
    given = F.when(F.col("full"), F.col("supply")).when(
        F.col("weight") > 0, F.expr("(left * weight) div open_weight")
    )
    return part.withColumn("given", F.coalesce(given, F.lit(0)).cast(_WHOLE)).drop("full", "left", "open_weight")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf (its three names and `tokens`): `given`, `full_epochs` and `rest`."""
    whole = leaves.withColumns({"__root": F.lit(0), "supply": (F.col("tokens") * mix.max_epochs).cast(_WHOLE)})
    given = None
    keys = ["__root"]
    for name, weights in zip(_LEVELS, (mix.domains, mix.languages, mix.sources), strict=True):
        parents, keys = keys, [*keys, name]
        nodes = whole.groupBy(*keys).agg(F.sum("supply").cast(_WHOLE).alias("supply"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", _weight(name, weights))
        if given is None:  # the root's budget; there are as many rows as domains
            everything = nodes.withColumn("__all", F.sum("tokens").over(Window.partitionBy(*parents)))
            budget = F.expr(f"(__all * {mix.share[0]}) div {mix.share[1]}").cast(_WHOLE)
            nodes = everything.withColumn("budget", budget).drop("__all")
        else:
            nodes = nodes.join(given, parents)
        level = shares(nodes, parents, name)
        given = level.select(*keys, F.col("given").alias("budget"))
    return level.select(
        *_LEVELS,
        "tokens",
        "given",
        F.expr("given div tokens").cast("long").alias("full_epochs"),
        F.expr("given % tokens").cast("long").alias("rest"),
    )


def _order(epoch: Column, seed: int) -> Column:
    """60 bits drawn from the seed, the epoch and the doc_id."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def _named(docs: DataFrame) -> DataFrame:
    """The leaf of every row, null names as an empty marker that no name can be."""
    marker = F.lit("\x00null")
    return docs.withColumns(
        {
            "__domain": domain_of(F.col("source")),
            "__lang": F.coalesce("lang", marker),
            "__source": F.coalesce("source", marker),
        }
    )


def choose(docs: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """Rows of `docs` that the mix takes, with domain, n_tokens and epochs (how often to read the row)."""
    narrow = _named(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", *_LEVELS, n_tokens(F.col("text")).alias("tokens")
    )
    narrow = stage(narrow.where("tokens > 0"), "mixing-tokens")
    leaves = narrow.groupBy(*_LEVELS).agg(F.sum("tokens").alias("tokens"))
    planned = stage(budgets(leaves, mix), "mixing-budgets")
    keys = list(_LEVELS)
    parted = planned.where("rest > 0").select(*keys, "full_epochs", "rest")
    ordered = narrow.join(parted, keys).withColumn("__at", _order(F.col("full_epochs"), mix.seed))
    points = ordered.groupBy(*keys, "__at").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    reached = running_total(points, keys, F.col("tokens"), "__sum", order=F.col("__at"), bucket_bits=_BUCKET_BITS)
    ends = reached.where(F.col("__sum") <= F.col("rest")).groupBy(*keys).agg(F.max("__at").alias("__end"))
    limits = stage(planned.select(*keys, "full_epochs").join(ends, keys, "left"), "mixing-limits")
    added = ("domain", "n_tokens", "epochs")
    rows = _named(docs.drop(*added)).join(limits.withColumnRenamed("full_epochs", "__epochs"), keys)
    in_prefix = F.coalesce(_order(F.col("__epochs"), mix.seed) <= F.col("__end"), F.lit(False))
    rows = rows.withColumns({"epochs": F.col("__epochs") + in_prefix.cast("long"), "n_tokens": n_tokens(F.col("text"))})
    return (
        rows.where("epochs > 0 and n_tokens > 0")
        .withColumn("domain", F.col("__domain"))
        .select(*[c for c in docs.columns if c not in added], *added)
    )
