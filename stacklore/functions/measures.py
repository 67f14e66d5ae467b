"""Column functions for numbers: bands, lookups, exact means, similarity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(key: Column, values: Mapping) -> Column:
    """Literal mapping; keys not listed give NULL."""
    first, *rest = values.items()
    chain = F.when(key == first[0], F.lit(first[1]))
    return reduce(lambda acc, kv: acc.when(key == kv[0], F.lit(kv[1])), rest, chain)


def band(value: Column, edges: Sequence, labels: Sequence[str]) -> Column:
    """Half-open bands: `labels[i]` below `edges[i]`, the last label for the rest and for NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges")
    chain = reduce(
        lambda acc, el: acc.when(value < el[0], F.lit(el[1])),
        list(zip(edges, labels))[1:],
        F.when(value < edges[0], F.lit(labels[0])),
    )
    return chain.otherwise(F.lit(labels[-1]))


def exact_mean(total: Column, count: Column) -> Column:
    """total / count rounded half-up to 2 places in one step; NULL for no rows.

    `total` is a decimal sum, so the quotient keeps about 20 fractional digits and the
    mean is not rounded twice, nor does it pass through binary floating point.
    """
    ratio = F.try_divide(total.cast("decimal(20,2)"), count.cast("decimal(18,0)"))
    return F.round(ratio, 2).cast("double")


def mean2(value: Column) -> Column:
    """Average of a decimal or integer column, rounded half-up to 2 places."""
    exact = value.cast("decimal(10,2)")
    return exact_mean(F.sum(exact), F.count(exact))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity of two array columns; NULL when either has no length."""
    norm = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.try_divide(dot(left, right), norm)


def plain_price(price: Column) -> Column:
    """A decimal(10,2) the way a float prints: at least one decimal, no trailing zero after it."""
    return F.regexp_replace(price.cast("decimal(10,2)").cast("string"), r"(\.\d)0$", "$1")
