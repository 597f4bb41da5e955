"""Exact orientation of a point to a line, on plain double columns.

The cross product is first taken in doubles with a bound on its rounding error.  Only where
the bound leaves the sign open (points on, or within rounding of, the line) is it taken again
without error: each product is split into a double and its exact rounding error, and the
twelve parts are added into an expansion, a list of doubles that overlap nowhere and whose
exact sum is the cross product.  The sign is that of the largest part.

Exact for coordinates whose products neither overflow nor fall below the smallest normal
double (any geographic or projected coordinate).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: unit round-off of doubles, the error bound of the plain cross product, and the
# factor that splits a double's 53 bits in two halves
EPSILON = 2.0 ** -53
ERROR_BOUND = (3.0 + 16.0 * EPSILON) * EPSILON
SPLITTER = 2.0 ** 27 + 1


def _halves(a: Column) -> tuple[Column, Column]:
    c = a * F.lit(SPLITTER)
    high = c - (c - a)
    return high, a - high


def product(a: Column, b: Column) -> list[Column]:
    """``a * b`` as its rounding error and the rounded product."""
    p = a * b
    (ah, al), (bh, bl) = _halves(a), _halves(b)
    return [al * bl - (((p - ah * bh) - al * bh) - ah * bl), p]


def _grow(parts: Column, b: Column) -> Column:
    """An expansion (smallest part first) plus a double."""
    def step(acc: Column, e: Column) -> Column:
        total = acc["q"] + e
        other = total - acc["q"]
        error = (acc["q"] - (total - other)) + (e - other)
        return F.struct(total.alias("q"), F.concat(acc["h"], F.array(error)).alias("h"))

    return F.aggregate(parts, F.struct(b.alias("q"), F.array().cast("array<double>").alias("h")), step,
                       lambda acc: F.concat(acc["h"], F.array(acc["q"])))


def exact_sign(parts: list[Column]) -> Column:
    """-1, 0 or 1: the sign of the exact sum of doubles."""
    whole = F.aggregate(F.array(*parts), F.array().cast("array<double>"), _grow)
    largest = F.try_element_at(F.filter(whole, lambda p: p != 0), F.lit(-1))
    return F.coalesce(F.signum(largest), F.lit(0.0))


def side(x1: Column, y1: Column, x2: Column, y2: Column, px: Column, py: Column) -> Column:
    """1.0 where the point lies left of the line from (x1, y1) to (x2, y2), -1.0 right, 0.0 on it."""
    left, right = (x1 - px) * (y2 - py), (y1 - py) * (x2 - px)
    rough = left - right
    minus = lambda p: [-e for e in p]
    exact = exact_sign([*product(x1, y2), *minus(product(y1, x2)), *product(x2, py), *minus(product(y2, px)),
                        *product(px, y1), *minus(product(py, x1))])
    return F.when(F.abs(rough) > F.lit(ERROR_BOUND) * (F.abs(left) + F.abs(right)), F.signum(rough)).otherwise(exact)
