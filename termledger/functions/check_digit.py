"""Check digits of component identifiers as built-in column expressions.

An identifier is valid when its digits, read from the right, permuted by
position and multiplied in the dihedral group of order ten, give zero. The
whole chain is integer arithmetic on the id column plus lookups in constant
arrays, so it stays inside generated code; there is no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published check-digit tables.
MULTIPLICATION = [
    "0123456789",
    "1234067895",
    "2340178956",
    "3401289567",
    "4012395678",
    "5987604321",
    "6598710432",
    "7659821043",
    "8765932104",
    "9876543210",
]
PERMUTATION = [
    "0123456789",
    "1576283094",
    "5803796142",
    "8916043527",
    "9453126870",
    "4286573901",
    "2793806415",
    "7046913258",
]
INVERSE = "0432156789"

# A bigint has at most this many decimal digits.
LONGEST_ID = 19


def _constant(digits) -> Column:
    """A constant array, folded from one text literal so that the expression
    stays small for the planner."""
    return F.split(F.lit(",".join(str(d) for d in digits)), ",").cast("array<int>")


def _multiply(x: int, y: int) -> int:
    return int(MULTIPLICATION[x][y])


def _pair_table(place: int) -> list[int]:
    """Group product of the two digits at ``place`` and the place left of it.

    Entries 0-99 are for pairs inside the identifier; entries 100-199 for the
    pair that holds its first digit, where a left zero is no digit.
    """
    right, left = PERMUTATION[place % 8], PERMUTATION[(place + 1) % 8]
    inside = [_multiply(int(right[v % 10]), int(left[v // 10])) for v in range(100)]
    return inside + [int(right[v]) for v in range(10)] + inside[10:]


def _product(identifier: Column, offset: int) -> Column:
    """Group product over the digits, the rightmost being at place ``offset``.

    The group is associative, so digits are taken two at a time; that halves
    the chain and keeps the generated method small enough to be compiled.
    Pairs left of the first digit contribute zero, the group's identity.
    """
    number = identifier.try_cast("bigint")
    multiplied = _constant("".join(MULTIPLICATION))
    product = F.lit(0)
    for place in range(0, LONGEST_ID, 2):
        table = _pair_table(place + offset)
        if place:
            table[100] = 0
        pair = F.call_function("div", number, F.lit(10**place)) % 100
        last = place + 2 > LONGEST_ID - 1
        leading = F.lit(100) if last else F.when(number < 10 ** (place + 2), 100).otherwise(0)
        product = F.get(multiplied, product * 10 + F.get(_constant(table), pair + leading))
    return product


def check_remainder(identifier: Column) -> Column:
    """Zero for a valid identifier, null for one that is null or no bigint."""
    return _product(identifier, offset=0).alias("check_digit")


def check_digit(body: Column) -> Column:
    """The digit that makes ``body`` followed by it a valid identifier."""
    return F.get(_constant(INVERSE), _product(body, offset=1)).alias("check_digit")
