"""Words of a text, and expressions over arrays that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words (all of ASCII but digits and lower-case letters).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BLOCK = 256


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case; a null text has none."""
    lowered = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def grams(hashes: str, size: int) -> str:
    """A hash of every run of ``size`` consecutive word hashes, as SQL."""
    if size == 1:
        return hashes
    items = ", ".join(f"{hashes}[i + {j}]" if j else f"{hashes}[i]" for j in range(size))
    return (
        f"IF(size({hashes}) < {size}, CAST(array() AS ARRAY<BIGINT>),"
        f" transform(sequence(0, size({hashes}) - {size}), i -> xxhash64({items})))"
    )


def windowed_least(values: str, size: int) -> str:
    """The least of every ``size`` consecutive values, as SQL."""
    if size == 1:
        return values
    items = ", ".join(f"{values}[i + {j}]" if j else f"{values}[i]" for j in range(size))
    return (
        f"IF(size({values}) < {size}, CAST(array() AS ARRAY<BIGINT>),"
        f" transform(sequence(0, size({values}) - {size}), i -> least({items})))"
    )


def running_totals(lengths: str) -> str:
    """The sum of the values before each value of an array<bigint>, as SQL.

    Totals are built in blocks: to append to one long array would copy it every time.
    """
    block = (
        f"aggregate(slice({lengths}, CAST(b * {BLOCK} + 1 AS INT), {BLOCK}),"
        " struct(t.at AS at, CAST(array() AS ARRAY<BIGINT>) AS out),"
        " (u, x) -> struct(u.at + x AS at, concat(u.out, array(u.at)) AS out))"
    )
    return (
        f"IF(size({lengths}) = 0, CAST(array() AS ARRAY<BIGINT>), aggregate("
        f"sequence(0, (size({lengths}) - 1) div {BLOCK}),"
        " struct(0L AS at, CAST(array() AS ARRAY<ARRAY<BIGINT>>) AS out),"
        f" (t, b) -> transform(array({block}),"
        " r -> struct(r.at AS at, concat(t.out, array(r.out)) AS out))[0],"
        " t -> flatten(t.out)))"
    )
