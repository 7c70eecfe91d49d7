"""Carrying the answer for a group back to its rows when one group may hold a third of them.

Every row has a salt.  While rows are combined, each group keeps a bit mask of the salts its
rows have; the answer is then copied once for each of those salts and joined on group and
salt.  A hot group's rows meet in as many places as there are salts, and there are never more
copies than rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32


def salt_of(*columns: Column) -> Column:
    """A salt from 0 to 31; rows that agree in all ``columns`` share it."""
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def salt_mask(salt: Column) -> Column:
    """Aggregate: the set of salts as bits of a whole number."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), salt))


def join_back(
    rows: DataFrame, answers: DataFrame, key: str | list[str], salt: str, mask: str, how: str = "left"
) -> DataFrame:
    """Join ``rows`` with ``answers``, one row for each ``key``, by ``key`` and ``salt``."""
    bits = F.filter(
        F.sequence(F.lit(0), F.lit(SALTS - 1)),
        lambda bit: F.call_function("shiftright", F.col(mask), bit).bitwiseAND(F.lit(1)) == 1,
    )
    keys = [key] if isinstance(key, str) else key
    return rows.join(answers.withColumn(salt, F.explode(bits)).drop(mask), [*keys, salt], how)
