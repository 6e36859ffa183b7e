"""Joins on keys of which one may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32
MAX_BROADCAST_ROWS = 100_000


def expand_join(
    many: DataFrame, one: DataFrame, on: str, salt_by: str | Column, small: bool, how: str = "inner"
) -> DataFrame:
    """Join many rows per key to one row per key: broadcast when ``one`` is small, salted otherwise.

    ``small`` comes from a count of the keys that the caller has at hand: counting ``one`` itself would run
    the whole job before it. ``salt_by`` is a column of ``many``, or several as a struct, that spreads the rows of one key.
    """
    if small:
        return many.join(F.broadcast(one), on, how)
    salt, taken = "_salt", {c.lower() for c in (*many.columns, *one.columns)}
    while salt in taken:
        salt += "_"
    salted_many = many.withColumn(salt, F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    salted_one = one.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted_many.join(salted_one, [on, salt], how).drop(salt)


#: Keys with more than this part of all rows, so fewer keys than this, are hot.
HOT_SHARE = 1024


def hot_join(many: DataFrame, one: DataFrame, on: str, rows: str) -> DataFrame:
    """``many`` with the row of stored ``one`` for its key; ``one.rows`` is how many rows of ``many`` the key has.

    Rows of hot keys meet a broadcast of fewer than HOT_SHARE rows, so no task gets more than that share from one key.
    """
    total = one.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    hot = F.col(rows) * HOT_SHARE > total
    few = F.broadcast(one.where(hot))
    rest = many.join(few.select(on), on, "left_anti").join(one.where(~hot), on)
    return many.join(few, on).unionByName(rest).drop(rows)
