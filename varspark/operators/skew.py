"""Equi-joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Adaptive execution splits skewed joins; salts are for a key that is measured to need them.
SALTS = 1
SALT = "_salt"


def add_salt(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """Tag rows with a number that depends only on their values.

    A hash of the row, unlike a random number or a row id, gives the same tag
    when a lost task is run again.
    """
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return df.withColumn(SALT, F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int"))


def repeat_salts(df: DataFrame, salts: int = SALTS) -> DataFrame:
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def spread_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join where each key of ``big`` is split over ``salts`` partitions; a plain join unless asked.

    ``small`` is repeated once per salt, so results are those of a plain join.
    No hint is given: Spark broadcasts ``small`` only when its own size check
    allows, and that check bounds what is sent to ``salts`` times its threshold.
    """
    if salts == 1:
        return big.join(small, list(keys), how)
    return add_salt(big, salts).join(repeat_salts(small, salts), [*keys, SALT], how).drop(SALT)
