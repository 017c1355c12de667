"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: words between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_in(text: Column, pattern: str) -> Column:
    """Words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores ahead as it takes to be none of the frame's, whatever their case."""
    taken = {c.lower() for c in df.columns}
    depth = 1
    while any("_" * depth + n.lower() in taken for n in names):
        depth += 1
    return ["_" * depth + n for n in names]


def wide_hash(*values: Column) -> Column:
    """128 bits of hash, so that equal hashes stand for equal values at any corpus size."""
    return F.struct(F.xxhash64(F.lit(1), *values).alias("a"), F.xxhash64(F.lit(2), *values).alias("b"))
