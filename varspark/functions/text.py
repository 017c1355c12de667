"""Text expressions for manifests, paths and logs (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nth_field(text: Column, n: int, sep: str = ",") -> Column:
    """The n-th delimited field, counted from 1; NULL beyond the last."""
    return F.try_element_at(F.split(text, _literal(sep)), F.lit(n))


def field_from_end(text: Column, n: int, sep: str = " ") -> Column:
    """The n-th field counted from the end; NULL beyond the first."""
    return F.try_element_at(F.split(text, _literal(sep)), F.lit(-n))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    """Everything before the last slash; '.' for a bare name."""
    return F.when(path.contains("/"), F.regexp_extract(path, r"^(.*)/[^/]*$", 1)).otherwise(F.lit("."))


def strip_suffix(text: Column, suffix: str) -> Column:
    return F.regexp_replace(text, _literal(suffix) + "$", "")


def stem(path: Column) -> Column:
    """Base name up to its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def zero_padded(number: Column, width: int = 4) -> Column:
    """Index with leading zeros; longer numbers stay whole (``lpad`` would cut them)."""
    return F.format_string(f"%0{width}d", number.cast("long"))


def split_rows(text: Column, sep: str = ";") -> Column:
    """One row per delimited part."""
    return F.explode(F.split(text, _literal(sep)))


def swap_separator(text: Column, old: str, new: str) -> Column:
    return F.translate(text, old, new)


def contains_ci(text: Column, word: str) -> Column:
    return F.lower(text).contains(word.lower())


def captured(text: Column, pattern: str, group: int = 1) -> Column:
    """Regex capture that is NULL, not '', when the pattern does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _literal(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c not in "_ \t" else c for c in text)
