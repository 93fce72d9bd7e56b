"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First letters of the elements that ion names begin with (fixed value).
ION_LETTERS = "HCOKSNV"


def is_ion(name: Column | str, letters: str = ION_LETTERS) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return c.rlike(f"^[{letters}]")


def without_suffix(name: Column | str, length: int = 4) -> Column:
    """A name without its last letters, such as ``_ppb``."""
    c = F.col(name) if isinstance(name, str) else name
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - length, F.lit(0)))


def flag_text(flags: Column) -> Column:
    """Flag values as text: each once, in the order of numbers, joined by commas; ``0`` if none."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(flags)), ","), F.lit("")), F.lit("0"))


def tag(tags: Column | str, key: str, default: str | None = None) -> Column:
    """An entry of a map of tags, or a default."""
    c = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(F.try_element_at(c, F.lit(key)), F.lit(default).cast("string"))
