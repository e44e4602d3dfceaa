"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word boundary: any run of characters that are neither letters nor digits.
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def capitalize_first(c: Column) -> Column:
    """Upper-case the first character, lower-case the rest (not initcap)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def words(c: Column) -> Column:
    """Lower-cased words of a whole text, empty tokens removed."""
    return F.filter(F.split(F.lower(c), WORD_SPLIT), lambda w: F.length(w) > 0)


def token_sort(c: Column) -> Column:
    """Whitespace tokens, sorted, joined by one space."""
    toks = F.filter(F.split(F.trim(c), r"\s+"), lambda w: F.length(w) > 0)
    return F.array_join(F.array_sort(toks), " ")
