"""Small shared helpers of the ``llm`` operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: white space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return
WORD_BREAKS = "[\\x20\\x09-\\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAKS), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays. Texts of ASCII alone take the
    built-in lower-casing, which is far faster and the same for them."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not hold, in any case."""
    taken = {c.lower() for c in df.columns}
    name, k = f"__{stem}", 0
    while name.lower() in taken:
        k += 1
        name = f"__{stem}{k}"
    return name
