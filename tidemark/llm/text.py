"""Column expressions that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters between words: space and the controls from tab to carriage return.
SPACE = "[\\x09-\\x0D\\x20]+"
BLANKS = " \t\n\x0b\x0c\r"
#: What may precede whole texts when rows are told apart by hash.
NO_TEXT = ""


def whole(text: Column) -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(text, F.lit(NO_TEXT))


def words(text: Column) -> Column:
    """Array of the maximal runs of characters outside :data:`SPACE`."""
    return F.array_remove(F.split(whole(text), SPACE), "")


def without(text: Column, characters: str) -> Column:
    """The text less every occurrence of the given characters."""
    return F.translate(text, characters, "")
