"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# what separates words: space and the five ASCII controls from tab to carriage return
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column) -> Column:
    """The text, empty when null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null or blank text."""
    return F.filter(F.split(whole(text), SPACE_RUN), lambda word: word != "")


def word_count(text: Column) -> Column:
    """Number of words, without keeping them.

    A split gives one empty piece in front of leading white space, one behind trailing white space,
    and one for an empty text.
    """
    text = whole(text)
    pieces = F.split(text, SPACE_RUN)
    return (
        F.size(pieces)
        - F.when(F.element_at(pieces, 1) == "", 1).otherwise(0)
        - F.when((F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)
    ).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    return F.translate(text, UPPER, LOWER)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns of the input cannot clash with ours."""
    return df.select(*[F.col(f"`{name}`") for name in names])
