"""Text predicates and tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters a clean text may consist of.
CLEAN_CHARACTERS = (
    "[一-龥a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)\"]+"
)

NOT_WORD = "[^\\p{L}\\p{N}]+"


def is_clean(text: Column) -> Column:
    """True when the whole text consists of the characters above."""
    return text.rlike("^" + CLEAN_CHARACTERS + "$")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order, empty ones dropped."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def last_part(text: Column, separator: str = ",") -> Column:
    """Text after the last separator; trailing separators do not count."""
    trimmed = F.regexp_replace(text, separator + "+$", "")
    return F.element_at(F.split(trimmed, separator), -1)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def first_upper(text: Column) -> Column:
    """The text with its first letter in upper case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)))


def first_lower(text: Column) -> Column:
    """The text with its first letter in lower case."""
    return F.concat(F.lower(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)))
