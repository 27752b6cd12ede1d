"""Name and text rules used by classification and drafting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The naming rules results have to agree on.
KEY_SUFFIX = "_(ID|CODE)$"
SOURCE_PREFIX = "^SRC_"
DESCRIPTION_SLOT = "TODO: describe this in business terms."


def without_key_suffix(name: Column, suffix: str = KEY_SUFFIX) -> Column:
    """Drop the trailing key marker of a reference column name."""
    return F.regexp_replace(name, suffix, "")


def without_source_prefix(name: Column, prefix: str = SOURCE_PREFIX) -> Column:
    """Drop the leading source marker of a table name."""
    return F.regexp_replace(name, prefix, "")


def display_name(name: Column) -> Column:
    """Underscores to blanks, every word capitalised."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def one_line(text: Column) -> Column:
    """Collapse every run of white space, so that text cannot leave a one-line comment."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def sql_literal_body(text: Column) -> Column:
    """Text made safe inside a single-quoted SQL literal."""
    return F.replace(text, F.lit("'"), F.lit("''"))
