"""Small scalar helpers shared by the sources and jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words accepted for a boolean option.
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]


def parse_flag(value: Column | str) -> Column:
    """Boolean from an option word; any other word is an error."""
    value = F.col(value) if isinstance(value, str) else value
    word = F.lower(value)
    return (
        F.when(word.isin(TRUE_WORDS), F.lit(True))
        .when(word.isin(FALSE_WORDS), F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit("not a boolean word: "), word)).cast("boolean"))
    )


def run_name(path: Column | str, suffix: str = "") -> Column:
    """Run name of a forecast file: base name without its last extension, plus a suffix."""
    path = F.col(path) if isinstance(path, str) else path
    base = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.concat(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""), F.lit(suffix))


def nan_to_null(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(value), value)
