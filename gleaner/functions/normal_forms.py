"""Exact Unicode forms, for the distinct values of small vocabularies: Arrow batches through the Unicode database.

The Column functions of `text` stay in the JVM and know no compatibility forms; where two spellings must be one key in every script,
these are used, on values that have been made distinct."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import dictionaries


@F.pandas_udf(StringType())
def _normal_text(values: pd.Series) -> pd.Series:
    return values.map(dictionaries.normal_text, na_action="ignore")


@F.pandas_udf(StringType())
def _spelling_key(values: pd.Series) -> pd.Series:
    return values.map(dictionaries.spelling_key, na_action="ignore")


def normal_text(value: Column | str) -> Column:
    """Composed characters, white space collapsed and trimmed; blank and null become null."""
    return F.nullif(_normal_text(value), F.lit(""))


def exact_label_key(value: Column | str) -> Column:
    """Compatibility forms and case folded, so that spellings of one label have one key."""
    return _spelling_key(value)
