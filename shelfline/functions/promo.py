"""PRJ-8: promo-like columns as True, False or NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import numeric

# Words read as a promo state.
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]

_NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)$"


def promo_flag(df: DataFrame, promo_col: str) -> Column:
    """Three-valued promo flag of a boolean, numeric or text column.

    Text is read as numbers when any value of the column is a number, else by its words. That choice needs the whole
    column: it is one scalar subquery. Other types are decided by the schema alone.
    """
    kind = df.schema[promo_col].dataType
    value = F.col(promo_col)
    if isinstance(kind, T.BooleanType):
        return value
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value != 0)
    if numeric(kind):
        return value != 0

    word = F.lower(F.trim(value.cast("string")))
    is_number = word.rlike(_NUMBER)
    any_number = df.agg(F.coalesce(F.bool_or(is_number), F.lit(False))).scalar()
    as_number = F.when(is_number, word.try_cast("double") != 0)
    as_word = F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)
    return F.when(any_number, as_number).otherwise(as_word)
