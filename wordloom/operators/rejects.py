"""Token ids in text form: good ones and a table of rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a decimal number with an optional sign, point and exponent.
NUMBER = r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"

#: Largest id that single precision holds exactly.
EXACT_FLOAT = 1 << 24

NOT_A_NUMBER = "not a number"
UNKNOWN_ID = "unknown id"


def token_id_from_text(text: Column) -> Column:
    """``"438.0"`` -> 438 through single precision, ``"-3.7"`` -> -4; NULL for text that is no number.

    From 2^24 on, where single precision leaves ids out, numbers are read in double.
    """
    single = text.try_cast("float")
    number = F.when(F.abs(single) < EXACT_FLOAT, single.cast("double")).otherwise(text.try_cast("double"))
    return F.floor(F.when(text.rlike(NUMBER), number)).try_cast("int")


def split_rejects(raw: DataFrame, vocabulary: DataFrame, column: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(rows with a known ``token_id``, rows with a ``reason``) of rows with an id in text form.

    Only rows that hold a number meet the vocabulary, so text that is none never gathers under one
    join key. Ids in ``vocabulary`` are unique; count equal rows before calling.
    """
    text = F.col(column)
    parsed = raw.withColumn("token_id", token_id_from_text(text))
    known = vocabulary.select("token_id", F.lit(True).alias("_known"))
    checked = parsed.where("token_id IS NOT NULL").join(known, "token_id", "left")
    good = checked.where("_known").select(*raw.columns, "token_id")
    unknown = checked.where("_known IS NULL").select(*raw.columns, F.lit(UNKNOWN_ID).alias("reason"))
    reason = F.when(text.rlike(NUMBER), UNKNOWN_ID).otherwise(NOT_A_NUMBER)
    unread = parsed.where("token_id IS NULL").select(*raw.columns, reason.alias("reason"))
    return good, unread.unionByName(unknown)
