"""Lists of codes built from optional parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_list(*parts: Column) -> Column:
    """Array of the non-null codes, in order.

    Joining and splitting stays in generated code, where removing nulls from an array does not. Codes are identifiers,
    so they hold no comma.
    """
    joined = F.concat_ws(",", *parts)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))
