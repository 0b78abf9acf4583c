"""Rows as JSON lines, for the eye."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines(rows: DataFrame, low: int, high: int) -> DataFrame:
    """value: a JSON line for each row of an ordinal range, in order."""
    from ..operators.alignments import row_range

    return row_range(rows, low, high).orderBy("ordinal").select(F.to_json(F.struct("*")).alias("value"))
