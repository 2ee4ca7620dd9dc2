"""The three text keys of the data model, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_key(line: str | Column = "value") -> Column:
    """Topic key of a line: the text before its first comma."""
    return F.substring_index(line, ",", 1)


def row_key() -> Column:
    """Row key of a reading: ``resid_date time``."""
    return F.concat("resid", F.lit("_"), "date", F.lit(" "), "time")


def day_key(rowkey: str | Column = "rowkey") -> Column:
    """Day key of a row key: the text before its first space."""
    return F.substring_index(rowkey, " ", 1)


def day_folder(rowkey: str | Column = "rowkey") -> Column:
    """Name of the folder that keeps a row key's day.

    It follows from the day key alone: the text after its last ``_``, other
    signs than letters and digits replaced. Days that share a name share a
    folder, which changes no result.
    """
    day = F.substring_index(day_key(rowkey), "_", -1)
    return F.concat(F.lit("d"), F.substring(F.regexp_replace(day, "[^0-9A-Za-z]", "-"), 1, 40))
