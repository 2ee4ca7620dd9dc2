"""Small ordered previews for people to look at."""

from pyspark.sql import DataFrame


def first_rows(frame: DataFrame, count: int, *order: str) -> DataFrame:
    """The first rows in the given order, kept as a top-k rather than a full sort."""
    return frame.orderBy(*order).limit(count)


def show(title: str, frame: DataFrame, schema: bool = False) -> None:
    """Print up to 20 rows, and the schema if asked."""
    print(title)
    if schema:
        frame.printSchema()
    frame.show(20)
