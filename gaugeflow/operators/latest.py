"""Newest version per row key, of any versions or of a base and a few later ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(
    versions: DataFrame, columns: tuple[str, ...], order: str | Column
) -> DataFrame:
    """The given columns of each row key's row that is last in ``order``.

    One ``max_by`` per column gives buffers of fixed width, so this stays a
    hash aggregate, and unused columns are pruned. Repeats of a hot key merge
    before the shuffle.
    """
    return versions.groupBy("rowkey").agg(
        *[F.max_by(name, order).alias(name) for name in columns]
    )


def newest_over_base(
    base: DataFrame, tail: DataFrame, columns: tuple[str, ...], order: str
) -> DataFrame:
    """As ``newest`` of ``base`` and ``tail`` together, without shuffling the base.

    ``base`` has one row per row key. Only the tail's keys and orders are broadcast, so
    the caller must have checked the size of these. Where both hold a key with an equal
    order, the rows are the same. The base's keys are read a second time to find the
    tail's rows that are older than the base.
    """
    last = F.broadcast(tail.groupBy("rowkey").agg(F.max(order).alias("later")))
    kept = base.join(last, "rowkey", "left").where(
        F.col("later").isNull() | (F.col("later") < F.col(order))
    )
    older = base.select("rowkey", order).join(last, "rowkey").where(F.col("later") < F.col(order))
    fresh = newest(tail, columns, order).join(F.broadcast(older.select("rowkey")), "rowkey", "left_anti")
    return kept.select("rowkey", *columns).unionByName(fresh)
