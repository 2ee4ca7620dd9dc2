"""Strict, eager parse of sensor lines."""

from pyspark.sql import DataFrame

from gaugeflow.schemas import ID_FIELDS, MEASURES

# Fixed value: spellings of NaN and infinity that Spark casts but that are not
# numbers in a sensor line, where only ``NaN`` and ``Infinity`` count.
_FOREIGN_LITERAL = (
    r"(^|,)[\x00-\x20]*[+-]?"
    r"(?!(NaN|Infinity)[\x00-\x20]*(,|$))(?i:nan|inf|infinity)"
    r"[\x00-\x20]*(,|$)"
)

_MEASURE_FIELDS = f"slice(_fields, {len(ID_FIELDS) + 1}, {len(MEASURES)})"
# Null as soon as one of the six is missing or not a number.
_TOTAL = " + ".join(f"get(_numbers, {i})" for i in range(len(MEASURES)))
_VALID = (
    f"abs({_TOTAL}) < double('Infinity') OR {_TOTAL} IS NOT NULL "
    f"AND NOT array_join({_MEASURE_FIELDS}, ',') RLIKE r'{_FOREIGN_LITERAL}'"
)


def parse_sensor(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Split each ``value`` at commas into the nine typed sensor columns.

    Columns named in ``keep`` are carried along. A line with fewer than nine
    fields, with an empty or non-numeric measure, or a null line fails the
    job, whatever the query on top uses: the nine columns come out of one
    generator, so Spark neither prunes a single field's check nor moves a
    filter on the result (kept columns included) below it. The same barrier
    makes every line split and cast once, also under a filter. Fields after
    the ninth are ignored and quotes are ordinary characters.
    """
    reading = ", ".join(
        [f"'{name}', {name}" for name in keep]
        + [f"'{name}', get(_fields, {i})" for i, name in enumerate(ID_FIELDS)]
        + [f"'{name}', get(_numbers, {i})" for i, name in enumerate(MEASURES)]
    )
    return (
        lines.selectExpr("*", "split(value, ',') AS _fields")
        .selectExpr("*", f"try_cast({_MEASURE_FIELDS} AS array<double>) AS _numbers")
        .selectExpr(
            f"inline(array(CASE WHEN {_VALID} THEN named_struct({reading}) "
            "ELSE raise_error("
            "'malformed sensor line: ' || coalesce(value, '<null>')) END))"
        )
    )
