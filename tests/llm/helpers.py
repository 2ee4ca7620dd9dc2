"""Small tables with the cases every operator must bear."""

EXTRA = ", content binary, bands int, copy string, n int, mark long, key int, score int, row int, band int, id long, a long"
CLASHING = (None, 7, "x", None, 1, 2, 3, 4, 5, 6, 7)
DOCS = "doc_id long, text string, lang string, source string, n_chars long" + EXTRA
VECTORS = "vec_id long, embedding array<float>, label int" + EXTRA
PAGES = "page_id long, url string, html string" + EXTRA


def table(spark, rows, schema):
    """Rows of a schema's own columns with the clashing ones filled in."""
    return spark.createDataFrame([(*row, *CLASHING) for row in rows], schema)


def docs(spark, rows):
    return table(spark, rows, DOCS)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
