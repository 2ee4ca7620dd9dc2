"""Nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. It is posted in the
inverted files of its first pivots; a query looks into the files of more of its
own. Within a file the footrule distance of the two orders ranks the vectors,
and the nearest share of them is ranked again by the true inner product.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.frames import parts, stored
from gaugeflow.llm.vectors import encoded_vectors, matrix

_BLOCK_ROWS = 4096
_BLOCK_QUERIES = 1024
_LEAST_PIVOTS, _MOST_PIVOTS = 128, 4096
_POSTED = "file int, block int, vec_id long, vec binary, pivots binary"
_HITS = "query_id long, vec_id long, score double"


def pivots_for(rows: int) -> int:
    """Twelve times the cube root: files grow slower than the table, and their share falls."""
    return min(_MOST_PIVOTS, max(_LEAST_PIVOTS, math.ceil(12 * rows ** (1 / 3))))


def _pivots(rows: DataFrame, number: int, seed: int) -> dict[int, np.ndarray]:
    """Up to ``number`` vectors for each vector length, drawn by hash."""
    drawn: dict[int, np.ndarray] = {}
    lengths = rows.select((F.length("vec") / 8).cast("int").alias("size")).distinct().collect()
    for (size,) in lengths:
        some = rows.where(F.length("vec") == 8 * size).select("vec").distinct()
        some = some.orderBy(F.xxhash64(F.lit(seed), "vec"), "vec").limit(number)
        drawn[size] = matrix([bytes(r["vec"]) for r in some.collect()])
    return drawn


def _poster(pivots: dict[int, np.ndarray], length: int, files: int):
    """Rows for the first ``files`` files of each vector, with ``length`` pivots in order."""

    def run(batches):
        for batch in batches:
            ids, blobs = batch.column("vec_id").to_pylist(), batch.column("vec").to_pylist()
            groups: dict = {}
            for row, blob in enumerate(blobs):
                groups.setdefault(len(blob) // 8, []).append(row)
            for size, rows in groups.items():
                points = pivots[size]
                order = np.argsort(-(matrix([blobs[r] for r in rows]) @ points.T), axis=1, kind="stable")
                order = order[:, :length].astype("<u2")
                for place in range(min(files, order.shape[1])):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(order[:, place].astype(np.int32) + size * 65536, pa.int32()),
                            pa.array([0] * len(rows), pa.int32()),
                            pa.array([ids[r] for r in rows], pa.int64()),
                            pa.array([blobs[r] for r in rows], pa.binary()),
                            pa.array([o.tobytes() for o in order], pa.binary()),
                        ],
                        names=["file", "block", "vec_id", "vec", "pivots"],
                    )

    return run


def _places(blobs: list[bytes], width: int) -> np.ndarray:
    """For every pivot its place in each order; pivots not in it come after the last."""
    order = np.frombuffer(b"".join(blobs), dtype="<u2").reshape(len(blobs), -1)
    places = np.full((len(blobs), width), order.shape[1], dtype=np.int16)
    np.put_along_axis(places, order.astype(np.int64), np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return np.ascontiguousarray(places.T)


def _footrules(places: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Footrule distances of the ``places`` of many orders to one, less a constant.

    An order's places from its end add up to the same in every order, so a pivot that
    only the other order has need not be looked at.
    """
    theirs = places[order]
    own = np.arange(len(order), dtype=np.int16)[:, None]
    return (np.abs(theirs - own) + theirs).sum(axis=0, dtype=np.int32)


def _searcher(pivots: dict[int, np.ndarray], nearest: int, rerank: float):
    widths = {size: len(points) for size, points in pivots.items()}

    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            width = widths[key[0] // 65536]
            ids, vectors = rows["vec_id"].to_numpy(), matrix(rows["vec"].tolist())
            places = _places(rows["pivots"].tolist(), width)
            asked = [np.frombuffer(blob, dtype="<u2") for blob in queries["pivots"]]
            most = max(nearest + 1, int(np.ceil(rerank * len(ids))))
            for number, blob in enumerate(queries["vec"]):
                query_id, query = queries["vec_id"].iat[number], matrix([blob])[0]
                near = np.arange(len(ids))
                if most < len(ids):
                    footrule = _footrules(places, asked[number])
                    near = np.flatnonzero(footrule <= np.partition(footrule, most - 1)[most - 1])
                near = near[ids[near] != query_id]
                score = vectors[near] @ query
                if len(near) > nearest:
                    last = np.partition(score, -nearest)[-nearest]
                    near = near[score >= last - 1e-9 * max(1.0, abs(last))]
                # The same sum for equal vectors, so that ties are ties.
                score = (vectors[near] * query).sum(axis=1)
                first = np.lexsort((ids[near], -score))[:nearest]
                found.append((np.full(len(first), query_id), ids[near][first], score[first]))
        columns = [np.concatenate(c) if found else [] for c in (list(zip(*found)) or [[]] * 3)]
        frame = pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))
        return frame.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def _blocks(frame: DataFrame, rows: int) -> dict[int, int]:
    """Blocks of ``rows`` rows for every file (there are as many as pivots)."""
    return {r["file"]: parts(r["count"], rows) for r in frame.groupBy("file").count().collect()}


def _of_file(blocks: dict[int, int]) -> Column:
    """Number of blocks of the row's file."""
    if not blocks:
        return F.lit(1)
    pairs = (F.lit(x) for pair in blocks.items() for x in pair)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("file")), F.lit(1))


def _search(queries: DataFrame, posted: DataFrame, run) -> DataFrame:
    """Every query block of a file meets every row block of it; best rows of each."""
    of_rows = _of_file(_blocks(posted, _BLOCK_ROWS))
    of_queries = _of_file(_blocks(queries, _BLOCK_QUERIES))
    mark = F.xxhash64("vec_id", "file")
    rows = posted.withColumn("block", F.pmod(mark, of_rows).cast("int"))
    rows = rows.withColumn("asked", F.explode(F.sequence(F.lit(0), of_queries - 1)))
    asked = queries.withColumn("asked", F.pmod(mark, of_queries).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), of_rows - 1)))
    keys = ["file", "block", "asked"]
    return asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(run, _HITS)


def _best(hits: DataFrame, nearest: int) -> DataFrame:
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def nearest_vectors(
    embeddings: DataFrame,
    is_query,
    nearest: int = 20,
    pivots: int | None = None,
    order: int = 64,
    posted_in: int = 8,
    asked_in: int = 40,
    rerank: float = 0.35,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id and score of the rows nearest to each query row.

    Queries are the rows where ``is_query`` holds; candidates are all rows with
    another id. Nearness is the inner product in double precision, ties go to the
    smaller id. Rows without a usable vector or id (see ``encoded_vectors``) take
    no part; vectors of different lengths never meet; repeated rows are one.
    Other columns are ignored, an empty table gives an empty result.

    Vectors stand in the files of their ``posted_in`` nearest of ``pivots`` pivots
    (a bounded sample, by default ``pivots_for`` the rows); queries ask ``asked_in`` files and rank the ``rerank`` share
    with the least footrule distance again. A query that finds fewer than
    ``nearest`` rows asks all files and ranks everything.
    """
    rows = encoded_vectors(embeddings, label=None).where("vec IS NOT NULL")
    rows = stored(rows.select("vec_id", "vec").dropDuplicates(["vec_id", "vec"]), "vectors")
    pivots = pivots or pivots_for(rows.count())
    points = _pivots(rows, pivots, seed)
    posted = stored(rows.mapInArrow(_poster(points, order, posted_in), _POSTED), "posted")
    asking = rows.where(is_query)
    asked = stored(asking.mapInArrow(_poster(points, order, asked_in), _POSTED), "asked")
    hits = _search(asked, posted, _searcher(points, nearest, rerank))
    best = stored(_best(hits, nearest), "best")

    full = best.where(F.col("rank") == nearest).select(F.col("query_id").alias("vec_id"))
    short = asking.join(full, "vec_id", "left_anti")
    if short.isEmpty():
        return best
    short = stored(short.mapInArrow(_poster(points, pivots, pivots), _POSTED), "short")
    rest = _best(_search(short, stored(rows.mapInArrow(_poster(points, pivots, 1), _POSTED), "all"), _searcher(points, nearest, 1.0)), nearest)
    return best.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").union(rest)
