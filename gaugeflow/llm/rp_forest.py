"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Every tree splits recursively at medians along random directions; vectors close
to a split go to both sides. Vectors meet in leaves, where all are compared. A
leaf of any size is compared in blocks, so that a task holds two blocks at most.
The first splits are fitted on a sample of all vectors; leaves that turn out large
are split again by trees fitted on samples of their own, until they are small or a
split would not make less work, as among vectors that nearly all link.
Equal vectors stand for each other; a pair that shares several leaves counts in
the least of them only, so links are summed per vector and never listed.
"""

import json
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.components import components
from gaugeflow.llm.frames import sized_broadcast, slices, stored
from gaugeflow.llm.vectors import encoded_vectors, matrix

#: The trees are fitted on about this many vectors; all vectors are placed in them.
SAMPLE_ROWS = 40_000
_MIN_NODE_SAMPLE = 16
#: A leaf over this many times ``leaf_rows`` is split again, on about so many rows of its own.
_LARGE = 4
_NODE_ROWS = 4096
#: Two children with a larger share of the rows than this hold more pairs than their parent.
_BREAK_EVEN = 0.7
_BLOCK_ROWS = 1024
_LEAF_COLUMNS = 4096
_ROWS = "kin binary, leaf long, id long, rep long, n long, vec binary"
_LEAVES = f"{_ROWS}, leaves array<long>"
_FOUND = "id long, links long, root long"


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _directions(trees: int, depth: int, size: int, *seeds: int) -> np.ndarray:
    """One unit direction per tree and level."""
    drawn = np.random.default_rng([*seeds, size]).standard_normal((trees, depth, size))
    return drawn / np.linalg.norm(drawn, axis=2, keepdims=True)


def _split(places: np.ndarray, cut: float, spill: float):
    return places <= cut + spill, places >= cut - spill


def _grow(unit: np.ndarray, directions: np.ndarray, spill: float, rate: float, leaf_rows: int) -> dict:
    """Cut values of one tree by node number (children 2n and 2n+1)."""
    cuts, todo = {}, [(1, 0, np.arange(len(unit)))]
    while todo:
        node, level, rows = todo.pop()
        if level == len(directions) or len(rows) <= max(_MIN_NODE_SAMPLE, leaf_rows * rate):
            continue
        places = unit[rows] @ directions[level]
        cut = float(np.median(places))
        low, high = _split(places, cut, spill)
        if max(low.sum(), high.sum()) > _BREAK_EVEN * len(rows):
            continue  # one tight cluster: splits would only copy it
        cuts[node] = cut
        todo += [(2 * node, level + 1, rows[low]), (2 * node + 1, level + 1, rows[high])]
    return cuts


def _leaves_of(unit: np.ndarray, cuts: list[dict], directions: np.ndarray, spill: float) -> list[list[tuple]]:
    """(tree, node) of every leaf that each vector is in."""
    found = [[] for _ in unit]
    for tree, nodes in enumerate(cuts):
        todo = [(1, 0, np.arange(len(unit)))]
        while todo:
            node, level, rows = todo.pop()
            if node not in nodes:
                for row in rows:
                    found[row].append((tree, node))
                continue
            low, high = _split(unit[rows] @ directions[tree, level], nodes[node], spill)
            todo += [(2 * node + side, level + 1, r) for side, r in enumerate((rows[low], rows[high])) if len(r)]
    return found


def _placer(forests: dict, trees: int, depth: int, seed: int, spill: float):
    from hashlib import sha1

    def run(batches):
        for batch in slices(batches, 1024):
            labels, blobs = batch.column("label").to_pylist(), batch.column("vec").to_pylist()
            ids, numbers, reps = (batch.column(name).to_pylist() for name in ("id", "n", "rep"))
            groups: dict = {}
            for row, (label, blob) in enumerate(zip(labels, blobs)):
                groups.setdefault((label, len(blob) // 8), []).append(row)
            out = []
            for (label, size), rows in groups.items():
                unit = _unit(matrix([blobs[r] for r in rows]))
                cuts = forests.get((label, size), [{}] * trees)
                spread = spill / math.sqrt(size)
                placed = _leaves_of(unit, cuts, _directions(trees, depth, size, seed), spread)
                # Only vectors of one label and length meet; leaves are named within these.
                kin = sha1(f"{size}|{label}".encode()).digest()
                for row, leaves in zip(rows, placed):
                    names = [hash((tree, node)) for tree, node in leaves]
                    out += [(kin, name, ids[row], reps[row], numbers[row], blobs[row], names) for name in set(names)]
            whole = pa.int64()
            kinds = [pa.binary(), whole, whole, whole, whole, pa.binary(), pa.list_(whole)]
            columns = list(zip(*out)) or [[]] * 7
            for start in range(0, max(1, len(out)), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[start : start + 4096], k) for c, k in zip(columns, kinds)],
                    names=["kin", "leaf", "id", "rep", "n", "vec", "leaves"],
                )

    return run


def _own_directions(leaf: int, rows: int, leaf_rows: int, size: int, seed: int) -> np.ndarray:
    return _directions(1, _depth(rows, leaf_rows), size, seed, leaf % (1 << 63))


def _depth(rows: int, leaf_rows: int) -> int:
    return max(1, math.ceil(math.log2(max(2, 2 * rows / leaf_rows))))


def _fitter(leaf_rows: int, spill: float, seed: int):
    """Cuts of the tree of one large leaf from a sample of it; no row if splits do not help."""

    def run(key, sample: pd.DataFrame) -> pd.DataFrame:
        kin, leaf, rows = key[0], int(key[1]), int(key[2])
        unit = _unit(matrix(sample["vec"].tolist()))
        size = unit.shape[1]
        directions = _own_directions(leaf, rows, leaf_rows, size, seed)[0]
        cuts = _grow(unit, directions, spill / math.sqrt(size), min(1.0, len(sample) / rows), leaf_rows)
        found = [(kin, leaf, rows, json.dumps(list(cuts.items())))] if cuts else []
        return pd.DataFrame(found, columns=["kin", "leaf", "rows", "cuts"])

    return run


def _splitter(leaf_rows: int, spill: float, seed: int):
    """Rows of a part of one large leaf in the leaves of its tree."""

    def run(key, part: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return part.drop(columns="part")
        leaf, rows = int(key[1]), int(tree["rows"].iat[0])
        unit = _unit(matrix(part["vec"].tolist()))
        size = unit.shape[1]
        directions = _own_directions(leaf, rows, leaf_rows, size, seed)
        cuts = dict(json.loads(tree["cuts"].iat[0]))
        placed = _leaves_of(unit, [cuts], directions, spill / math.sqrt(size))
        row = np.repeat(np.arange(len(part)), [len(leaves) for leaves in placed])
        names = [hash((leaf, node)) for leaves in placed for _, node in leaves]
        return part.drop(columns="part").iloc[row].assign(leaf=names)

    return run


def _split_large(placed: DataFrame, leaf_rows: int, spill: float, seed: int) -> DataFrame:
    """``placed`` with its large leaves split, each vector's list of leaves renewed.

    Only rows of large leaves are shuffled, in parts of a bounded size. Every round
    splits the leaves the last one made that are still large; a leaf that no split
    helps stays as it is.
    """
    leaf, kept, todo = ["kin", "leaf"], [], placed.drop("leaves")
    while True:
        large = todo.groupBy(*leaf).agg(F.count("*").alias("rows")).where(F.col("rows") > _LARGE * leaf_rows)
        large = stored(large, "large")
        if not (count := large.count()):
            break
        inside = todo.join(sized_broadcast(large, count, 64), leaf)
        drawn = F.pmod(F.xxhash64(F.lit(len(kept)), "id", "rep"), F.lit(1 << 20)) * F.col("rows")
        sample = inside.where(drawn < _NODE_ROWS * (1 << 20)).select(*leaf, "rows", "vec")
        fitted = sample.groupBy(*leaf, "rows").applyInPandas(
            _fitter(leaf_rows, spill, seed), "kin binary, leaf long, rows long, cuts string"
        )
        trees = stored(fitted, "trees").withColumn("parts", F.ceil(F.col("rows") / _NODE_ROWS).cast("int"))
        found = trees.count()
        if not found:
            break
        names = sized_broadcast(trees.select(*leaf, "parts"), found, 64)
        part = F.pmod(F.xxhash64(F.lit(-1), "id", "rep"), F.col("parts")).cast("int")
        split = todo.join(names, leaf).withColumn("part", part).drop("parts")
        trees = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        smaller = split.groupBy(*leaf, "part").cogroup(trees.groupBy(*leaf, "part")).applyInPandas(
            _splitter(leaf_rows, spill, seed), _ROWS
        )
        kept.append(todo.join(names, leaf, "left_anti"))
        todo = stored(smaller, "leaves")
    if not kept:
        return placed
    for part in kept:
        todo = todo.unionByName(part)
    lists = todo.groupBy("id", "rep").agg(F.collect_set("leaf").alias("leaves"))
    return stored(todo.join(lists, ["id", "rep"]).select("kin", "leaf", "id", "rep", "n", "vec", "leaves"), "leaves")


def _met_before(leaves: list, leaf: int) -> np.ndarray:
    """Which pairs of rows also share a leaf with a smaller name than ``leaf``."""
    rows = np.repeat(np.arange(len(leaves)), [len(names) for names in leaves])
    names = np.concatenate(leaves)
    rows, names = rows[names < leaf], names[names < leaf]
    names, column = np.unique(names, return_inverse=True)
    met = np.zeros((len(leaves), len(leaves)), dtype=bool)
    for start in range(0, len(names), _LEAF_COLUMNS):
        some = (column >= start) & (column < start + _LEAF_COLUMNS)
        inside = np.zeros((len(leaves), min(_LEAF_COLUMNS, len(names) - start)), dtype=np.float32)
        inside[rows[some], column[some] - start] = 1
        met |= inside @ inside.T > 0
    return met


def _roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each row reaches through ``linked``."""
    root, top = ids.copy(), np.iinfo(np.int64).max
    while True:
        reached = np.minimum(root, np.where(linked, root[None, :], top).min(axis=1))
        if (reached == root).all():
            return root
        root = reached


def _comparer(threshold: float):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        _, leaf, low, high = key
        rows = rows.sort_values("id", ignore_index=True)
        unit = _unit(matrix(rows["vec"].tolist()))
        ids, n, block = (rows[c].to_numpy() for c in ("id", "n", "block"))
        close = unit @ unit.T >= threshold
        np.fill_diagonal(close, False)
        if low != high:
            close &= block[:, None] != block[None, :]
        some = np.flatnonzero(close.any(axis=1))
        if not len(some):
            return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        close, ids, n = close[np.ix_(some, some)], ids[some], n[some]
        mine = close & ~_met_before([rows["leaves"].iat[row] for row in some], leaf)
        links = mine.astype(np.float64) @ n.astype(np.float64)  # whole numbers, exact
        return pd.DataFrame({"id": ids, "links": links.astype("int64"), "root": _roots(close, ids)})

    return run


def _fit(reps: DataFrame, rows: int, trees: int, depth: int, leaf_rows: int, spill: float, seed: int) -> dict:
    rate = min(1.0, SAMPLE_ROWS / max(rows, 1))
    drawn = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1
    groups: dict = {}
    for row in reps.where(drawn).select("label", "vec").toLocalIterator():
        groups.setdefault((row["label"], len(row["vec"]) // 8), []).append(bytes(row["vec"]))
    forests = {}
    for (label, size), blobs in groups.items():
        unit, directions = _unit(matrix(blobs)), _directions(trees, depth, size, seed)
        spread = spill / math.sqrt(size)
        forests[label, size] = [_grow(unit, directions[t], spread, rate, leaf_rows) for t in range(trees)]
    return forests


def link_vectors(
    embeddings: DataFrame,
    threshold: float = 0.98,
    trees: int = 8,
    leaf_rows: int = 512,
    spill_share: float = 0.6,
    seed: int = 11,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings``.

    Rows (vec_id, embedding, label) link when their labels are equal and not
    null, their vectors equally long and the cosine in double precision at least
    ``threshold``. Rows without a usable vector or id (see ``encoded_vectors``) or
    label link with nothing and are a component of their own; a null id has a
    null component and is not kept. Repeated rows are rows of their own and link
    with each other; n_links counts rows. Rows that share an id but not a vector
    share their links. Other columns are ignored. ``spill_share`` is the width, on either side of a
    split, of the strip that goes to both children, in deviations of the projected
    distance of two vectors just at the threshold. ``leaf_rows`` is aimed at; leaves
    of several times as many rows are split again.
    """
    rows = stored(
        encoded_vectors(embeddings).withColumn("key", F.when(F.col("label").isNotNull(), F.col("key"))),
        "vectors",
    )
    usable = rows.where("key IS NOT NULL")
    reps = usable.groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec")
    )
    reps = stored(reps, "reps")
    count = reps.count()
    depth = _depth(count, leaf_rows)
    spill = spill_share * math.sqrt(2 - 2 * threshold)
    forests = _fit(reps, count, trees, depth, leaf_rows, spill, seed)
    placed = reps.select("id", F.xxhash64("key").alias("rep"), "n", "label", "vec").mapInArrow(
        _placer(forests, trees, depth, seed, spill), _LEAVES
    )
    placed = _split_large(stored(placed, "leaves"), leaf_rows, spill, seed)
    sizes = stored(
        placed.groupBy("kin", "leaf").count().select("kin", "leaf", F.ceil(F.col("count") / _BLOCK_ROWS).cast("int").alias("blocks")),
        "sizes",
    )
    sizes = sized_broadcast(sizes, sizes.count(), 64)
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    blocked = placed.join(sizes, ["kin", "leaf"]).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocked = blocked.withColumn("other", other).select(
        "kin", "leaf", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "id", "n", "vec", "leaves",
    )
    found = blocked.groupBy("kin", "leaf", "low", "high").applyInPandas(_comparer(threshold), _FOUND)
    found = stored(found, "found")
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    grouped = components(found, "id", "root")
    result = (
        reps.select("key", "id", "n")
        .join(sums, "id", "left")
        .join(grouped, "id", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = usable.select("vec_id", "key").join(result, "key")
    alone = rows.where("key IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    every = linked.select("vec_id", "n_links", "component_id").union(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return every.withColumn("kept", kept)


