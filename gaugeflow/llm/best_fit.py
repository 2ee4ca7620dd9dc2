"""Pack documents into sequences by best-fit decreasing.

Token counts are whole numbers up to the sequence length, so the pieces of all
documents are known by how many there are of each length. Best-fit decreasing
runs over these counts: open bins are kept by remaining capacity, and a segment
tree over capacities finds the tightest one that fits in logarithmic time. The
packing is the same as for piece after piece, yet its plan is a short list of
(length, range of pieces, range of bins). Pieces are numbered within their
length by Spark and look up their bin there.
"""

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.frames import parts, sized_broadcast, slices, stored
from gaugeflow.llm.tokens import ByteBpe

_ROWS_PER_SLICE = 20_000
_ROW_BYTES = 64
_PIECES = "doc_id long, mark long, piece int, start long, length long, ids_crc32 long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _FitTree:
    """Which capacities have open bins; finds the smallest one of at least a size."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.width)

    def put(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.width
        self.open[node] = int(is_open)
        while node > 1:
            node >>= 1
            self.open[node] = self.open[2 * node] | self.open[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        node = size + self.width
        if self.open[node]:
            return size
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.width
            node >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Best-fit decreasing of ``counts[length]`` pieces into bins of ``capacity``.

    Each step says: the pieces of ``length`` from number ``first`` on go, ``each``
    of them to a bin, to bins from ``bin`` on, the first of a bin at ``offset``.
    """
    open_bins: dict[int, deque] = {}
    tree, steps, bins = _FitTree(capacity), [], 0

    def add(left: int, first: int, number: int) -> None:
        if number and left:
            open_bins.setdefault(left, deque()).append((first, number))
            tree.put(left, True)

    for length in sorted(counts, reverse=True):
        done, number = 0, counts[length]
        while done < number:
            left = tree.tightest(length)
            if left is None:
                # New bins: as many as the rest needs, each filled before the next.
                left, first, have = capacity, bins, -(-(number - done) // (capacity // length))
                bins += have
            else:
                first, have = open_bins[left].popleft()
                if not open_bins[left]:
                    tree.put(left, False)
            each = left // length
            full = min(have, (number - done) // each)
            if full:
                steps.append((length, done, first, capacity - left, each))
                done += full * each
                add(left - each * length, first, full)
            if full < have and (rest := number - done) and rest < each:
                steps.append((length, done, first + full, capacity - left, rest))
                done += rest
                add(left - rest * length, first + full, 1)
                full += 1
            add(left, first + full, have - full)
    names = ("length", "first", "bin", "offset", "each")
    table = np.array(steps, dtype=np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(names)} | {"bins": np.int64(bins)}


def _tokenized(path: str | None, most: int, end_id: int):
    def run(batches):
        encoder = ByteBpe(path or _tokenizer_path())
        names = [c.split()[0] for c in _PIECES.split(", ")]
        for batch in slices(batches):
            rows = []
            for doc_id, mark, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "mark", "text"))):
                ids = encoder.encode(text or "", special=True)
                ids = np.array([*ids, end_id], dtype="<u4")
                cuts = [0, *range(len(ids) % most or most, len(ids) + 1, most)]
                for piece, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, mark, piece, start, end - start, zlib.crc32(ids[start:end])))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _placed(plan: dict[str, np.ndarray]):
    """Looks up each piece's step by (length, number within the length)."""
    span = np.int64(1) << 40
    order = np.lexsort((plan["first"], plan["length"]))
    table = {k: v[order] for k, v in plan.items() if k != "bins"}
    keys = table["length"] * span + table["first"]

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            step = np.searchsorted(keys, length * span + number, side="right") - 1
            inside = number - table["first"][step]
            each = table["each"][step]
            bins = table["bin"][step] + inside // each
            offset = table["offset"][step] + inside % each * length
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = [batch.column(n) for n in kept] + [pa.array(bins), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    return run


def _numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``number``, from 0 within each length; no task sorts a whole length."""
    slices = parts(pieces.count(), _ROWS_PER_SLICE)
    cut = pieces.withColumn("slice", F.pmod(F.xxhash64("mark", "piece", "doc_id"), F.lit(slices)))
    sums = cut.groupBy("length", "slice").agg(F.count("*").alias("n"))
    sums = stored(sums, "slices")
    before = Window.partitionBy("length").orderBy("slice")
    base = sums.select("length", "slice", (F.sum("n").over(before) - F.col("n")).alias("base"))
    base = sized_broadcast(base, sums.count(), _ROW_BYTES)
    order = Window.partitionBy("length", "slice").orderBy("mark", "doc_id", "piece")
    return cut.join(base, ["length", "slice"]).withColumn(
        "number", F.row_number().over(order) - 1 + F.col("base")
    )


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text) with their sequence and place.

    A document is its token ids followed by ``end_id``; a null text has that id
    only. Longer ones than ``capacity`` are cut into pieces of it, of which the
    first may be shorter. Every row is packed, repeated rows and null ids too.
    ``tokenizer`` is the path of a byte-level BPE file on every executor. Sequence
    ids count from 0 without gaps; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("mark"), "text"
    )
    pieces = stored(rows.mapInArrow(_tokenized(tokenizer, capacity, end_id), _PIECES), "pieces")
    lengths = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    plan = best_fit_plan({r["length"]: r["count"] for r in lengths}, capacity)
    return _numbered(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("number").cast("long").alias("number")
    ).mapInArrow(_placed(plan), _PACKED)
