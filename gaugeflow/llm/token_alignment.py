"""Alignment of two tokenizers' tokens over the same bytes.

Tokens become rows of (document, start, end) in bytes. ``merge_asof`` finds for each
token start the other side's token that covers it, keyed by document; the union of
both directions is every overlapping pair of tokens. Pairs that end together are
links, and their ends cut both sides into groups that say the same bytes.

How often two ids are linked is counted over the whole corpus: once per document in
Python, then by Spark, and looked up again by a join on the pair.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import sized_broadcast, stored
from gaugeflow.llm.tokens import ByteBpe, PieceBpe

#: Bytes of text whose tokens are aligned in one pair of joins; a longer text is one.
_SLAB_BYTES = 1 << 20
_ID_BITS = 32
_TASK_BITS = 33
_PAIR_BYTES = 64
_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, "
    "groups string, pairs array<long>, times array<int>"
)


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Side:
    """An encoder with tables of its entries' bytes, lengths and written ids."""

    def __init__(self, encoder, last: str):
        self.encode, size = encoder.encode, 1 + max(encoder.bytes)
        self.bytes = [encoder.bytes.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        #: Entry 2i is written before another token of the group, 2i + 1 at its end.
        self.written = [f"{i}{sign}" for i in range(size) for sign in (",", last)]

    def ids(self, text: str, data: bytes) -> np.ndarray | None:
        """Ids of ``text``, or None if their bytes are not ``data``."""
        ids = self.encode(text)
        same = b"".join(map(self.bytes.__getitem__, ids)) == data
        return np.array(ids, dtype=np.int64) if same else None

    def tokens(self, each: list[np.ndarray], name: str) -> pd.DataFrame:
        """Tokens of consecutive documents with their places in the joined bytes."""
        ids = np.concatenate(each)
        ends = np.cumsum(self.lengths[ids])
        docs = np.repeat(np.arange(len(each)), [len(x) for x in each])
        starts = ends - self.lengths[ids]
        columns = {"doc": docs, "at": starts, name: np.arange(len(ids)), f"{name}_at": starts, f"{name}_end": ends}
        return pd.DataFrame(columns)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Every pair of overlapping tokens, as (a, b, a_end, b_end), once."""
    covered_a = pd.merge_asof(a, b, on="at", by="doc")
    covered_b = pd.merge_asof(b, a, on="at", by="doc")
    covered_b = covered_b[covered_b["a_at"] < covered_b["b_at"]]  # equal starts are in the first
    columns = ["a", "b", "a_end", "b_end"]
    return pd.concat([covered_a[columns], covered_b[columns]], ignore_index=True)


def _slab(a: _Side, b: _Side, each_a: list[np.ndarray], each_b: list[np.ndarray]) -> list[tuple]:
    """(groups, links, overlaps, pairs, times) of documents that have tokens."""
    found = overlaps(a.tokens(each_a, "a"), b.tokens(each_b, "b"))
    met = found[found["a_end"] == found["b_end"]].sort_values("a")
    last_a, last_b = met["a"].to_numpy(), met["b"].to_numpy()
    ids_a, ids_b = np.concatenate(each_a), np.concatenate(each_b)
    at_a, at_b = np.arange(len(ids_a)), np.arange(len(ids_b))
    group_a, group_b = np.searchsorted(last_a, at_a), np.searchsorted(last_b, at_b)
    # A group is written as its a tokens, then its b tokens.
    order = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    before = np.concatenate([[0], last_b + 1])
    order[at_a + before[group_a]] = 2 * ids_a + (last_a[group_a] == at_a)
    order[at_b + last_a[group_b] + 1] = 2 * (ids_b + len(a.bytes)) + (last_b[group_b] == at_b)
    written = a.written + b.written
    stops_a, stops_b = (np.cumsum([0, *map(len, each)]) for each in (each_a, each_b))
    cuts = np.searchsorted(last_a, stops_a)
    shared = np.bincount(np.searchsorted(stops_a, found["a"], side="right") - 1, minlength=len(each_a))
    pairs = ids_a[last_a] << _ID_BITS | ids_b[last_b]
    out = []
    for doc in range(len(each_a)):
        start, stop = stops_a[doc] + stops_b[doc], stops_a[doc + 1] + stops_b[doc + 1]
        text = "".join(map(written.__getitem__, order[start:stop].tolist()))
        mine, times = np.unique(pairs[cuts[doc] : cuts[doc + 1]], return_counts=True)
        out.append((text[:-1], int(cuts[doc + 1] - cuts[doc]), int(shared[doc]), mine, times))
    return out


def _aligner(path_a: str | None, path_b: str | None):
    def run(batches):
        from pyspark import TaskContext

        a = _Side(ByteBpe(path_a or _path("byte_bpe_50k.json")), "|")
        b = _Side(PieceBpe(path_b or _path("piece_bpe_32k.model")), ";")
        row = TaskContext.get().partitionId() << _TASK_BITS

        def slabs():
            held, size = [], 0
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                    held.append((doc_id.as_py(), text.as_py() or ""))
                    size += len(held[-1][1])
                    if size >= _SLAB_BYTES or len(held) >= 4096:
                        yield held
                        held, size = [], 0
            if held:
                yield held

        for held in slabs():
            each_a, each_b, places = [], [], {}
            for place, (_, text) in enumerate(held):
                data = (" " + text).encode()
                ids_a = a.ids(" " + text, data) if text else None
                ids_b = b.ids(text, data) if ids_a is not None else None
                if ids_b is not None:
                    places[place] = len(each_a)
                    each_a.append(ids_a)
                    each_b.append(ids_b)
            aligned = _slab(a, b, each_a, each_b) if each_a else []
            nothing = ("", 0, 0, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
            found = [aligned[places[p]] if p in places else nothing for p in range(len(held))]
            count = [[len(e[places[p]]) if p in places else 0 for p in range(len(held))] for e in (each_a, each_b)]
            groups, links, shared, pairs, times = zip(*found)
            offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), kind))
                for x, kind in ((pairs, pa.int64()), (times, pa.int32()))
            ]
            columns = [range(row, row + len(held)), [d for d, _ in held], *count, links, links, shared]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array(groups, pa.string()), *lists],
                names=[c.split()[0] for c in _ALIGNED.split(", ")],
            )
            row += len(held)

    return run


def align_tokens(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The alignment of every row of ``docs`` (doc_id, text), without corpus counts.

    a encodes a space and the text by a byte-level BPE file, b the text by a
    sentencepiece model that adds the space; special tokens in texts are plain text.
    ``row`` names the row within this result. ``groups`` writes the ids of each group
    as ``a,a|b;a|b,b``. ``pairs`` are the linked ids (a in the upper 32 bits) and ``times``
    how often the document links them. Null and empty texts, and those whose tokens'
    bytes on either side are not the space and the text, have no tokens. Paths are
    those on the executors; all tokens of one text are in memory at once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_aligner(path_a, path_b), _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) of the whole corpus; best if no pair of its b id has more."""
    linked = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = linked.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    counts = stored(counts, "pair_counts")
    b = F.col("pair").bitwiseAND((1 << _ID_BITS) - 1).alias("b")
    most = counts.groupBy(b).agg(F.max("count").alias("most"))
    return stored(
        counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")),
        "best_pairs",
    )


def alignment_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` (a stored result of ``align_tokens``) with n_best and count_sum.

    A link's count is how many links of the whole corpus have its two ids. n_best
    counts links with the highest count of their b id, ties included; count_sum adds
    up the counts of all links.
    """
    counts = pair_counts(aligned)
    counts = sized_broadcast(counts, counts.count(), _PAIR_BYTES)
    linked = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    linked = linked.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    sums = (
        linked.join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    return aligned.join(sums, "row", "left").withColumns(
        {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    )
