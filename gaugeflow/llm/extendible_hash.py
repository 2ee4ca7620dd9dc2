"""Exact duplicates through an extendible-hash index on shared files.

A text's key is its 64-bit hash. Buckets are ranges of keys with a common prefix;
the directory starts with all prefixes of one depth, and as long as a bucket is
overfull it is split by one more bit of the key, which doubles the directory.

1. Tasks register the texts they read: equal texts within a bounded window are one
   entry, so a text that a third of all rows hold is a few entries per task.
2. The directory is made from the distinct keys and their sizes alone.
3. Each bucket has one owner task. It walks its key ranges in order, chains texts
   whose keys collide, and compares bytes along the chain.
4. Rows find their chain link by their entry, so no join is keyed by a hot text.

Entries, directory and buckets are Parquet tables in the shared folder.
"""

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import parts, sized_broadcast, stored

#: A bucket with more distinct keys or bytes than this is overfull.
BUCKET_KEYS = 1024
BUCKET_BYTES = 8 << 20
#: Bounds of the window in which a task merges equal texts.
WINDOW_BYTES = 16 << 20
WINDOW_ROWS = 50_000

_KEY_BITS = 64
_TASK_BITS = 33
_OWNER_BYTES = 128 << 20
_REGISTERED = (
    "doc_id long, sha string, first boolean, entry long, key long, least long, n long, size long, content binary"
)
_LINKS = "bucket long, key long, link int, entry long, keep_id long, group_size long, keeps boolean"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty.

    Single spaces are not matched, since they stay what they are.
    """
    runs = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), runs, " ")


class _Window:
    """Rows and distinct texts that a task holds until it writes them."""

    def __init__(self, number: int):
        self.number = number
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.entries: dict[bytes, list] = {}
        self.bytes = 0

    def add(self, doc_id, sha, key, content: bytes) -> None:
        entry = self.entries.get(content)
        if entry is None:
            entry = self.entries[content] = [self.number, key, doc_id, 0, len(self.rows)]
            self.number += 1
            self.bytes += len(content)
        elif doc_id is not None and (entry[2] is None or doc_id < entry[2]):
            entry[2], entry[4] = doc_id, len(self.rows)
        entry[3] += 1
        self.rows.append((doc_id, sha, entry[0]))

    def records(self) -> pa.RecordBatch:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("sha", pa.string()), ("first", pa.bool_()), ("entry", pa.int64())]
            + [(name, pa.int64()) for name in ("key", "least", "n", "size")]
            + [("content", pa.binary())]
        )
        firsts = {entry[4] for entry in self.entries.values()}
        out = [(i, sha, row in firsts, entry, *[None] * 5) for row, (i, sha, entry) in enumerate(self.rows)]
        out += [
            (None, None, None, number, key, least, n, len(content), content)
            for content, (number, key, least, n, _) in self.entries.items()
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _registrar(window_bytes: int, window_rows: int):
    def run(batches):
        from pyspark import TaskContext

        window = _Window(TaskContext.get().partitionId() << _TASK_BITS)
        for batch in batches:
            ids, keys, shas = (batch.column(c).to_pylist() for c in ("doc_id", "key", "sha"))
            contents = batch.column("content")
            for row in range(batch.num_rows):
                window.add(ids[row], shas[row], keys[row], contents[row].as_py())
                if window.bytes >= window_bytes or len(window.rows) >= window_rows:
                    yield window.records()
                    window.clear()
        if window.rows:
            yield window.records()

    return run


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("key", _KEY_BITS - depth)


def first_depth(keys: int, size: int, bucket_keys: int, bucket_bytes: int) -> int:
    """Depth at which a bucket holds a quarter to half of what it may, at least 1."""
    load = max(keys / bucket_keys, size / bucket_bytes)
    return max(1, math.ceil(math.log2(load)) + 1) if load > 0 else 1


def grown_directory(keys: DataFrame, depth: int, bucket_keys: int, bucket_bytes: int) -> DataFrame:
    """(slot, splits): the split nodes below each prefix of ``depth`` bits that has any.

    ``keys`` are distinct (key, size). One round splits every overfull bucket by one
    bit; only keys of overfull buckets go into the next. A bucket of one key, however
    large its text, is never overfull.
    """
    first, splits = depth, None
    while depth < _KEY_BITS:
        fill = keys.groupBy(_prefix(depth).alias("prefix")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        overfull = fill.where((F.col("n") > bucket_keys) | (F.col("size") > bucket_bytes) & (F.col("n") > 1))
        overfull = stored(overfull.select("prefix"), "overfull")
        if overfull.isEmpty():
            break
        node = F.struct(F.lit(depth).alias("depth"), "prefix").alias("node")
        nodes = overfull.select(F.shiftright("prefix", depth - first).alias("slot"), node)
        splits = nodes if splits is None else splits.union(nodes)
        keys = keys.withColumn("prefix", _prefix(depth)).join(overfull, "prefix", "left_semi").drop("prefix")
        depth += 1
    if splits is None:
        return keys.sparkSession.createDataFrame([], "slot long, splits array<struct<depth:int,prefix:long>>")
    return splits.groupBy("slot").agg(F.collect_list("node").alias("splits"))


def local_depth(depth: int) -> Column:
    """Depth of the bucket of ``key``, given the ``splits`` of its slot or null.

    The split nodes that a key lies in are its bucket's ancestors, one per level, so
    their number is how much deeper than ``depth`` the bucket is.
    """
    inside = F.expr(f"size(filter(splits, x -> shiftrightunsigned(key, {_KEY_BITS} - x.depth) = x.prefix))")
    return F.lit(depth) + F.when(F.col("splits").isNull(), 0).otherwise(inside)


def _chained(batches):
    """Links of the chains of a task's buckets; rows come in order of bucket and key."""
    names = [c.split()[0] for c in _LINKS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    chain: list[list] = []  # of the key at hand: content, entries as (least, entry), n
    at = None

    def closed():
        for link, (_, entries, n) in enumerate(chain):
            # The smallest id, nulls last, then the smallest entry.
            keep, keeper = min(entries, key=lambda e: (e[0] is None, e[0] or 0, e[1]))
            for _, entry in entries:
                yield (*at, link, entry, keep, n, entry == keeper)

    def packed(rows):
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        rows = []
        buckets, keys, entries, least, n = (
            batch.column(c).to_pylist() for c in ("bucket", "key", "entry", "least", "n")
        )
        contents = batch.column("content")
        for row in range(batch.num_rows):
            if at != (buckets[row], keys[row]):
                rows += closed()
                chain, at = [], (buckets[row], keys[row])
            content = contents[row].as_py()
            for found in chain:
                if found[0] == content:
                    break
            else:
                found = [content, [], 0]
                chain.append(found)
            found[1].append((least[row], entries[row]))
            found[2] += n[row]
        yield packed(rows)
    yield packed(closed())


@dataclass(frozen=True)
class HashIndex:
    """Tables of an index: rows and entries as registered, split nodes, chain links."""

    rows: DataFrame
    directory: DataFrame
    links: DataFrame
    depth: int


def build_index(
    docs: DataFrame,
    key: str = "xxhash64(content)",
    bucket_keys: int = BUCKET_KEYS,
    bucket_bytes: int = BUCKET_BYTES,
    window_bytes: int = WINDOW_BYTES,
    window_rows: int = WINDOW_ROWS,
) -> HashIndex:
    """Index of the normalised texts of ``docs`` (doc_id, text).

    ``key`` is SQL for a long over ``content``; texts may share keys, which costs chain
    links but changes no result.
    """
    text = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("content"))
    rows = rows.select(
        "doc_id",
        F.expr(key).alias("key"),
        F.sha2("content", 256).alias("sha"),
        F.col("content").cast("binary").alias("content"),
    )
    registered = stored(rows.mapInArrow(_registrar(window_bytes, window_rows), _REGISTERED), "registered")
    entries = registered.where("key IS NOT NULL")
    keys = stored(entries.groupBy("key").agg(F.max("size").alias("size")), "keys")
    count, size = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    depth = first_depth(count, size, bucket_keys, bucket_bytes)
    directory = stored(grown_directory(keys, depth, bucket_keys, bucket_bytes), "directory")
    (nodes,) = directory.agg(F.coalesce(F.sum(F.size("splits")), F.lit(0))).first()
    # A bucket is named by the first key of its range.
    left = f"{_KEY_BITS} - depth"
    bucket = F.expr(f"shiftleft(shiftrightunsigned(key, {left}), {left})")
    placed = (
        entries.select("key", "entry", "least", "n", "content", _prefix(depth).alias("slot"))
        .join(sized_broadcast(directory, nodes, 40), "slot", "left")
        .withColumn("depth", local_depth(depth))
        .select(bucket.alias("bucket"), "key", "entry", "least", "n", "content")
    )
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = placed.repartition(max(width, parts(size, _OWNER_BYTES)), "bucket")
    links = owned.sortWithinPartitions("bucket", "key").mapInArrow(_chained, _LINKS)
    return HashIndex(registered.where("key IS NULL"), directory, stored(links, "links"), depth)


def exact_duplicates(docs: DataFrame, **index) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``.

    Texts are equal when identical after each run of ASCII white space became one
    space; nothing is trimmed, and a null text is empty. keep_id is the smallest
    doc_id of the equal texts, null if all are null; group_size counts rows, repeated
    ones too. Exactly one row of a group is kept, one of those with keep_id. The
    digest is of the normalised text in UTF-8, in lower-case hex. Other columns are
    ignored; an empty table gives an empty result. ``index`` goes to ``build_index``.
    """
    found = build_index(docs, **index)
    links = found.links.select("entry", "keep_id", "group_size", "keeps")
    joined = found.rows.select("doc_id", "sha", "first", "entry").join(links, "entry")
    return joined.select(
        "doc_id", "keep_id", "group_size", (F.col("first") & F.col("keeps")).alias("kept"), F.col("sha").alias("text_sha256")
    )
