"""Removal of repeated byte strings over a sparse suffix array.

A string of 200 bytes is looked up by its leading token, the 64 bytes in it with
the least hash. Runs of strings with one leading token make a record, so there
is a record every 70 bytes or so, and equal strings have equal leading tokens.

1. Records are range-partitioned by leading token at sampled splitters and
   sorted. Records equal as a whole repeat as a whole; from each of them, and
   from those next to another bucket, one goes on if its token has others.
2. The bytes of these are gathered by token, and the suffixes that start in them
   are sorted by multikey quicksort, eight bytes at a time. Suffixes that stay
   together for 200 bytes are repeated. This also compares across the
   boundaries of the buckets of step 1.
3. A token with more records or bytes than one task should hold is not gathered; its
   suffixes are counted by 128-bit fingerprints instead. Suffixes that a record
   repeats in itself, such as those of a run of one sign, are found there and sent
   on once.

Equal texts are looked at once.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import stored

_GRAM = 64
_CHUNK = 1 << 20
_TOKEN_RECORDS = 2048
_TOKEN_BYTES = 1 << 20
_SORT_BYTES = 1 << 20
_RECORD = "token long, print long, copy binary, start long, strings int, again boolean"
_KEPT = "token long, copy binary, start long, strings int, whole boolean, compare boolean"
_BYTES = "token long, copy binary, start long, bytes binary"
_SPAN = "copy binary, start long, stop long"
_WINDOWS = "copy binary, start long, stop long, one long, other long, twice boolean"
_RESULT = "copy binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


class _Hasher:
    """Hashes of substrings from prefix sums, modulo 2**64."""

    def __init__(self, base: int = _BASE, seed: int = 1):
        self.codes = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        size = _CHUNK + 1024
        self.up = np.cumprod(np.full(size, base, dtype=np.uint64)) * np.uint64(pow(base, -1, 1 << 64))
        self.down = np.cumprod(np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)) * np.uint64(base)

    def sums(self, data: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.codes[data] * self.down[: len(data)], out=total[1:])
        return total

    def prints(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((sums[stop] - sums[start]) * self.up[start] + (stop - start).astype(np.uint64))

    def grams(self, sums: np.ndarray, length: int) -> np.ndarray:
        number = len(sums) - length
        return _mixed((sums[length:] - sums[:number]) * self.up[:number])


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _records(data: np.ndarray, hasher: _Hasher, length: int):
    """token, print, start, strings and again of the records of at most one chunk."""
    sums = hasher.sums(data)
    grams = hasher.grams(sums, _GRAM)
    token = _least_in(grams, length - _GRAM + 1)
    change = np.flatnonzero(token[1:] != token[:-1]) + 1
    first, stop = np.r_[0, change], np.r_[change, len(token)]
    # A token that leads a string and also a later one of its record is there
    # twice, so the record may hold one string twice.
    twice = (grams[: len(token) - 1] == token[:-1]) & (token[:-1] == token[1:])
    again = np.add.reduceat(np.r_[twice, False], first) > 0
    prints = hasher.prints(sums, first, stop - 1 + length)
    return token[first].view(np.int64), prints.view(np.int64), first, (stop - first).astype(np.int32), again


def _suffixes(length: int):
    def run(batches):
        hasher, seen = _Hasher(), set()
        for batch in batches:
            for copy, text in zip(batch.column("copy").to_pylist(), batch.column("text")):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                if len(data) < length or copy in seen:
                    continue
                seen.add(copy)
                for base in range(0, len(data) - length + 1, _CHUNK):
                    part = data[base : base + _CHUNK + length - 1]
                    token, prints, first, strings, again = _records(part, hasher, length)
                    columns = [token, prints, pa.array([copy] * len(token), pa.binary()), first + base, strings, again]
                    names = ["token", "print", "copy", "start", "strings", "again"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _joined_batches(batches, rows: int):
    """The same rows in batches of at least ``rows``."""
    held, number = [], 0
    for batch in batches:
        held.append(batch)
        number += batch.num_rows
        if number >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, number = [], 0
    if number:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _neighbours(batches):
    """Of sorted records, those that repeat as a whole or are to be compared.

    A record is compared if it is the first or last one of its print and its
    token goes on next to it, or if it stands at the edge of the bucket.
    """
    before = held = None  # the row before, the row not decided yet

    def decided(rows: pa.RecordBatch, before, last: bool):
        token, prints = rows.column("token").to_numpy(), rows.column("print").to_numpy()
        same_token, same_print = token[1:] == token[:-1], prints[1:] == prints[:-1]
        twin = same_token & same_print
        edge = before is None
        of_first = np.array([edge or before[0] == token[0]]), np.array([not edge and before == (token[0], prints[0])])
        prev_token, prev_twin = np.r_[of_first[0], same_token], np.r_[of_first[1], twin]
        next_token, next_twin = np.r_[same_token, last], np.r_[twin, False]
        compare = prev_token & ~prev_twin | next_token & ~next_twin
        compare |= rows.column("again").to_numpy(zero_copy_only=False)
        whole = prev_twin | next_twin
        wanted = whole | compare
        if not last:
            wanted[-1] = False
        return pa.RecordBatch.from_arrays(
            [
                *(rows.column(n).filter(pa.array(wanted)) for n in ("token", "copy", "start", "strings")),
                pa.array(whole[wanted]),
                pa.array(compare[wanted]),
            ],
            names=["token", "copy", "start", "strings", "whole", "compare"],
        )

    def unequal(rows: pa.RecordBatch):
        """Without rows that are there twice, from equal texts of several tasks."""
        start, token = rows.column("start").to_numpy(), rows.column("token").to_numpy()
        copies = np.array(rows.column("copy").to_pylist(), dtype="S16")
        equal = (start[1:] == start[:-1]) & (token[1:] == token[:-1]) & (copies[1:] == copies[:-1])
        return rows.filter(pa.array(np.r_[True, ~equal]))

    for batch in _joined_batches(batches, 1 << 14):
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        rows = unequal(rows)
        yield decided(rows, before, False)
        if len(rows) > 1:
            row = rows.slice(len(rows) - 2, 1)
            before = row.column("token")[0].as_py(), row.column("print")[0].as_py()
        held = rows.slice(len(rows) - 1, 1)
    if held is not None:
        yield decided(held, before, True)


def _packed(batches):
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            packed = [packer.compress(t.as_buffer()) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("copy"), pa.array(packed, pa.binary())], names=["copy", "packed"])


def _cutter(length: int):
    def run(batches):
        import zstandard

        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for copy, packed, records in zip(*(batch.column(n) for n in ("copy", "packed", "records"))):
                data, copy = reader.decompress(packed.as_buffer()), copy.as_py()
                rows = [(r["token"], r["start"], data[r["start"] : r["start"] + r["strings"] + length - 1]) for r in records.as_py()]
                token, start, cut = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token, pa.int64()), pa.array([copy] * len(rows), pa.binary()), pa.array(start, pa.int64()), pa.array(cut, pa.binary())],
                    names=["token", "copy", "start", "bytes"],
                )

    return run


def repeated_suffixes(records: list[bytes], group: np.ndarray, length: int) -> np.ndarray:
    """Which strings of ``length`` in ``records`` are there twice in one group.

    One flag per string, record by record. Multikey quicksort with characters of
    eight bytes: sets of suffixes that agree so far are split by the next
    character, and a suffix alone in its set is out.
    """
    sizes = np.array([len(r) for r in records])
    number = sizes - length + 1
    base = np.cumsum(np.r_[0, sizes[:-1]])
    data = b"".join(records) + bytes(8)
    characters = np.ndarray(len(data) - 7, dtype=">u8", buffer=data, strides=(1,))
    owner = np.repeat(np.arange(len(records)), number)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(np.r_[0, number[:-1]]), number) + base[owner]
    found = np.zeros(len(owner), dtype=bool)
    suffix, sets = np.arange(len(owner)), group[owner]
    order = np.argsort(sets, kind="stable")
    suffix, sets = suffix[order], sets[order]
    steps = [*range(0, length - 7, 8)]
    if steps[-1] + 8 < length:
        steps.append(length - 8)
    for step in steps:
        if not len(suffix):
            return found
        character = characters[at[suffix] + step].astype(np.uint64)
        together = sets[1:] == sets[:-1]
        mixed = np.r_[False, together & (character[1:] != character[:-1])]
        if mixed.any():
            # Only sets that differ in this character are sorted.
            first = np.r_[True, ~together]
            named = np.cumsum(first) - 1
            some = np.flatnonzero(np.bincount(named, mixed)[named] > 0)
            inside = some[np.lexsort((character[some], named[some]))]
            suffix[some], character[some] = suffix[inside], character[inside]
        same = together & (character[1:] == character[:-1])
        alone = ~(np.r_[False, same] | np.r_[same, False])
        sets = np.cumsum(np.r_[True, ~same])[~alone]
        suffix = suffix[~alone]
    found[suffix] = True
    return found


def _spans(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Bytes covered by the flagged strings of a record, merged."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.view(np.int8), 0]))
    return [(int(a), int(b) + length - 1) for a, b in zip(edges[::2], edges[1::2])]


def _sorter(length: int):
    """Compares the records of whole tokens, as they come sorted by token."""

    def compared(rows):
        tokens, copies, starts, records = zip(*rows)
        _, group = np.unique(np.array(tokens), return_inverse=True)
        flags = repeated_suffixes(records, group, length)
        out, place = [], 0
        for copy, start, record in zip(copies, starts, records):
            number = len(record) - length + 1
            out += [(copy, start + a, start + b) for a, b in _spans(flags[place : place + number], length)]
            place += number
        columns = zip(*out) if out else [[]] * 3
        kinds = [pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["copy", "start", "stop"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("token", "copy", "start", "bytes"))):
                if size >= _SORT_BYTES and row[0] != held[-1][0]:
                    yield compared(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield compared(held)

    return run


def _windows(part: np.ndarray, hashers, length: int) -> tuple[np.ndarray, ...]:
    """Of the strings of a part: first places, two fingerprints, whether there is more than one.

    Also the spans of the strings that stand in the part before.
    """
    one, other = (h.grams(h.sums(part), length).view(np.int64) for h in hashers)
    order = np.lexsort((np.arange(len(one)), other, one))
    fresh = np.r_[True, (one[order][1:] != one[order][:-1]) | (other[order][1:] != other[order][:-1])]
    first = order[fresh]
    number = np.diff(np.r_[np.flatnonzero(fresh), len(order)])
    later = np.zeros(len(one), dtype=bool)
    later[order[~fresh]] = True
    spans = np.array(_spans(later, length), dtype=np.int64).reshape(-1, 2)
    return first, one[first], other[first], number > 1, spans


def _windower(length: int):
    """Two fingerprints of every different string of a record; spans of the others."""

    def batch(copy, start, stop, one, other, twice):
        columns = [pa.array([copy] * len(start), pa.binary()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())]
        columns += [pa.array(x, pa.int64()) for x in (one, other)] + [pa.array(twice, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=["copy", "start", "stop", "one", "other", "twice"])

    def run(batches):
        hashers = _Hasher(), _Hasher(_BASE ^ 0x5A5A5A5A5A5A5A5A, 2)
        for rows in batches:
            for copy, start, record in zip(*(rows.column(n) for n in ("copy", "start", "bytes"))):
                copy, start, data = copy.as_py(), start.as_py(), np.frombuffer(record.as_buffer(), dtype=np.uint8)
                for base in range(0, len(data) - length + 1, _CHUNK):
                    part = data[base : base + _CHUNK + length - 1]
                    first, one, other, twice, spans = _windows(part, hashers, length)
                    at = first + base + start
                    yield batch(copy, at, at + length, one, other, twice)
                    if len(spans):
                        nothing = [None] * len(spans)
                        yield batch(copy, *(spans + base + start).T, nothing, nothing, nothing)

    return run


def _counted(records: DataFrame, length: int) -> DataFrame:
    """Spans of the strings of ``records`` that are there twice, by fingerprints."""
    windows = stored(records.mapInArrow(_windower(length), _WINDOWS), "windows")
    inside = windows.where("one IS NULL").select("copy", "start", "stop")
    windows = windows.where("one IS NOT NULL")
    often = windows.groupBy("one", "other").agg(F.count("*").alias("n"), F.max("twice").alias("twice"))
    often = often.where("n > 1 OR twice").select("one", "other")
    found = windows.join(often, ["one", "other"], "left_semi")
    return found.select("copy", "start", "stop").union(inside)


def _merged(spans) -> list[tuple[int, int]]:
    """Spans that overlap or touch made one."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(stop, merged[-1][1])
        else:
            merged.append((start, stop))
    return merged


def _remover(length: int):
    names = [c.split()[0] for c in _RESULT.split(", ")]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def removed(copy, number, packed, spans, reader):
        data = reader.decompress(packed.as_buffer())
        # A text that is there twice is covered whole, unless it is too short.
        everything = number.as_py() > 1 and len(data) >= length
        found = [(0, len(data))] if everything else _merged((s["start"], s["stop"]) for s in spans.as_py() or ())
        edges = [0, *(edge for span in found for edge in span), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        return copy.as_py(), len(data), len(data) - len(kept), len(found), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")

    def run(batches):
        import zstandard

        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                columns = (batch.slice(first, 128).column(c) for c in ("copy", "n", "packed", "spans"))
                rows = [removed(*row, reader) for row in zip(*columns)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def _copy():
    """Key of a text as it is."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _repeats(rows: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Spans (copy, start, stop) of each different text's strings found elsewhere."""
    records = rows.mapInArrow(_suffixes(length), _RECORD)
    place = ["token", "print", "copy", "start"]
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = records.repartitionByRange(buckets, *place).sortWithinPartitions(*place)
    kept = stored(ordered.mapInArrow(_neighbours, _KEPT), "kept")
    stop = F.col("start") + F.col("strings") + length - 1
    whole = kept.where("whole").select("copy", "start", stop.alias("stop"))

    compare = kept.where("compare").select("token", "copy", "start", "strings")
    lists = compare.groupBy("copy").agg(
        F.collect_list(F.struct("token", "start", "strings")).alias("records")
    )
    cut = stored(texts.join(lists, "copy").select("copy", "packed", "records").mapInArrow(_cutter(length), _BYTES), "cut")
    held = cut.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.octet_length("bytes")).alias("bytes"))
    many = stored(held.where((F.col("n") > _TOKEN_RECORDS) | (F.col("bytes") > _TOKEN_BYTES)).select("token"), "many")
    few = cut.join(many, "token", "left_anti").repartition("token").sortWithinPartitions("token")
    spans = whole.union(few.mapInArrow(_sorter(length), _SPAN))
    if not many.isEmpty():
        spans = spans.union(_counted(cut.join(many, "token", "left_semi"), length))
    return spans


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """Adds to the rows of ``docs`` what is left of ``text`` and what was removed.

    Removed is each byte of the text in UTF-8 that a string of ``length`` bytes
    covers which also starts anywhere else in the table, the same text included.
    Returns ``docs`` with n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of all bytes left) and kept_text (without the rest of a character
    that a cut has split). A null
    text is empty. Rows repeated as a whole, or with equal texts, are documents of
    their own, so of those nothing is left that is ``length`` long or more. Nulls
    in other columns change nothing; an empty table gives an empty result. Columns
    of ``docs`` with the names of results are replaced. ``length`` is over 64.
    """
    if length <= _GRAM:
        raise ValueError(f"length must be over {_GRAM}")
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(_copy().alias("copy"), "text")
    texts = rows.mapInArrow(_packed, "copy binary, packed binary")
    texts = texts.groupBy("copy").agg(F.first("packed").alias("packed"), F.count("*").alias("n"))
    spans = _repeats(rows, texts, length)
    # Equal spans of equal texts are merged before they are listed per text.
    lists = spans.groupBy("copy", "start").agg(F.max("stop").alias("stop"))
    lists = lists.groupBy("copy").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cleaned = texts.join(lists, "copy", "left").select("copy", "n", "packed", "spans")
    cleaned = cleaned.mapInArrow(_remover(length), _RESULT)
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    own = [c for c in docs.columns if c not in added]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.unhex(F.md5(text.cast("binary"))).alias("key"), F.struct(*own).alias("doc"))
    joined = rows.join(cleaned.withColumnRenamed("copy", "of"), F.col("key") == F.col("of"))
    return joined.select("doc.*", *added)
