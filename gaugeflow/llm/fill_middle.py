"""Fill-in-the-middle forms of texts, cut at lines found through memoized chunks.

A rolling hash over 32 bytes cuts a text into chunks by content, so that texts that
share passages share chunks. A chunk's summary says how many line ends and code
points it holds and whether its last line is open. Summaries are kept in a bounded
cache by the chunk's bytes, which also verifies them. Sums over the chunks give a
text's number of lines; the running sums say which chunk a cut falls into, and only
that chunk is searched for the line end.

Every row is its own: nothing is shuffled.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A cut is where the hash's top bits are zero, every 1,024 bytes on average.
_CHUNK_BITS = 10
_LONGEST_CHUNK = 16 << 10
_WINDOW = 32
_SLAB = 1 << 20
#: Bytes of chunks that a Python worker remembers.
CACHE_BYTES = 16 << 20
_GEAR = np.random.default_rng(12).integers(0, 1 << 32, 256, dtype=np.uint32)
_CONTINUATION = bytes(range(0x80, 0xC0))
_FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Markers:
    """Texts before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def chunk_ends(data: bytes) -> np.ndarray:
    """Ends of the chunks of ``data``; they follow from the bytes around them.

    The hash of a position is the sum of a random number for each of the last 32
    bytes, shifted by the byte's distance; it is made by doubling the window.
    """
    ends, size = [np.zeros(1, dtype=np.int64)], len(data)
    for start in range(0, size, _SLAB):
        first = max(0, start - _WINDOW + 1)
        rolling = _GEAR[np.frombuffer(data, dtype=np.uint8, count=min(start + _SLAB, size) - first, offset=first)]
        width = 1
        while width < _WINDOW:
            rolling[width:] += rolling[:-width] << np.uint32(width)
            width *= 2
        ends.append(np.flatnonzero(rolling[start - first :] >> np.uint32(32 - _CHUNK_BITS) == 0) + start + 1)
    ends = np.concatenate(ends)
    if size and ends[-1] != size:
        ends = np.append(ends, size)
    gaps = np.flatnonzero(np.diff(ends) > _LONGEST_CHUNK)
    more = [np.arange(ends[g] + _LONGEST_CHUNK, ends[g + 1], _LONGEST_CHUNK) for g in gaps]
    return np.sort(np.concatenate([ends, *more])) if more else ends


def _code_points(data: bytes) -> int:
    return len(data.translate(None, _CONTINUATION))


class ChunkCache:
    """Summaries of chunks by their bytes."""

    def __init__(self, most_bytes: int = CACHE_BYTES):
        self.most, self.size, self.known = most_bytes, 0, {}

    def summary(self, chunk: bytes) -> tuple[int, int, bool]:
        """Line ends, code points, and whether the last line is open."""
        found = self.known.get(chunk)
        if found is None:
            found = (chunk.count(b"\n"), _code_points(chunk), not chunk.endswith(b"\n"))
            if self.size + len(chunk) > self.most:
                self.known, self.size = {}, 0
            self.known[chunk] = found
            self.size += len(chunk)
        return found


class LineMap:
    """Number of lines of a text, and where its lines end."""

    def __init__(self, data: bytes, cache: ChunkCache):
        self.data, self.ends = data, chunk_ends(data)
        places = self.ends.tolist()
        found = [cache.summary(data[a:b]) for a, b in zip(places, places[1:])]
        self.lines = np.cumsum([0, *(s[0] for s in found)])
        self.chars = np.cumsum([0, *(s[1] for s in found)])
        self.n = int(self.lines[-1]) + int(bool(found) and found[-1][2])

    def end_of(self, count: int) -> tuple[int, int]:
        """Byte and code point after the first ``count`` lines."""
        if count == 0:
            return 0, 0
        if count == self.n:
            return len(self.data), int(self.chars[-1])
        chunk = int(np.searchsorted(self.lines, count)) - 1
        start = at = int(self.ends[chunk])
        for _ in range(count - int(self.lines[chunk])):
            at = self.data.index(b"\n", at) + 1
        return at, int(self.chars[chunk]) + _code_points(self.data[start:at])


def _transformed(markers: Markers):
    names = [c.split()[0] for c in _FORMS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    before, after, between = (m.encode() for m in (markers.prefix, markers.suffix, markers.middle))

    def run(batches):
        cache = ChunkCache()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part, rows = batch.slice(start, 512), []
                columns = (part.column(c).to_pylist() for c in ("doc_id", "one", "other", "form", "content"))
                for doc_id, one, other, form, data in zip(*columns):
                    lines = LineMap(data, cache)
                    if not data or any(m in data for m in (before, after, between)):
                        form = "plain"
                    if form == "plain":
                        rows.append((doc_id, lines.n, form, None, None, data))
                        continue
                    low, high = sorted((one % (lines.n + 1), other % (lines.n + 1)))
                    (a, a_chars), (b, b_chars) = lines.end_of(low), lines.end_of(high)
                    if form == "psm":
                        output = (before, data[:a], after, data[b:], between, data[a:b])
                    else:
                        output = (after, data[b:], before, data[:a], between, data[a:b])
                    rows.append((doc_id, lines.n, form, a_chars, b_chars - a_chars, b"".join(output)))
                columns = [pa.array(c, k) for c, k in zip(list(zip(*rows))[:-1], kinds)]
                outputs = pa.array([r[-1] for r in rows], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, outputs], names=names)

    return run


def fill_in_middle(
    docs: DataFrame,
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    markers: Markers = Markers(),
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row of ``docs``.

    Lines end after a line feed or with the text; n is their number. Digits of the
    SHA-256 of ``seed:doc_id`` choose two cuts and the form: ``plain`` for all but
    ``rate`` per cent, else ``spm`` for ``spm_rate`` per cent, else ``psm``. An empty or
    null text, or one that holds a marker, is plain; its output is the text and its
    lengths are null. Lengths are in code points. A null id counts as no digits.
    Repeated rows give repeated results; other columns are ignored.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def number(place: int) -> Column:
        return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long")

    form = F.when(number(2) % 100 >= rate, "plain").when(number(3) % 100 < spm_rate, "spm").otherwise("psm")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        number(0).alias("one"),
        number(1).alias("other"),
        form.alias("form"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("content"),
    )
    return rows.mapInArrow(_transformed(markers), _FORMS)


def restored(form: Column, output: Column, markers: Markers = Markers()) -> Column:
    """The text that ``output`` was made from; no marker stands in its parts."""
    p, s, m = (re.escape(x) for x in (markers.prefix, markers.suffix, markers.middle))
    psm = F.regexp_replace(output, f"(?s)^{p}(.*){s}(.*){m}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{s}(.*){p}(.*){m}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
