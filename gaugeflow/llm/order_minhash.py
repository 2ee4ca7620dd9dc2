"""Near-duplicate documents by Order MinHash and banded alignment.

Words make five-word shingles, each labelled with its number of occurrence so
far. A sketch takes the few labelled shingles with the least hashes, in the
order in which they stand in the text; two of these make a band. Texts that
share two of 24 bands are candidates, and an alignment of their shingle sequences inside
a band around the diagonal decides: similarity is the aligned shingles over the
aligned and unaligned ones.

Within a band all texts are compared with one leader. The similarity's distance
is a metric, so a text that is far from the leader cannot be similar to one
that is near it. Texts in between are compared with those near the leader, and
texts not similar to the leader with each other, both in blocks of bounded size
whose tasks return no more links than they have texts. So no link is lost, and
no group is paired out.

Where a leader has more texts unlike it than a block holds, as with a passage
that unlike texts share, these are told apart first: shingles are ordered by the
number of texts that hold them, and of two similar texts each has a common one
among its first ones, however these are ordered. Only texts connected by such
shingles are compared; a text whose first shingles are its own goes.
"""

import hashlib
import re
import zlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.components import components
from gaugeflow.llm.frames import stored

_SHINGLE_WORDS = 5
_BANDS = 24
_SHARED_BANDS = 2
_SKETCHES_PER_BAND = 2
_KEPT_PER_SKETCH = 2
_BLOCK_TEXTS = 256
_MATRIX_CELLS = 1 << 20
_LARGEST = np.uint64((1 << 64) - 1)
_WORD = re.compile(r"\w+")
_SKETCHED = "doc_id long, copy binary, content binary, bands array<long>"
_TEXTS = "content binary, shingles binary"
_PAIRS = "a binary, b binary, similarity double"
_SPELLED = "b binary, needed int, shingle long"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return _WORD.findall(text.lower()) if text else []


def _content(found: list[str]) -> bytes | None:
    """Key of a word sequence; null without a word."""
    return hashlib.md5(" ".join(found).encode("utf-8", "replace")).digest() if found else None


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingles(found: list[str]) -> np.ndarray:
    """Hash of every five words in a row; of all words if there are fewer."""
    codes = np.array([zlib.crc32(w.encode("utf-8", "replace")) ^ len(w) << 32 for w in found], dtype=np.uint64)
    codes = _mixed(codes * _ODD + np.uint64(1))
    number = max(1, len(codes) - _SHINGLE_WORDS + 1)
    total = np.zeros(number, dtype=np.uint64)
    for place in range(min(_SHINGLE_WORDS, len(codes))):
        total = total * _ODD + codes[place : place + number]
    return _mixed(total)


def _occurrences(hashes: np.ndarray) -> np.ndarray:
    """How often each shingle stood before."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    place = np.arange(len(hashes))
    counted = np.empty(len(hashes), dtype=np.uint64)
    counted[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return counted


def labelled_shingles(found: list[str]) -> np.ndarray:
    """The shingles of a text in order, equal ones told apart by their occurrence."""
    hashes = shingles(found)
    return _mixed(hashes + _occurrences(hashes) * _ODD)


def bands(labelled: np.ndarray) -> np.ndarray:
    """Band keys of a text's labelled shingles."""
    sketches, number = _BANDS * _SKETCHES_PER_BAND, len(labelled)
    parts = np.zeros(sketches, dtype=np.uint64)
    salts = _mixed(np.arange(1, sketches + 1, dtype=np.uint64) * _ODD)
    step = max(1, _MATRIX_CELLS // number)
    for start in range(0, sketches, step):
        drawn = _mixed(labelled[None, :] ^ salts[start : start + step, None])
        rows = np.arange(len(drawn))
        least = []
        for _ in range(min(_KEPT_PER_SKETCH, number)):
            least.append(drawn.argmin(axis=1))
            drawn[rows, least[-1]] = _LARGEST
        for places in np.sort(np.stack(least), axis=0):  # in text order
            parts[start : start + step] = _mixed(parts[start : start + step] * _ODD + labelled[places])
    keys = np.arange(1, _BANDS + 1, dtype=np.uint64)
    for part in parts.reshape(_BANDS, -1).T:
        keys = _mixed(keys * _ODD + part)
    return keys.view(np.int64)


def _longest_rise(values: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    if (values[1:] > values[:-1]).all():
        return len(values)
    ends: list[int] = []
    for value in values.tolist():
        place = bisect_left(ends, value)
        ends[place : place + 1] = [value]
    return len(ends)


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Aligned shingles over aligned and unaligned ones; 0.0 if under ``least``.

    Labelled shingles are unique in a text, so the best alignment is the longest
    run of common ones whose places rise in both. Places further apart than the
    unaligned shingles that ``least`` allows are outside the band.
    """
    both = len(a) + len(b)
    most = int(both * (1 - least) / (1 + least) + 1e-9)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    inside = np.abs(i - j) <= most
    i, j = i[inside], j[inside]
    if 2 * len(i) < both - most:
        return 0.0
    aligned = _longest_rise(j[np.argsort(i)])
    return aligned / (both - aligned) if 2 * aligned >= both - most else 0.0


def _sketcher(batches):
    """Key and bands of each text; nulls for a text without a word."""
    for batch in batches:
        contents, keys = [], []
        for text in batch.column("text"):  # one text's words at a time
            found = words(text.as_py())
            contents.append(_content(found))
            keys.append(bands(labelled_shingles(found)) if found else None)
        columns = [
            batch.column("doc_id"),
            batch.column("copy"),
            pa.array(contents, pa.binary()),
            pa.array(keys, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "content", "bands"])


def _shingled(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            found = [labelled_shingles(words(t)).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("content"), pa.array(found, pa.binary())], names=["content", "shingles"]
            )


def _speller(least: float):
    """A row for each shingle of each text, with how many of them a similar text has at least."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                found = np.frombuffer(part.column("shingles")[0].as_py(), dtype="<i8")
                needed = max(1, int(np.ceil(least * len(found) - 1e-6)))
                for start in range(0, len(found), 1 << 16):
                    some = found[start : start + (1 << 16)]
                    columns = [
                        part.column("content").take(pa.array(np.zeros(len(some), dtype=np.int64))),
                        pa.array(np.full(len(some), needed, dtype=np.int32)),
                        pa.array(some),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["b", "needed", "shingle"])

    return run


def _arrays(column) -> list[np.ndarray]:
    return [np.frombuffer(blob, dtype="<u8") for blob in column]


def _verifier(least: float):
    """Similarity of a leader to each text of a block; pairs under ``least`` go."""

    def run(key, leader: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        first = _arrays(leader["shingles"])[0]
        found = [similarity(first, other, least) for other in _arrays(block["shingles"])]
        rows = pd.DataFrame({"a": key[0], "b": block["b"], "similarity": found}, columns=["a", "b", "similarity"])
        return rows[rows["similarity"] > 0]

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shingles that each text of ``left`` has in common with each of ``right``."""
    names = np.intersect1d(np.concatenate(left), np.concatenate(right))
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    width = max(1, _MATRIX_CELLS // max(len(left), len(right)))
    for start in range(0, len(names), width):
        some = names[start : start + width]
        sides = []
        for texts in (left, right):
            has = np.zeros((len(texts), len(some)), dtype=np.float32)
            for row, shingle in enumerate(texts):
                at = np.searchsorted(some, shingle)
                at[at == len(some)] = 0
                has[row, at[some[at] == shingle]] = 1
            sides.append(has)
        counts += sides[0] @ sides[1].T
    return counts


def _crosser(least: float):
    """A link for each fringe text that is similar to one of the leader's texts."""

    def run(key, fringe: pd.DataFrame, close: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(fringe) and len(close):
            left, right = _arrays(fringe["shingles"]), _arrays(close["shingles"])
            sizes = [np.array([len(x) for x in side]) for side in (left, right)]
            # No alignment has more than the common shingles.
            needed = least / (1 + least) * (sizes[0][:, None] + sizes[1][None, :]) - 1e-6
            common = _common(left, right)
            for row in np.flatnonzero((common >= needed).any(axis=1)):
                for other in np.flatnonzero(common[row] >= needed[row]):
                    if similarity(left[row], right[other], least) > 0:
                        out.append((fringe["b"].iat[row], close["b"].iat[other]))
                        break
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _pairer(least: float):
    """Links that connect the similar texts of two blocks, or of one."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        out, block = [], rows["block"].to_numpy()
        first, second = (np.flatnonzero(block == number) for number in key[1:])
        shingled, names = _arrays(rows["shingles"]), rows["b"].tolist()
        group = np.unique(np.array([c.hex() for c in rows["component"]]), return_inverse=True)[1]
        if len(first) and len(second) and len(np.unique(group)) > 1:
            left, right = ([shingled[i] for i in side] for side in (first, second))
            sizes = [np.array([len(x) for x in side]) for side in (left, right)]
            needed = least / (1 + least) * (sizes[0][:, None] + sizes[1][None, :]) - 1e-6
            for i, j in np.argwhere(_common(left, right) >= needed):
                i, j = first[i], second[j]
                if group[i] != group[j] and similarity(shingled[i], shingled[j], least) > 0:
                    out.append((names[i], names[j]))
                    group[group == group[j]] = group[i]
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _blocked(pairs: DataFrame) -> DataFrame:
    """Adds the block of b among the texts of a, and how many blocks there are."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / _BLOCK_TEXTS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    return pairs.join(sizes, "a").withColumn("block", block)


def _with_shingles(rows: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    return rows.join(texts.select(F.col("content").alias(name), "shingles"), name)


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """a, b and similarity of the pairs that are at least ``least`` similar."""
    blocked = _blocked(pairs)
    leaders = _with_shingles(blocked.select("a", "block").distinct(), texts, "a")
    leaders = leaders.toDF("a", "block", "shingles").groupBy("a", "block")  # columns of its own
    blocks = _with_shingles(blocked.select("b", "a", "block"), texts, "b").groupBy("a", "block")
    return leaders.cogroup(blocks).applyInPandas(_verifier(least), _PAIRS)


def _crossed(fringe: DataFrame, close: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links between the fringe texts and the close texts of the same leader."""
    left, right = (stored(_blocked(x.select("a", "b")), "blocks") for x in (fringe, close))
    count = lambda x, name: x.groupBy("a").agg(F.max("blocks").alias(name))
    left = left.join(count(right, "others"), "a").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    right = right.join(count(left, "others"), "a").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    left = left.select("a", F.col("block").alias("x"), F.col("other").alias("y"), "b")
    right = right.select("a", F.col("other").alias("x"), F.col("block").alias("y"), "b")
    left, right = (_with_shingles(x, texts, "b").toDF("b", "a", "x", "y", "shingles") for x in (left, right))
    left, right = left.groupBy("a", "x", "y"), right.groupBy("a", "x", "y")
    return left.cogroup(right).applyInPandas(_crosser(least), "a binary, b binary")


def _starred(groups: DataFrame) -> DataFrame:
    """(band, a, b): every text b of a band with its leader a."""
    order = F.struct(F.xxhash64("content").alias("order"), "content")
    leader = groups.groupBy("band").agg(F.min(order)["content"].alias("a"))
    return groups.join(leader, "band").where("content != a").select("band", "a", F.col("content").alias("b"))


def _shared_bands(sketched: DataFrame) -> DataFrame:
    """(content, band) of the texts that share a band with a different text."""
    banded = sketched.where("content IS NOT NULL").select("content", F.explode("bands").alias("band"))
    spread = banded.groupBy("band").agg(F.min("content").alias("one"), F.max("content").alias("other"))
    shared = spread.where("one != other").select("band")
    return banded.join(shared, "band", "left_semi").distinct()


def _texts_of(rows: DataFrame, sketched: DataFrame, groups: DataFrame) -> DataFrame:
    """content and labelled shingles of every text in ``groups``, each once."""
    wanted = sketched.join(groups.select("content").distinct(), "content", "left_semi")
    wanted = wanted.groupBy("content").agg(F.min("copy").alias("copy"))
    once = rows.groupBy(_copy().alias("copy")).agg(F.first("text").alias("text"))
    return once.join(wanted, "copy").select("content", "text").mapInArrow(_shingled, _TEXTS)


def _copy():
    """Key of a text as it is."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _unlinked(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) whose texts are not in one component yet."""
    for side in ("a", "b"):
        named = member.select(F.col("id").alias(side), F.col("component").alias(f"of_{side}"))
        pairs = pairs.join(named, side, "left")
    apart = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
    return pairs.where(apart).drop("of_a", "of_b")


def _connected(texts: DataFrame, least: float) -> DataFrame:
    """(b, part) of the texts that may be similar to another one; similar ones have one part.

    A text of n shingles shares at least ``least`` of them with a similar one. In one
    order of all shingles, here by rising number of texts, two similar texts then have
    a common shingle that in neither is among the last ``least * n - 1``.
    """
    counts = texts.mapInArrow(_speller(least), _SPELLED).groupBy("shingle").agg(F.count("*").alias("n"))
    counts = stored(counts.where("n > 1"), "counts")
    held = texts.mapInArrow(_speller(least), _SPELLED).join(counts, "shingle")
    last = Window.partitionBy("b").orderBy(F.desc("n"), F.desc("shingle"))
    first = held.withColumn("row", F.row_number().over(last)).where("row >= needed")
    first = stored(first.select("b", "shingle"), "first")
    one = first.groupBy("shingle").agg(F.min("b").alias("one"))
    members = components(first.join(one, "shingle").select("b", "one"), "b", "one")
    return members.select(F.col("id").alias("b"), F.col("component").alias("part"))


def _told_apart(left: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The texts b of each leader a, those of a leader of many grouped by part."""
    many = left.groupBy("a").count().where(F.col("count") > _BLOCK_TEXTS).select("a")
    many = stored(left.join(many, "a", "left_semi"), "many")
    if many.isEmpty():
        return left
    some = texts.join(many.select(F.col("b").alias("content")).distinct(), "content", "left_semi")
    parts = stored(_connected(some, least), "parts")
    grouped = many.join(parts, "b").select(F.concat("a", "part").alias("a"), "b")
    return left.join(many.select("a").distinct(), "a", "left_anti").select("a", "b").union(grouped)


def _paired(left: DataFrame, member: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links among the texts b of each leader a, by pairs of blocks."""
    named = member.select(F.col("id").alias("b"), "component")
    left = _told_apart(stored(left, "left"), texts, least)
    blocked = stored(_blocked(left).join(named, "b", "left"), "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocked = blocked.withColumn("other", other).select(
        "b", "a", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "block", F.coalesce("component", "b").alias("component"),
    )
    rows = _with_shingles(blocked, texts, "b")
    return rows.groupBy("a", "x", "y").applyInPandas(_pairer(least), "a binary, b binary")


def _candidates(starred: DataFrame, sketches: DataFrame) -> DataFrame:
    """The different pairs (a, b) that share at least ``_SHARED_BANDS`` bands."""
    pairs = starred.select("a", "b").distinct()
    for side in ("a", "b"):
        named = sketches.select(F.col("content").alias(side), F.col("bands").alias(f"of_{side}"))
        pairs = pairs.join(named, side)
    shared = F.size(F.array_intersect("of_a", "of_b")) >= _SHARED_BANDS
    return pairs.where(shared).select("a", "b")


def _linked(groups: DataFrame, texts: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """(id, component) of the linked ones among texts that share bands."""
    near = max(0.0, 1 - 2 * (1 - least))
    starred = stored(_starred(groups), "starred")
    pairs = stored(_candidates(starred, sketches), "pairs")
    found = stored(_verified(pairs, texts, near), "found")
    close = found.where(F.col("similarity") >= least).select("a", "b")
    member = stored(components(close, "a", "b"), "members")

    # A text neither similar to a leader nor far from it may be similar to one
    # that the leader stands for, if both are not linked already.
    fringe = _unlinked(found.where(F.col("similarity") < least), member)
    crossed = _crossed(fringe, close, texts, least)
    judged = starred.join(close.withColumn("near", F.lit(True)), ["a", "b"], "left")
    left = judged.where("near IS NULL").select("a", "b").distinct()
    links = close.union(crossed).union(_paired(left, member, texts, least))
    return stored(components(links, "a", "b"), "members")


def _classes(docs: DataFrame, least: float) -> DataFrame:
    """doc_id, copy (key of the text) and component of every row; null without a word."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = rows.select("doc_id", _copy().alias("copy"), "text").mapInArrow(_sketcher, _SKETCHED)
    sketched = stored(sketched, "sketches")
    groups = stored(_shared_bands(sketched), "groups")
    texts = stored(_texts_of(rows, sketched, groups), "texts")
    some = sketched.join(groups.select("content").distinct(), "content", "left_semi")
    some = stored(some.groupBy("content").agg(F.first("bands").alias("bands")), "some")
    member = _linked(groups, texts, some, least)

    keyed = sketched.select("doc_id", "copy", "content")
    worded = keyed.where("content IS NOT NULL").join(member, F.col("content") == F.col("id"), "left")
    worded = worded.select("doc_id", "copy", F.coalesce("component", "content").alias("component"))
    alone = keyed.where("content IS NULL").select("doc_id", "copy", "content")
    return stored(worded.union(alone), "classes")


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id and class_id of every row of ``docs`` (doc_id, text).

    class_id is the smallest doc_id of the row's class: the rows reached through
    texts with equal words or a similarity of ``least`` or more (five-word
    shingles; see the module). A text of fewer than five words is one shingle.
    Rows without a word (null, empty, marks only) are a class of their own, with
    their own id. Repeated rows and ids are in one class if their words are
    equal; a null id takes part, and a class of null ids only has a null
    class_id. Other columns are ignored; an empty table gives an empty result.
    """
    classes = _classes(docs, least)
    worded = classes.where("component IS NOT NULL").select("doc_id", "component")
    least_ids = worded.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    classed = worded.join(least_ids, "component").select("doc_id", "class_id")
    alone = classes.where("component IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    return classed.union(alone)


def one_of_each_class(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The row with the smallest doc_id of every class of ``near_duplicates``.

    A null id counts as the largest. Of rows with equal id and text one stays, the
    one whose other columns hash least, so that a repeated task keeps the same row.
    Rows without a word all stay, but for those with equal id and text. Columns may
    have any names.
    """
    classes = _classes(docs, least)
    worded, alone = (classes.where(f"component IS {x} NULL") for x in ("NOT", ""))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")).alias("first")
    kept = worded.groupBy("component").agg(first).select("first.doc_id", "first.copy")
    kept = kept.union(alone.select("doc_id", "copy").distinct())

    def key(doc_id, copy):
        return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.hex(copy), F.lit("-")))

    kept = kept.select(key(F.col("doc_id"), F.col("copy")).alias("kept"))
    copy = F.unhex(F.md5(F.col("text").cast("string").cast("binary")))
    others = F.struct(F.lit(0), *[c for c in docs.columns if c != "text"])  # texts are equal
    rows = docs.select(key(F.col("doc_id"), copy).alias("key"), F.xxhash64(F.to_json(others)).alias("mark"), F.struct("*").alias("doc"))
    joined = rows.join(kept, F.col("key") == F.col("kept"))
    order = Window.partitionBy("key").orderBy("mark")
    return joined.withColumn("row", F.row_number().over(order)).where("row = 1").select("doc.*")
