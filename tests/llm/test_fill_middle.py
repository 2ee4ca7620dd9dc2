"""Fill-in-the-middle against cutting a list of lines."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeflow.llm import fill_middle, queries
from gaugeflow.llm.fill_middle import ChunkCache, LineMap, Markers, chunk_ends, fill_in_middle, restored

from .helpers import docs, rows_of

SF = "/root/testdata/sf0.01"


def slow(doc_id, text, seed=7, rate=100, spm=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    P, S, M = marks
    form = "spm" if h[3] % 100 < spm else "psm"
    output = S + s + P + p + M + m if form == "spm" else P + p + S + s + M + m
    return doc_id, n, form, len(p), len(m), output


ODD = [
    (1, None), (2, ""), (3, "\n"), (4, "one line"), (5, "a\nb\nc\n"), (5, "a\nb\nc\n"), (6, "é\n ü\r\n\x0b𝄞\n" * 40), (7, "x <S> y\nz"),
    (8, "<<P\n<S\n>>M>\n" * 9), (None, "no id\nat all\n"), (9, "\n" * 100_000), (10, "long line " * 60_000), (11, "word\n" * 70_000), (12, "$1\n\\2\n$"),
]


def test_odd_texts(spark):
    frame = docs(spark, [(i, t, "en", "s", 1) for i, t in ODD])
    made = fill_in_middle(frame).cache()
    assert rows_of(made) == sorted((slow(i, t) for i, t in ODD), key=repr)
    texts = made.select(restored(F.col("form"), F.col("output")).alias("t")).collect()
    assert sorted(r["t"] for r in texts) == sorted(t or "" for _, t in ODD)
    assert fill_in_middle(frame.limit(0)).collect() == []


def test_rates_and_markers(spark):
    rows = [(i, f"first {i}\nsecond\nthird <P>", "en", "s", 1) for i in range(200)]
    marks = Markers("[.", "(*", "{^")
    made = fill_in_middle(docs(spark, rows), seed=3, rate=60, spm_rate=20, markers=marks)
    assert rows_of(made) == sorted((slow(r[0], r[1], 3, 60, 20, ("[.", "(*", "{^")) for r in rows), key=repr)
    back = made.select("doc_id", restored(F.col("form"), F.col("output"), marks).alias("t")).collect()
    assert sorted((r["doc_id"], r["t"]) for r in back) == sorted((r[0], r[1]) for r in rows)


def test_query_is_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [(*(s := slow(r["doc_id"], r["text"]))[:5], digest(s[5]), digest(r["text"] or "")) for r in rows]
    assert rows_of(queries.queries()["op12_fill_middle"](spark, SF)) == sorted(expected, key=repr)


@settings(max_examples=80, deadline=None)
@given(st.text("ab\né𝄞", max_size=300), st.integers(1, 400), st.integers(1, 6))
def test_counts_over_chunks_locate_every_line(text, longest, bits):
    before = fill_middle._LONGEST_CHUNK, fill_middle._CHUNK_BITS, fill_middle._SLAB
    fill_middle._LONGEST_CHUNK, fill_middle._CHUNK_BITS, fill_middle._SLAB = longest, bits, 50
    try:
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        for cache in (ChunkCache(), ChunkCache(10)):
            lines = LineMap(text.encode(), cache)
            assert lines.n == len(units)
            for k in range(len(units) + 1):
                part = "".join(units[:k])
                assert lines.end_of(k) == (len(part.encode()), len(part))
    finally:
        fill_middle._LONGEST_CHUNK, fill_middle._CHUNK_BITS, fill_middle._SLAB = before


def test_chunks_follow_content_and_are_shared():
    drawn = np.random.default_rng(1)
    body = drawn.integers(32, 127, 200_000, dtype=np.uint8).tobytes()
    one, other = (chunk_ends(start + body) - len(start) for start in (b"x" * 77, b"another start"))
    late = lambda ends: set(ends[ends > 64].tolist())
    assert late(one) == late(other) and len(late(one)) > 100
    cache = ChunkCache()
    LineMap(b"x" * 77 + body, cache)
    known = len(cache.known)
    LineMap(b"another start" + body, cache)
    assert len(cache.known) <= known + 2
    assert chunk_ends(b"").tolist() == [0] and max(np.diff(chunk_ends(bytes(100_000)))) <= fill_middle._LONGEST_CHUNK
