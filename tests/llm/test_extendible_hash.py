"""Exact duplicates against grouping by the normalised text."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import extendible_hash
from gaugeflow.llm.extendible_hash import build_index, exact_duplicates

from .helpers import docs, rows_of

SF = "/root/testdata/sf0.01"
LONG = "a long  text\t" * 60_000


def expected(rows):
    groups = defaultdict(list)
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    for row, text in zip(rows, texts):
        groups[text].append(row[0])
    out, taken = [], set()
    for row, text in zip(rows, texts):
        least = min((i for i in groups[text] if i is not None), default=None)
        first = row[0] == least and text not in taken
        taken |= {text} if first else set()
        out.append((row[0], least, len(groups[text]), first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


ODD = [
    (5, "same  text", "en", "s", 1), (3, "same\ttext", "en", "s", 1), (3, "same\ttext", "en", "s", 1), (9, " same text", "en", "s", 1),
    (8, "same text ", None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (4, " ", "en", "s", 1), (7, "\n\n\t", "en", "s", 3),
    (None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5), (None, "same text", "en", "s", 1), (6, "same text", "en", "s", 1),
    (10, LONG, "en", "s", 9), (11, LONG + " ", "en", "s", 9), (12, LONG.replace("  ", "\r\n"), "en", "s", 9), (13, "é\x00" * 3, "fr", "s", 6),
]


@pytest.mark.parametrize("options", [
    {},
    {"bucket_keys": 1, "bucket_bytes": 1},
    {"window_bytes": 1, "window_rows": 1},
    {"window_rows": 3, "bucket_keys": 2},
    {"key": "xxhash64(length(content))", "bucket_keys": 1},
    {"key": "-1L", "bucket_keys": 1},
])
def test_odd_texts_sizes_and_colliding_keys(spark, options):
    assert rows_of(exact_duplicates(docs(spark, ODD), **options)) == expected(ODD)


def test_empty_table(spark):
    assert exact_duplicates(docs(spark, ODD).limit(0)).collect() == []


def test_a_text_that_a_third_of_all_rows_hold(spark):
    rows = [(i, "the same" if i % 3 == 0 else f"text {i // 2}", "en", "s", 1) for i in range(3000)]
    frame = docs(spark, rows).repartition(7)
    index = build_index(frame, bucket_keys=64)
    assert index.rows.count() == 3000
    hot = index.links.groupBy("bucket", "key", "link").agg(F.count("*").alias("n"), F.first("group_size").alias("size"))
    (most,) = hot.where("size = 1000").collect()
    assert most["n"] <= 7  # an entry per task, not one per row
    assert rows_of(exact_duplicates(frame, bucket_keys=64)) == expected(rows)


def test_overfull_buckets_split_and_no_key_has_two(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    index = build_index(frame, bucket_keys=20, bucket_bytes=20_000)
    keys = index.links.select("bucket", "key").distinct()
    assert keys.count() == keys.select("key").distinct().count()
    sizes = frame.select(extendible_hash.normalised(F.col("text")).alias("content")).distinct()
    sizes = sizes.select(F.xxhash64("content").alias("key"), F.octet_length("content").alias("size"))
    fill = keys.join(sizes, "key").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    assert fill.where("n > 20 OR size > 20000 AND n > 1").count() == 0
    assert index.directory.count() > 0
    slots = index.directory.select("slot", F.explode("splits").alias("x")).select("slot", "x.*").collect()
    nodes = {(r["depth"], r["prefix"]) for r in slots}
    assert len(nodes) == len(slots)
    for r in slots:  # a split node hangs below another one or below a slot
        assert r["prefix"] >> (r["depth"] - index.depth) == r["slot"]
        assert r["depth"] == index.depth or (r["depth"] - 1, r["prefix"] >> 1) in nodes
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    assert rows_of(exact_duplicates(frame, bucket_keys=20, bucket_bytes=20_000)) == expected(rows)
