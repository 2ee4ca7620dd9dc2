"""Language, the pipeline, and how the subpackage is attached."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeflow.llm import queries, zstd_language
from gaugeflow.llm.order_minhash import near_duplicates
from gaugeflow.llm.zstd_language import learn_languages, predict_languages

from .helpers import docs, rows_of

SF = "/root/testdata/sf0.01"
ROOT = Path(__file__).resolve().parents[2]
#: Names that the stages use for columns of their own, or once did.
CLASHES = (
    "score", "__x", "__key", "__row", "__kept", "__copy", "__mark", "__of", "__times", "key", "kept", "row", "doc", "copy", "mark", "of",
    "times", "n", "spans", "n_removed", "rejected", "size", "weight", "packed",
)


def test_held_out_accuracy(spark):
    frame = queries.queries()["op3_zstd_language"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = frame.join(truth, "doc_id").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert 150 < len(held) < 350
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)


def test_predictions_are_those_of_compressing_every_text(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = learn_languages(frame)
    assert len(model.dictionaries) == 4
    params = zstandard.ZstdCompressionParameters(compression_level=3, min_match=3, strategy=zstandard.STRATEGY_BTOPT, window_log=17)
    kinds = {n: zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for n, d in model.dictionaries.items()}
    expected = []
    for row in frame.collect():
        data = row["text"].lower().encode()
        size = Counter()
        for name, content in kinds.items():
            for i in range(0, len(data), 1024):
                size[name] += len(zstandard.ZstdCompressor(compression_params=params, dict_data=content).compress(data[i : i + 1024]))
        (first, name), (second, _), *_ = sorted((n, name) for name, n in size.items())
        margin = 1 - first / second
        expected.append((row["doc_id"], name, margin, margin < zstd_language.MIN_MARGIN) if any(map(str.isalpha, row["text"])) else (row["doc_id"], "und", 0.0, True))
    assert rows_of(predict_languages(frame, model)) == sorted(expected, key=repr)
    with pytest.raises(ValueError, match="score"):
        predict_languages(frame.withColumn("score", F.lit(1)), model, keep=("score",))


def test_held_out_rows_teach_nothing(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    changed = F.when(zstd_language.is_held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))
    other = frame.withColumn("lang", changed).withColumn("source", F.lit(None).cast("string"))
    assert learn_languages(frame) == learn_languages(other)


def test_odd_texts(spark):
    known = [(i, f"the quick brown fox number {i} runs over there", "en", "s", 1) for i in range(40)]
    known += [(100 + i, f"der schnelle braune fuchs nummer {i} läuft dort drüben", "de", "s", 1) for i in range(40)]
    known += [(None, "teaches nothing", "xx", "s", 1), (300, None, "yy", "s", 1)]
    model = learn_languages(docs(spark, known))
    assert set(model.dictionaries) == {"de", "en"}
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "12 ... !", "en", "s", 3), (4, "THE FOX " * 30_000, "de", "s", 9)]
    odd += [(None, "der fuchs läuft dort", None, None, None)] * 2
    frame = docs(spark, odd)
    found = predict_languages(frame, model)
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["rejected"]) for r in found.collect()))
    assert got == [(0, "de", False)] * 2 + [(1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False)]
    assert predict_languages(frame.limit(0), model).count() == 0
    nothing = learn_languages(frame.limit(0))
    assert {r["lang_pred"] for r in predict_languages(frame, nothing).collect()} == {"und"}


def test_stages_do_what_their_operators_say(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    first = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bad = [(9001, None, None, None, None), (9002, "123 !!!", "en", "src0", 7), (9003, "é" * 300, "fr", None, 300)]
    docs_in = first.union(spark.createDataFrame(bad, first.schema)).withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})
    inputs, outputs = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs_in
        docs_in = outputs[name] = stage(spark, docs_in, "/root/testdata/sf0.001").cache()
        if name != names[-1]:
            assert docs_in.columns == [*first.columns, *CLASHES]
            assert docs_in.select(*CLASHES).distinct().collect() == [tuple(range(len(CLASHES)))]
    ids = lambda frame: {r["doc_id"] for r in frame.select("doc_id").collect()}
    kept = ids(outputs["language_id"])
    assert not kept & {9001, 9002} and len(kept) >= 0.97 * first.count()
    classes = near_duplicates(inputs["minhash_dedup"]).collect()
    assert ids(outputs["minhash_dedup"]) == {r["class_id"] for r in classes}
    assert outputs["minhash_dedup"].count() == len({r["class_id"] for r in classes})
    assert ids(outputs["suffix_dedup"]) == ids(inputs["suffix_dedup"])
    texts = {r["doc_id"]: r["text"] for r in inputs["suffix_dedup"].collect()}
    strings = {}
    for doc_id, text in texts.items():
        data = text.encode()
        for i in range(len(data) - 199):
            strings.setdefault(data[i : i + 200], set()).add((doc_id, i))
    for row in outputs["suffix_dedup"].collect():
        data = texts[row["doc_id"]].encode()
        hit = any(len(strings[data[i : i + 200]]) > 1 for i in range(len(data) - 199))
        assert (row["text"] != texts[row["doc_id"]]) == hit and row["n_chars"] == len(row["text"])
    before, after = (sum(len(r["text"].split()) for r in f["source_mix"].collect()) for f in (inputs, outputs))
    assert after == pytest.approx(before, rel=0.1)
    packed = outputs["packing"].where("piece = 0").count()
    assert packed == outputs["source_mix"].count()
    for frame in outputs.values():
        frame.unpersist()


def test_stages_bear_empty_tables(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "/root/testdata/sf0.001")
        assert frame.count() == 0


def test_run_is_the_chain_of_stages(spark):
    whole = rows_of(corpus_pipeline.run(spark, "/root/testdata/sf0.001").drop("sequence_id", "offset"))
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "/root/testdata/sf0.001")
    assert rows_of(frame.drop("sequence_id", "offset")) == whole


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_with_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    frame = queries.queries()[name](spark, SF)
    result = connection.execute(queries.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.select(*names)) == sorted(result.fetchall(), key=repr)


def test_every_operator_has_one_query():
    numbers = [int(m[1]) for name in queries.queries() if (m := re.match(r"op(\d+)_", name))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in queries.queries()


def test_nothing_else_imports_the_subpackage():
    for path in ROOT.rglob("*.py"):
        inside = {"llm"} & set(path.relative_to(ROOT).parts) or path.name in ("corpus_pipeline.py", "__spark_entry__.py")
        assert inside or "gaugeflow.llm" not in path.read_text()
