"""Alignment of two tokenizers against comparing all pairs of tokens."""

import hashlib
from collections import Counter, defaultdict

import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gaugeflow.llm import queries, token_alignment
from gaugeflow.llm.token_alignment import align_tokens, alignment_counts, overlaps
from gaugeflow.llm.tokens import ByteBpe

from .helpers import docs, rows_of

SF = "/root/testdata/sf0.01"
LETTERS = {}
_next = 256
for _b in range(256):  # the byte-level alphabet: visible bytes stand for themselves
    if 33 <= _b <= 126 or 161 <= _b <= 172 or _b >= 174:
        LETTERS[chr(_b)] = _b
    else:
        LETTERS[chr(_next)] = _b
        _next += 1


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def tokens(text):
        found = a.encode(" " + text, add_special_tokens=False)
        one = [(i, bytes(LETTERS[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        other = []
        for i, piece in zip(b.encode(text), b.encode(text, out_type=str)):
            is_byte = len(piece) == 6 and piece.startswith("<0x")
            other.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
        data = (" " + text).encode()
        same = b"".join(t for _, t in one) == data == b"".join(t for _, t in other)
        return (one, other) if text and same else ([], [])

    return tokens


def slow(rows, tokens):
    found, counts = [], Counter()
    for doc_id, text in rows:
        sides = []
        for side in tokens(text or ""):
            at, spans = 0, []
            for i, piece in side:
                spans.append((i, at, at + len(piece)))
                at += len(piece)
            sides.append(spans)
        a, b = sides
        ends_b = {end: i for i, _, end in b}
        links = [(i, ends_b[end]) for i, _, end in a if end in ends_b]
        counts.update(links)
        groups, start = [], 0
        for end in sorted({e for *_, e in a} & set(ends_b)):
            inside = [",".join(str(i) for i, s, e in side if s >= start and e <= end) for side in sides]
            groups.append("|".join(inside))
            start = end
        shared, j = 0, 0
        for _, s, e in a:  # both sides cover the text, in order
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                shared, k = shared + 1, k + 1
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((doc_id, len(a), len(b), len(groups), links, digest, shared))
    most = defaultdict(int)
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    return sorted(
        (
            (d, a, b, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), h, n)
            for d, a, b, g, links, h, n in found
        ),
        key=repr,
    )


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def counted(frame):
    from pyspark.sql import functions as F

    aligned = align_tokens(frame).cache()
    digest = F.when(F.col("n_links") > 0, F.sha2("groups", 256)).otherwise("")
    return rows_of(alignment_counts(aligned.withColumn("groups_sha256", digest)).select(*NAMES))


ODD = [
    (1, None), (2, ""), (3, " "), (4, "plain words, and more"), (4, "plain words, and more"), (5, "a▁b"), (6, "<|endoftext|><s></s><0x0A><unk>"),
    (7, "été 𝄞 \x00\x01 naïve 　x"), (None, "no id here"), (8, "\n\n\t x  y   z "), (9, "word " * 20_000), (10, "日本語のテキスト"), (11, "ﬁ Å é"),
]


def test_odd_texts(spark, sides, monkeypatch):
    frame = docs(spark, [(i, t, "en", "s", 1) for i, t in ODD])
    expected = slow(ODD, sides)
    assert {r[1] for r in expected} > {0}
    assert counted(frame) == expected
    monkeypatch.setattr(token_alignment, "_PAIR_BYTES", 1 << 40)  # joined by a shuffle instead
    assert counted(frame) == expected
    assert counted(frame.limit(0)) == []


def test_query_is_brute_force(spark, sides):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = rows_of(queries.queries()["op13_token_alignment"](spark, "/root/testdata/sf0.001").select(*NAMES))
    assert found == slow(rows, sides)


def test_groups_are_written_in_order(spark, sides):
    (row,) = align_tokens(docs(spark, [(1, "the unbelievable étude", "en", "s", 1)])).collect()
    one, other = sides("the unbelievable étude")
    groups = [[[int(i) for i in side.split(",")] for side in g.split("|")] for g in row["groups"].split(";")]
    assert [i for a, _ in groups for i in a] == [i for i, _ in one]
    assert [i for _, b in groups for i in b] == [i for i, _ in other]
    piece_a, piece_b = dict(one), dict(other)
    for a, b in groups:
        assert b"".join(piece_a[i] for i in a) == b"".join(piece_b[i] for i in b)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.integers(1, 4), min_size=1, max_size=8)] * 2), min_size=1, max_size=4))
def test_overlaps_are_all_pairs_that_share_a_byte(cuts):
    tables, expected, base, number = ([], []), [], 0, [0, 0]
    for doc, pair in enumerate(cuts):
        size, spans = max(map(sum, pair)), []
        for side, lengths in enumerate(pair):
            lengths = [*lengths, size - sum(lengths)] if size > sum(lengths) else lengths
            at, mine = base, []
            for length in lengths:
                mine.append((number[side], at, at + length))
                tables[side].append((doc, at, number[side], at, at + length))
                number[side] += 1
                at += length
            spans.append(mine)
        base += size
        expected += [(i, j, ae, be) for i, a, ae in spans[0] for j, b, be in spans[1] if a < be and b < ae]
    a, b = (pd.DataFrame(t, columns=["doc", "at", n, f"{n}_at", f"{n}_end"]) for t, n in zip(tables, "ab"))
    assert sorted(map(tuple, overlaps(a, b).to_numpy().tolist())) == sorted(expected)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "x" + " \n\t" * 700_000 + "y <|endoftext|> z"])
def test_any_run_of_signs_is_encoded_as_tokenizers_does(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    slow_one, fast = Tokenizer.from_file(path), ByteBpe(path)
    assert fast.encode(text, special=True) == slow_one.encode(text, add_special_tokens=False).ids
    slow_one.encode_special_tokens = True
    assert fast.encode(text) == slow_one.encode(text, add_special_tokens=False).ids
