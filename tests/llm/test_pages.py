"""Page text, archives and URL verdicts."""

import base64
import hashlib
import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeflow.llm import url_filter, warc_store
from gaugeflow.llm.frames import scratch_folder
from gaugeflow.llm.html_text import (
    content_marginals,
    extract_text,
    main_text,
    parse_page,
    train_page_model,
)
from gaugeflow.llm.html_training import labelled_pages

from .helpers import PAGES, rows_of, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return train_page_model(labelled_pages())


def test_text_of_given_pages_is_their_article(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in extract_text(rows).collect()}
    for row in rows.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.DOTALL)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", article))
        assert texts[row["page_id"]] == " ".join(html.unescape(plain).split())


def test_unseen_labelled_pages(model):
    wrong = chars = 0
    for source in labelled_pages(150, seed=77):
        elements = parse_page(source).elements
        labels = [1]
        for element in elements[1:]:
            labels.append(labels[element.parent] if element.label is None else element.label)
        for element, odds, label in list(zip(elements, content_marginals(elements, model), labels))[1:]:
            if element.chars and element.tag not in ("title", "label", "button"):
                chars += element.chars
                wrong += element.chars * ((odds > 0) != label)
    assert wrong / chars < 0.02


def test_marginals_are_those_of_all_states(model):
    """Sum-product on a small page against summing over every assignment."""
    import math
    from itertools import product

    source = "<body><div class='menu'>go</div><article><h1>T</h1><p>Some words.</p><aside>x</aside></article></body>"
    elements = parse_page(source).elements
    from gaugeflow.llm.html_text import _ODDS_LIMIT, _OTHER, _signs

    weight = [[0.0, 0.0] for _ in elements]
    for states in product((0, 1), repeat=len(elements)):
        total = _ODDS_LIMIT * states[0]
        for at, element in enumerate(elements[1:], 1):
            tie = model.ties.get(element.tag, model.ties[_OTHER])
            total += math.log(tie[3 - 2 * states[element.parent] - states[at]])
            total += states[at] * sum(model.signs.get(s, 0.0) for s in _signs(element))
        for at, state in enumerate(states):
            weight[at][state] += math.exp(total - _ODDS_LIMIT)
    for odds, (no, yes) in zip(content_marginals(elements, model), weight):
        if no > 0:
            assert odds == pytest.approx(math.log(yes / no), abs=1e-6)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("only words &amp; no\n markup", "only words & no markup"),
        ("<article><p>un<b>closed <i>it</p><p>two < three &lt;x&gt;", "unclosed it two < three <x>"),
        (
            "<body><header><h1>Site</h1><p>Tag line.</p></header><nav><a href=/>Home</a></nav><main><article><h1>Title</h1>"
            "<p>Real words here. More.</p><aside class='sidebar'><p>Side story.</p></aside><form><label>Mail</label></form>"
            "<section class='comments'><h2>Comments</h2><div class='comment'><p>I liked it. Very much.</p></div></section>"
            "</article></main><div id=cookie-notice>We use cookies.</div><footer>c 2020</footer></body>",
            "Title Real words here. More.",
        ),
        ("<script>var a='<p>no</p>';</script><article><p>yes it is</p><!-- no --></article><style>p{}</style>", "yes it is"),
    ],
)
def test_main_text(model, source, text):
    assert main_text(source, model) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</li>", "<b", "<!--", "-->", "&amp;", "&#x0;", "word ", "<td>", "<a href='x>", "</a>", '"', "<script>", "<table>"]), max_size=40))
def test_broken_markup_is_read_to_its_end(model, parts):
    assert isinstance(main_text("".join(parts), model), str)


@pytest.mark.parametrize("bit", ["<a ", "<b>x</i>", "<a '\"", "<b><hr>", "<a b='c\" ", "<", "&am", "<div>", "<!", "<a x ", "</p"])
def test_time_to_parse_grows_with_the_page(bit):
    def seconds(size):
        start = time.process_time()
        parse_page("<p><td>" + bit * (size // len(bit)))
        return time.process_time() - start

    seconds(50_000)
    assert seconds(1_600_000) < 5


def test_pages_of_any_rows(spark):
    deep = "<div>" * 3000 + "<article><p>deep words. here.</p>" + "<p>para words. here.</p>" * 3000
    rows = [(1, None, None), (1, None, None), (None, "u", "<article><p>one two.</p></article>"), (2, "u", deep)]
    found = extract_text(table(spark, rows, PAGES))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = rows_of(found.drop("text"))
    assert got == sorted([(1, None, 0), (1, None, 0), (None, "u", 8), (2, "u", 17 + 3000 * 18)], key=repr)
    assert extract_text(table(spark, [], PAGES)).count() == 0


# Archives


def test_archive_gives_back_every_record(spark):
    rows = [
        (1, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (2, None, "same"), (4, "u", None), (5, "u", ""),
        (6, "http://é/", "é" * 100_000), (7, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "same"), (None, "u", "alone"),
        (8, "u", "twice"), (8, "u", "twice"),
    ]
    pages = table(spark, rows, PAGES)
    found = rows_of(warc_store.archive_round_trip(pages))
    largest = {"same": 3, "": 5, "twice": 8}

    def expected(page_id, payload):
        data = payload.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        best = largest.get(payload, page_id)
        revisit = best != page_id
        return page_id, len(data), digest, "revisit" if revisit else "response", best if revisit else None

    assert found == sorted((expected(i, p or "") for i, _, p in rows), key=repr)
    assert warc_store.archive_round_trip(table(spark, [], PAGES)).count() == 0
    large = rows_of(warc_store.archive_round_trip(pages, min_payload=6))
    assert {r[3] for r in large} == {"response"}


def test_archive_stores_a_payload_once_and_checks_it(spark):
    folder = scratch_folder(spark, "archive")
    pages = table(spark, [(i, f"u{i}", "x" * (i % 3)) for i in range(30)], PAGES)
    warc_store.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    records = warc_store.read_archive(spark, folder).collect()
    assert len(records) == 30 and all(r["header"].startswith("WARC/1.1\r\nWARC-Type: re") for r in records)
    bodies = spark.read.parquet(f"{folder}/payloads").collect()
    wrong = [(bytes(bodies[i]["digest"]), bytes(bodies[i - 1]["body"])) for i in range(3)]
    spark.createDataFrame(wrong, "digest binary, body binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc_store.read_archive(spark, folder).collect()


# URLs


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if c.isascii() else c for c in host), slash + path


URLS = [
    "http://A.Example.ORG/es/1?x=/y", "https://example.org/en/12", "http://example.org/en/2", "http://exampleXorg/es/",
    "http://notexample.org/es/1", "x://shop.com/fr/", "http://com/de/", "http://a.com/de", "http://b.net/1/", None, "no scheme",
    "http://", "http://?q", "http://m.B.net/1#f", "http://user@www.b.net:80/1//", "http://c.net/1", "a://b://c", "://d.net/1", "http://É.net/É",
    "http://org/", "http://xorg/", "http://ünï.com/fr/ü", "http://e.net/" + "z" * 70_000,
]


def slow_verdict(url, listed):
    host, path = slow_parts(url)
    fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if fits:
        best = max(fits, key=lambda r: len(r[1] + r[2]))
        return host, path, best[1] + best[2], best[0]
    return host, path, None, "block" if canonical(url) in listed else "allow"


def canonical(url):
    host, path = slow_parts(url)
    bare = re.sub(r"^(www|m)\.", "", re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", host)))
    return bare + path.rstrip("/") if bare else None


@pytest.mark.parametrize("filter_bytes", [0, 64 << 20])
def test_verdicts_are_those_of_brute_force(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(url_filter, "FILTER_BYTES", filter_bytes)
    many = [f"https://h{i % 700}.net/p{i}" for i in range(3000)]
    rows = [(i, u, None) for i, u in enumerate([*URLS, *URLS, *many])] + [(None, "http://b.net/1", None)]
    bad = ["http://b.net/1", "http://com/de/", None, "http://e.net/" + "z" * 70_000, *many[::3], *many[::6]]
    listed = {canonical(u) for u in bad if u}
    frame = spark.createDataFrame([(canonical(u) if u else None, 1) for u in bad], "canonical string, word int")
    found = rows_of(url_filter.judge_urls(table(spark, rows, PAGES), frame))
    assert found == sorted(((i, *slow_verdict(u, listed)) for i, u, _ in rows), key=repr)
    none = url_filter.judge_urls(table(spark, rows, PAGES), frame.limit(0))
    assert rows_of(none) == sorted(((i, *slow_verdict(u, ())) for i, u, _ in rows), key=repr)
    assert url_filter.judge_urls(table(spark, [], PAGES), frame).count() == 0


def test_filter_runs_without_python_workers(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    written, stored = [], url_filter.stored
    monkeypatch.setattr(url_filter, "stored", lambda frame, name: written.append(frame) or stored(frame, name))
    frames = [url_filter.judge_urls(pages, url_filter.thin_page_urls(pages)), *written]
    plans = [frame._jdf.queryExecution().toString() for frame in frames]
    assert not any(re.search("Python|Pandas|Arrow|MapIn|CartesianProduct|NestedLoop", plan) for plan in plans)
    # The list and the probe read the pages once each; the verdicts read what the probe wrote.
    assert ["pages.parquet" in plan for plan in plans] == [False, True, True]
    probe = plans[2].split("== Physical Plan ==")[1]
    assert probe.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in probe
