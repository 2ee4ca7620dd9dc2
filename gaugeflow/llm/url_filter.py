"""URL filter: path rules first, then a blocked Bloom filter with an exact join.

The filter of listed canonical URLs is a table of 64-bit blocks, packed into
arrays and broadcast up to a measured size. A page's URL looks up one block; if
all its bits are set it is a possible hit, and only possible hits are joined with
the list itself, which removes false positives. Pages are read and parsed once.
All steps are DataFrame functions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import parts, stored

#: The filter is broadcast up to this size, some 27 million listed URLs; beyond, it is joined.
FILTER_BYTES = 64 * 1024 * 1024

#: Fixed values of the contract: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEYS_PER_BLOCK = 4
_PROBES = 4
_ROW_BLOCKS = 64
_ROW_BYTES = 8 * _ROW_BLOCKS + 128


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.coalesce(F.when(start > 0, F.substr(url, start + 3)), F.lit(""))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical_url(host: Column, path: Column) -> Column:
    """Host without credentials, port, ``www.`` and ``m.``; path without last slashes.

    Scheme, query and fragment do not count. Null where there is no host.
    """
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    bare = F.regexp_replace(bare, r"^(www|m)\.", "")
    return F.when(bare != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def _rule(host: Column, path: Column, rules, value) -> Column:
    """``value(rule)`` of the longest fitting rule, else null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule[1]) | host.endswith(f".{rule[1]}")) & path.startswith(rule[2])
        chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
    return chosen


def _block(canonical: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), canonical), F.lit(blocks))


def _bits(canonical: Column) -> Column:
    """Word with the URL's bits of its block."""
    hashed, word = F.xxhash64(F.lit(2), canonical), F.lit(0).cast("long")
    for probe in range(_PROBES):
        place = F.shiftrightunsigned(hashed, 6 * probe).bitwiseAND(F.lit(63)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return word


def _filter(listed: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The blocks of ``rows`` listed URLs, a row of (place, words) for each 64, and their number."""
    blocks = parts(rows, _KEYS_PER_BLOCK)
    block = _block(F.col("canonical"), blocks).alias("block")
    words = listed.groupBy(block).agg(F.bit_or(_bits(F.col("canonical"))).alias("word"))
    inside = F.pmod(F.col("block"), F.lit(_ROW_BLOCKS))
    row = F.collect_list(F.struct(inside, "word"))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(_ROW_BLOCKS - 1).cast("long"))
    packed = words.groupBy(_place(F.col("block")).alias("place")).agg(F.map_from_entries(row).alias("held"))
    filled = F.transform(numbers, lambda i: F.coalesce(F.element_at("held", i), F.lit(0).cast("long")))
    packed = packed.select("place", filled.alias("words"))
    small = parts(blocks, _ROW_BLOCKS) * _ROW_BYTES <= FILTER_BYTES
    return F.broadcast(packed) if small else packed, blocks


def _place(block: Column) -> Column:
    return F.floor(block / F.lit(_ROW_BLOCKS))


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path and canonical of every page."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    parted = pages.select("page_id", host.alias("host"), path.alias("path"))
    return parted.withColumn("canonical", canonical_url(F.col("host"), F.col("path")))


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """Verdict for the URL of every row of ``pages`` (page_id, url).

    ``listed`` has a column canonical (see ``canonical_url``). The longest rule
    that fits decides; else listed URLs are blocked and all others allowed.
    Null URLs and URLs without ``://`` have an empty host and path, fit no rule
    and are allowed. Repeated rows and null ids are judged row by row; other
    columns are ignored. An empty list blocks nothing.
    """
    listed = stored(listed.select("canonical").where("canonical IS NOT NULL").distinct(), "listed")
    bloom, blocks = _filter(listed, listed.count())
    host, path, canonical = F.col("host"), F.col("path"), F.col("canonical")
    judged = with_parts(pages).withColumns(
        {
            "rule": _rule(host, path, rules, lambda r: r[1] + r[2]),
            "verdict": _rule(host, path, rules, lambda r: r[0]),
        }
    )
    # Only URLs with a host and without a rule are looked up; the salt keeps others apart.
    block = F.when(F.col("rule").isNull(), _block(canonical, blocks))
    unlisted = -1 - F.pmod(F.xxhash64("page_id"), F.lit(1 << 20))
    probed = judged.withColumns({"block": block, "place": F.coalesce(_place(block), unlisted)})
    probed = probed.join(bloom, "place", "left")
    word = F.element_at("words", F.pmod(F.col("block"), F.lit(_ROW_BLOCKS)).cast("int") + 1)
    possible = F.coalesce(word.bitwiseAND(_bits(canonical)) == _bits(canonical), F.lit(False))
    shown = ["page_id", "host", "path", "rule"]
    probed = stored(probed.select(*shown, "verdict", F.when(possible, canonical).alias("canonical")), "probed")
    exact = probed.where("canonical IS NOT NULL").join(listed.withColumn("hit", F.lit(True)), "canonical", "left")
    settled = probed.where("canonical IS NULL").select(*shown, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    return settled.union(exact.select(*shown, F.when(F.col("hit"), "block").otherwise("allow").alias("verdict")))


def thin_page_urls(pages: DataFrame, min_chars: int = 1000) -> DataFrame:
    """Canonical URLs of pages whose html is null or under ``min_chars`` characters."""
    thin = pages.where(F.coalesce(F.length("html"), F.lit(0)) < min_chars)
    return with_parts(thin).select("canonical")
