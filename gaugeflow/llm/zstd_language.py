"""Language of a text by compression.

A text is encoded with one raw-content zstandard dictionary per language; the
language whose dictionary gives the fewest bytes wins. How much the second best
loses is the margin, and a narrow margin is a rejection.
"""

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from gaugeflow.llm.frames import slices

UNKNOWN = "und"
#: Bounds of the labelled sample that the dictionaries are made from.
SAMPLE_PER_LANGUAGE = 600
SAMPLE_CHARS = 2000
DICTIONARY_BYTES = 65_536  # of each, from the start of the drawn texts in the order of their hashes
#: Texts are encoded in pieces, so that the dictionary counts for all of a long text.
PIECE_BYTES = 1024
MIN_MARGIN = 0.002


@dataclass(frozen=True)
class LanguageModel:
    dictionaries: dict[str, bytes]


class _Coder:
    """Compressors of one Python process."""

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        params = z.ZstdCompressionParameters(
            compression_level=3, min_match=3, strategy=z.STRATEGY_BTOPT, window_log=17
        )
        self.coders = {}
        for language in sorted(dictionaries):
            content = z.ZstdCompressionDict(dictionaries[language], dict_type=z.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=params)
            self.coders[language] = z.ZstdCompressor(compression_params=params, dict_data=content)

    def guess(self, text: str | None) -> tuple[str, float]:
        """Language and margin; ``und`` without a letter, ties to the first name."""
        if not text or not self.coders or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        data = text.lower().encode("utf-8", "replace")
        pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        sizes = {name: sum(len(c.compress(p)) for p in pieces) for name, c in self.coders.items()}
        best, *others = sorted(sizes, key=sizes.get)
        return best, 1.0 - sizes[best] / sizes[others[0]] if others else 1.0


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; false for a null id."""
    mark = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(mark == 2, F.lit(False))


def _dictionary(texts: list[str]) -> bytes:
    return "\n".join(texts).lower().encode("utf-8", "replace")[:DICTIONARY_BYTES]


def learn_languages(docs: DataFrame, seed: int = 3) -> LanguageModel:
    """Dictionaries from a bounded sample of labelled rows that are not held out.

    About ``SAMPLE_PER_LANGUAGE`` rows of each language are drawn by hash, of each
    the first ``SAMPLE_CHARS`` characters. Labels may be wrong: either half of the
    sample is classified by the other, and rows that disagree are left out.
    Null languages and rows without text or id teach nothing.
    """
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    labelled = labelled.where(~is_held_out(F.col("doc_id")) & (F.length("text") > 0))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30))
    drawn = F.lit(False)
    for lang, count in counts.items():
        most = int((1 << 30) * min(1.0, SAMPLE_PER_LANGUAGE / count))
        drawn |= (F.col("lang") == lang) & (place < most)
    sample = labelled.where(drawn).select("lang", place.alias("place"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    halves: dict[str, tuple[list, list]] = {lang: ([], []) for lang in counts}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["place"], r["text"])):
        halves[row["lang"]][row["place"] % 2].append(row["text"])
    agreed: dict[str, list[str]] = {lang: [] for lang in counts}
    for side in (0, 1):
        other = _Coder({lang: d for lang, h in halves.items() if (d := _dictionary(h[1 - side]))})
        for lang, texts in halves.items():
            agreed[lang] += [t for t in texts[side] if other.guess(t)[0] in (lang, UNKNOWN)]
    made = {lang: _dictionary(agreed[lang] or [*h[0], *h[1]]) for lang, h in halves.items()}
    return LanguageModel({lang: content for lang, content in made.items() if content})


_ADDED = [
    StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())
]


def _predictor(model: LanguageModel, min_margin: float, kept: list[str]):
    def run(batches):
        coder = _Coder(model.dictionaries)
        for batch in slices(batches):
            guesses = [coder.guess(t) for t in batch.column("text").to_pylist()]
            names, margins = zip(*guesses) if guesses else ((), ())
            rejected = [n == UNKNOWN or m < min_margin for n, m in guesses]
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(names, pa.string()), pa.array(margins, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score", "rejected"])

    return run


def predict_languages(
    docs: DataFrame, model: LanguageModel, min_margin: float = MIN_MARGIN, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, lang_pred, score and rejected of every row of ``docs``.

    Only the whole text decides. A null text or one without a letter is ``und``
    with score 0; otherwise lang_pred is the language with the fewest bytes (ties
    by name) and score the share of bytes it saves over the second best (1 if only
    one language is known). ``rejected`` marks ``und`` and scores under
    ``min_margin``. Rows are judged one by one, repeated ones and null ids too.
    ``keep`` must not name lang_pred, score or rejected.
    """
    if taken := set(keep) & {f.name for f in _ADDED}:
        raise ValueError(f"columns with names of results: {sorted(taken)}")
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    kept = [f for f in rows.schema if f.name in keep]
    run = _predictor(model, min_margin, [f.name for f in kept])
    return rows.mapInArrow(run, StructType([*kept, *_ADDED]))
