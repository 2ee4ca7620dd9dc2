"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key scaled by its quality weight; sorted by
key within its source, the first documents up to the token budget are taken.
Complete epochs of a source come first, the keys choose the fractional rest.

Only (source, size, key) of each document is sorted, and of these only one bin
of keys per source: sums per bin tell in which bin the budget runs out.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.frames import sized_broadcast, stored

#: Fixed values of the contract: weights by source, repeating; most epochs.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
QUALITY_WEIGHTS = {1: 4.0, 0: 1.0}
UNLABELLED_WEIGHT = 2.0

_ROWS_PER_BIN = 4096
_SOURCE_BYTES = 256


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D."""
    gaps = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(gaps, r"[\x20\x09-\x0D]+", "")).cast("long")


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) from ``labels``; of repeated labels the best counts."""
    best = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"))
    weight = F.lit(UNLABELLED_WEIGHT)
    for quality, value in QUALITY_WEIGHTS.items():
        weight = F.when(F.col("q") == quality, value).otherwise(weight)
    return best.select("doc_id", weight.alias("weight"))


def _mark(seed: int) -> Column:
    """Hash that tells rows apart unless they are repeated whole."""
    return F.xxhash64(F.lit(seed), "doc_id", "source", F.xxhash64("text"))


def _keyed(docs: DataFrame, weights: DataFrame | None, seed: int) -> DataFrame:
    """doc_id, source, size, mark and key of every document."""
    uniform = (F.shiftrightunsigned("mark", 11).cast("double") + 0.5) / float(1 << 53)
    light = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), _mark(seed).alias("mark")
    )
    if weights is None:
        light = light.withColumn("weight", F.lit(1.0))
    else:
        light = light.join(weights, "doc_id", "left").fillna(UNLABELLED_WEIGHT, ["weight"])
    return light.select("doc_id", "source", "size", "mark", (-F.log(uniform) / F.col("weight")).alias("key"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets from (source, source_size), one row per source.

    Sources by code point, null last, get ``weights`` in turn and share the sum of
    all sizes. A target stops at ``max_epochs`` times its source's size; what is
    over goes to the others by weight. With sources sorted by where they stop,
    those that stop are a prefix, so prefix sums give the answer at once.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(place) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    most = F.col("source_size") * F.lit(float(max_epochs))
    ranked = sizes.withColumn("share", weight).withColumn("most", most)
    ranked = ranked.withColumn("stop", F.col("most") / F.col("share"))
    before = Window.orderBy("stop").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    ranked = ranked.withColumns(
        {
            "stopped": F.sum("most").over(before),
            "stopped_share": F.sum("share").over(before),
            "total": F.sum("source_size").over(everything).cast("double"),
            "shares": F.sum("share").over(everything),
        }
    )
    left = F.col("shares") - F.col("stopped_share")
    ranked = ranked.withColumn("capped", F.col("stopped") + F.col("stop") * left <= F.col("total"))
    of_capped = lambda c: F.coalesce(F.sum(F.when(F.col("capped"), F.col(c))).over(everything), F.lit(0.0))
    level = F.try_divide(
        F.col("total") - of_capped("most"), F.col("shares") - of_capped("share")
    )
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.least(level * F.col("share"), "most"))
    return ranked.select("source", "source_size", target.alias("target"))


def _bin(bins: Column) -> Column:
    """Bin of a key: keys grow with it, and a source's keys spread over its bins."""
    place = F.floor((1 - F.exp(-F.col("key") * UNLABELLED_WEIGHT)) * bins)
    return F.least(place, bins - 1).cast("long")


def _thresholds(keyed: DataFrame, weights, max_epochs: int) -> DataFrame:
    """One row per source: sizes, epochs, and the last (key, mark) of the rest."""
    sources = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("docs")
    )
    sources = stored(sources, "sources")
    targets = source_targets(sources.select("source", "source_size"), weights, max_epochs)
    epochs = F.floor(F.try_divide("target", "source_size") + 1e-9)
    epochs = F.coalesce(F.least(epochs, F.lit(max_epochs)), F.lit(0)).cast("long")
    named = targets.withColumn("epochs", epochs).withColumnRenamed("source", "s")
    plan = sources.select("source", F.ceil(F.col("docs") / _ROWS_PER_BIN).alias("bins")).join(
        named, F.col("source").eqNullSafe(F.col("s"))
    )
    rest = F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))
    plan = stored(
        plan.select("source", "bins", "source_size", "target", "epochs", rest.alias("rest")), "plan"
    )
    count = plan.count()

    small = sized_broadcast(plan.select(F.col("source").alias("s"), "bins", "rest"), count, _SOURCE_BYTES)
    binned = keyed.join(small, F.col("source").eqNullSafe(F.col("s"))).withColumn("bin", _bin(F.col("bins")))
    sums = binned.groupBy("source", "bin", "rest").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bin")
    sums = sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    last = sums.where("before < rest AND before + words >= rest")
    last = last.select(F.col("source").alias("ls"), F.col("bin").alias("lb"), "before")
    last = sized_broadcast(last, count, _SOURCE_BYTES)
    inside = binned.join(last, F.col("source").eqNullSafe(F.col("ls")) & (F.col("bin") == F.col("lb")))
    order = Window.partitionBy("source").orderBy("key", "mark")
    inside = inside.withColumn(
        "upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    )
    # A document over the edge is taken if that ends nearer to the budget.
    taken = inside.where("upto - size / 2.0 <= rest AND size > 0 AND rest > 0")
    edge = taken.groupBy("source").agg(F.max(F.struct("key", "mark")).alias("edge"))
    # With nothing taken in the last bin, all of the bins before it are.
    first = inside.groupBy("source").agg(F.min(F.struct("key", "mark")).alias("open"))
    edge = edge.join(first.withColumnRenamed("source", "f"), F.col("source").eqNullSafe(F.col("f")), "right")
    edge = edge.select(F.col("f").alias("es"), "edge", "open")
    joined = plan.join(edge, F.col("source").eqNullSafe(F.col("es")), "left")
    return stored(joined.select("source", "source_size", "target", "epochs", "edge", "open"), "edges")


def mix_sources(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 5,
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row of ``docs``.

    ``docs`` has doc_id, source and text; ``quality`` may give (doc_id, weight),
    weights above zero. ``taken`` is the words the mix takes of the row: a
    multiple of its size, at most ``max_epochs`` times. A null text has size 0;
    a null source is a source of its own; null ids are ordinary rows. Rows
    repeated whole have one key and are taken or left together. The result is
    the same on every run.
    """
    keyed = stored(_keyed(docs, quality, seed), "keyed")
    plan = _thresholds(keyed, weights, max_epochs)
    plan = sized_broadcast(plan.withColumnRenamed("source", "s"), plan.count(), _SOURCE_BYTES)
    place = F.struct("key", "mark")
    chosen = F.when(F.col("edge").isNotNull(), place <= F.col("edge")).otherwise(
        F.coalesce(place < F.col("open"), F.lit(False))
    )
    mixed = keyed.join(plan, F.col("source").eqNullSafe(F.col("s")))
    taken = F.col("size") * (F.col("epochs") + chosen.cast("long"))
    return mixed.select("doc_id", "source", "mark", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """``docs`` itself after the mix: each row as often as it is taken, others gone.

    Rows without a word are never taken. Columns may have any names.
    """
    seed = options.get("seed", 5)
    copies = mix_sources(docs, quality, **options).where("taken > 0")
    times = F.try_divide("taken", "size").cast("int")
    copies = copies.select(F.col("mark").alias("of"), times.alias("times")).distinct()
    rows = docs.select(_mark(seed).alias("mark"), F.struct("*").alias("doc"))
    joined = rows.join(copies, F.col("mark") == F.col("of"))
    return joined.select("doc", F.explode(F.sequence(F.lit(1), "times")).alias("copy")).select("doc.*")
