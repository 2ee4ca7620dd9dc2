"""A keyed wide table with the families ``data``, ``alert`` and ``stats``.

Parquet has no upsert. Each family is a folder to which every batch adds its
own ``run=<r>/batch=<b>`` folder of versioned rows, kept apart by day; reading
keeps the newest version per row key. Writing never reads or shuffles what is
there, a retried batch replaces only itself, and a replayed topic repeats
versions that are already there, so both leave the same table.

The day is a function of the row key and of its day key, so neither the newest
version nor daily statistics cross days. A day that only one compacted base
holds is settled: its rows are current and are read without a shuffle. Which
days those are comes from the names of the folders, whatever their size.

Beside the families the table keeps small tables of its own: the key range of each
compacted file, so that a limited scan reads few of them; which batches the last
statistics have seen, and which days of a base hold batches they have not; and
claims, empty files created only if absent, for numbers that must not be taken twice.
"""

import re
from collections import Counter
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

from gaugeflow.functions.keys import day_folder, row_key
from gaugeflow.operators.alerts import low_pressure
from gaugeflow.operators.latest import newest, newest_over_base
from gaugeflow.operators.stats import stats_cells
from gaugeflow.schemas import MEASURES, STATS_CELLS
from gaugeflow.session import many_folders_listed, many_folders_written, sized_shuffle
from gaugeflow.sources import storage

# The column families and their cells.
FAMILIES = {"data": MEASURES, "alert": ("psi",), "stats": STATS_CELLS}

# Compacted rows sort before those of any run, whose name starts with a letter.
_BASE_RUN = "0base"
_RUN_NAME = re.compile(r"[a-z][a-z0-9_-]*")
STATS_RUN = "stats"

# A version has a fixed width, so that the newest one is found by hashing. By
# arrival it holds the run's place among all runs, the batch and the offset.
_VERSION = DecimalType(38, 0)
_RUNS = "_runs"
_CLAIMS = "_claims"
_RANGES = "_ranges"
_SEEN = "_seen"
_UNSEEN = "_unseen"
_NOBODY = "-"
_OFFSETS = 10**19
_BATCHES = 10**9

# A limited scan looks at this many key ranges and file names on the driver; beyond
# that, files are told apart by the statistics in them instead.
_RANGE_ROWS = 10_000
# Row keys of a tail are broadcast up to this size in memory, versions included.
_TAIL_BYTES = 64 * 1024 * 1024
_TAIL_ROW_BYTES = 64
_RANGE = "day string, file string, least string, largest string, rows long"
_BATCH = "run string, batch long, finished long"


@dataclass(frozen=True)
class WideTable:
    """The families below ``root``.

    A version is the topic offset of its record, which orders the readings of
    a row key because they share a topic partition. A table fed from several
    topics has no such order and sets ``by_arrival``: runs first seen later,
    then later batches and offsets win, and the version holds all three. The
    table remembers its mode and cannot be opened in the other one.
    """

    spark: SparkSession
    root: str
    by_arrival: bool = False

    def folder(self, family: str) -> str:
        return f"{self.root}/{family}"

    def _schema(self, family: str) -> StructType:
        return StructType(
            [StructField("rowkey", StringType())]
            + [StructField(cell, DoubleType()) for cell in FAMILIES[family]]
            + [StructField("version", _VERSION)]
        )

    def __post_init__(self) -> None:
        modes = [n for n in storage.folders(self.spark, self.root) if n.startswith("_mode-")]
        if modes and modes != [self._mode()]:
            raise ValueError(f"{self.root} was made with {modes[0].removeprefix('_mode-')}")

    def _mode(self) -> str:
        return "_mode-by_arrival" if self.by_arrival else "_mode-by_offset"

    def create(self) -> None:
        """Make the families' folders; a table that is there stays as it is."""
        for name in (*FAMILIES, _RUNS, self._mode()):
            storage.make(self.spark, self.folder(name))

    def truncate(self) -> None:
        """Empty every family and forget the runs."""
        for name in (*FAMILIES, _RUNS, _CLAIMS, _RANGES, _SEEN, _UNSEEN):
            storage.delete(self.spark, self.folder(name))
        self.create()

    def _claim(self, kind: str, first: int = 0) -> int:
        return storage.claim(self.spark, f"{self.root}/{_CLAIMS}/{kind}", first)

    def _known_runs(self) -> list[tuple[int, str, str]]:
        """(place, run, owner) of the table's runs in their order."""
        names = [n.split(".") for n in storage.folders(self.spark, self.folder(_RUNS))]
        return sorted((int(place), run, owner) for place, run, owner in names)

    def _place_of_run(self, run: str, owner: str | None) -> int:
        """The run's place among the table's runs, given when it is first seen.

        ``owner`` is bound to the run then; another owner would overwrite the
        batches of the first, so it is refused. A place is claimed before it is
        used. If two owners bring the same new run at once, the lower place has it.
        """
        owner, mine = owner or _NOBODY, None
        known = self._known_runs()
        if all(name != run for _, name, _ in known):
            place = self._claim("run", 1 + max((place for place, *_ in known), default=-1))
            mine = f"{self.folder(_RUNS)}/{place:010d}.{run}.{owner}"
            storage.make(self.spark, mine)
            known = sorted({*self._known_runs(), (place, run, owner)})
        first, _, holder = next(entry for entry in known if entry[1] == run)
        if mine and first != place:
            storage.delete(self.spark, mine)
        if holder != owner:
            raise ValueError(f"run {run!r} belongs to another checkpoint")
        return first

    # Writing

    def _put(
        self, rows: DataFrame, family: str, run: str, batch: int, placed: bool = False
    ) -> str:
        """Write one batch by day.

        Rows that are not ``placed`` already, by a ``day`` column, are brought together
        by day, a busy day in several tasks and small ones in one, so that a batch
        writes a few files a day and not one for each day in each task. Many days of
        a few rows each still take several tasks.
        """
        columns = ("rowkey", *FAMILIES[family], "version")
        if placed:
            rows = rows.select(*columns, "day")
        else:
            rows = rows.select(*columns, day_folder().alias("day")).hint("rebalance", "day")
        with many_folders_written(rows.sparkSession):
            return storage.write_batch(rows, self.folder(family), run, batch, "day")

    def put_readings(
        self, sensor: DataFrame, run: str, batch: int, owner: str | None = None
    ) -> None:
        """Upsert readings into ``data``, then their alerts into ``alert``.

        ``run`` names one pass over the topic, ``batch`` a micro-batch in it,
        ``owner`` the checkpoint that the run is bound to on first use.
        Alerts are read back from the data just written: three columns with
        the threshold pushed to the files, no second parse and no cache. They
        are every alerting version, so a later reading that is no alert leaves
        the alert cell standing.
        """
        if not _RUN_NAME.fullmatch(run):
            raise ValueError(f"not a run name: {run!r}")
        place = self._place_of_run(run, owner)
        version = F.col("offset").cast(_VERSION)
        if self.by_arrival:
            arrived = Decimal((place * _BATCHES + batch) * _OFFSETS)
            version = (F.lit(arrived).cast(_VERSION) + F.col("offset")).cast(_VERSION)
        rows = sensor.withColumn("rowkey", row_key()).withColumn("version", version)
        written = self._put(rows, "data", run, batch)
        stored = self._stored(sensor.sparkSession, "data", written)
        self._put(low_pressure(stored).select("rowkey", "psi", "version"), "alert", run, batch)

    def put_stats(self, stats: DataFrame, version: int | None = None) -> int:
        """Upsert statistics by day key as a new version and return its number.

        Days that the statistics do not mention keep their older rows.
        """
        if version is None:
            version = self._claim("stats", self._next_stats_version())
        rows = stats_cells(stats).withColumn("version", F.lit(version).cast(_VERSION))
        self._put(rows, "stats", STATS_RUN, version)
        return version

    def _next_stats_version(self) -> int:
        """One past the last claim; of a table without claims, past the last row."""
        if claims := storage.claimed(self.spark, f"{self.root}/{_CLAIMS}/stats"):
            return claims[-1] + 1
        (last,) = self.versions("stats").agg(F.max("version")).first()
        return 0 if last is None else int(last) + 1

    # What the statistics have seen

    def finished_batches(self) -> dict[tuple[str, int], int]:
        """When each batch of ``data`` was finished; a retried batch finishes again."""
        marks = storage.finished(self.spark, self.folder("data"), "run", "batch")
        return {(run, int(batch)): when for (run, batch), when in marks.items()}

    def seen_batches(self) -> tuple[int, dict[tuple[str, int], int]] | None:
        """Version of the last statistics and the batches they saw."""
        marks = storage.finished(self.spark, self.folder(_SEEN), "version")
        if not marks:
            return None
        version = max(int(v) for (v,) in marks)
        rows = self.spark.read.schema(_BATCH).parquet(f"{self.folder(_SEEN)}/version={version}")
        return version, {(r["run"], r["batch"]): r["finished"] for r in rows.collect()}

    def note_seen(self, version: int, batches: dict[tuple[str, int], int]) -> None:
        """Say that statistics ``version`` hold what was in ``batches``."""
        rows = [(run, batch, when) for (run, batch), when in sorted(batches.items())]
        frame = self.spark.createDataFrame(rows, _BATCH).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.folder(_SEEN)}/version={version}")

    def _unseen_days(
        self,
        batches: dict[tuple[str, int], set[str]],
        finished: dict[tuple[str, int], int],
        seen: dict[tuple[str, int], int],
    ) -> set[str]:
        """Days of ``batches`` with rows that are not in ``seen``.

        A base's rows came from batches; which of its days hold unseen ones was noted
        when it was made.
        """
        days = set()
        noted = storage.finished(self.spark, self.folder(_UNSEEN), "base")
        for (run, batch), held in batches.items():
            when = finished.get((run, batch))
            if when is not None and seen.get((run, batch)) == when:
                continue
            if run == _BASE_RUN and (str(batch),) in noted:
                note = self.spark.read.schema("day string").parquet(f"{self.folder(_UNSEEN)}/base={batch}")
                held = held & {r["day"] for r in note.collect()}
            days |= held
        return days

    def changed_days(self, finished: dict[tuple[str, int], int]) -> set[str] | None:
        """Day folders of ``data`` that the last statistics do not hold; None for all.

        ``finished`` is a listing made before; batches that are newer than it or not
        finished count as changed now and again later.
        """
        last = self.seen_batches()
        if last is None:
            return None
        return self._unseen_days(self._batches("data"), finished, last[1])

    # Reading

    def _stored(self, spark: SparkSession, family: str, *folders: str) -> DataFrame:
        """Versions in the given folders with their run, batch and day."""
        names = [*storage.RUN_AND_BATCH, StructField("day", StringType())]
        schema = StructType(self._schema(family).fields + names)
        reader = spark.read.schema(schema).option("basePath", self.folder(family))
        with many_folders_listed(spark):
            return reader.parquet(*folders)

    def versions(self, family: str) -> DataFrame:
        """Every stored version of a family's rows."""
        return self._stored(self.spark, family, self.folder(family))

    def batch_rows(self, family: str, run: str, batch: int) -> DataFrame:
        """The versions that one batch wrote."""
        folder = storage.batch_folder(self.folder(family), run, batch)
        return self._stored(self.spark, family, folder)

    def _batches(self, family: str) -> dict[tuple[str, int], set[str]]:
        """The days in each batch folder, by run and batch."""
        root = self.folder(family)
        found = {
            (run, int(batch)): set()
            for run, batch in storage.partitions(self.spark, root, "run", "batch")
        }
        for run, batch, day in storage.partitions(self.spark, root, "run", "batch", "day"):
            found.setdefault((run, int(batch)), set()).add(day)
        return found

    def folders(self, family: str, days: set[str] | None = None) -> list[str]:
        """The family's folder, or those that hold the given days.

        A batch that holds no other days is one folder.
        """
        if days is None:
            return [self.folder(family)]
        found = []
        for name, here in self._batches(family).items():
            if here and here <= days:
                found.append(self._folder_of(family, *name))
            else:
                found += [self._folder_of(family, *name, day) for day in sorted(here & days)]
        return found

    def family(self, family: str, days: set[str] | None = None) -> DataFrame:
        """The family's current rows: the newest version per row key.

        ``days`` names day folders; others are not read then. Only contested days
        are compared, those held by a batch that is not compacted or by two bases (a
        compaction was lost halfway). Settled days have one row per key already and
        are read without a shuffle. A contested day with one base shuffles only the
        later batches' rows while their keys are few enough to broadcast.
        """
        # First the files, then the names: a batch that arrives in between
        # makes its days contested, and its rows come with the next read.
        cells = FAMILIES[family]
        if days is None:
            versions = self.versions(family)
        elif here := self.folders(family, days):
            # Of a batch read as one folder, a retry may have brought other days.
            versions = _on(self._stored(self.spark, family, *here), days)
        else:
            return self.versions(family).select("rowkey", *cells).limit(0)
        batches = self._batches(family)
        settled, contested = _settled_and_contested(batches)
        over_base = _held_by_one_base(batches) & contested
        if days is not None:
            settled, contested, over_base = settled & days, contested & days, over_base & days
        if not settled and not over_base:
            return newest(versions, cells, "version")
        if not contested:
            return versions.select("rowkey", *cells)
        disputed = F.col("day").isin(sorted(contested))
        parts = [versions.where(~disputed).select("rowkey", *cells)] if settled else []
        if over_base:
            held = _on(versions, over_base)
            base, tail = (held.where(F.col("run") == _BASE_RUN), held.where(F.col("run") != _BASE_RUN))
            if _key_bytes(tail) <= _TAIL_BYTES:
                parts.append(newest_over_base(base, tail, cells, "version"))
                contested = contested - over_base
        if contested:
            parts.append(newest(_on(versions, contested), cells, "version"))
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return found

    def row_count(self) -> DataFrame:
        """Number of rows that have ``data`` cells."""
        return self.family("data").agg(F.count(F.lit(1)).alias("rows"))

    def scan_family(self, family: str, limit: int | None = None) -> DataFrame:
        """A family's current rows in row-key order, all or the first ``limit``.

        A limited scan reads the compacted files that can hold such rows and, of the
        days that batches came to since, the rows up to the last key it can need.
        """
        if limit is None:
            return self.family(family).orderBy("rowkey")
        return self._first_rows(family, limit).orderBy("rowkey").limit(limit)

    def _ranges(self, family: str, settled: dict[str, int]) -> tuple[DataFrame | None, set[str]]:
        """Key ranges of the files of settled days (day to base), and days without any."""
        root = f"{self.folder(_RANGES)}/{family}"
        made = {int(base) for (base,) in storage.finished(self.spark, root, "base")}
        known = [(day, base) for day, base in sorted(settled.items()) if base in made]
        if not known:
            return None, set(settled)
        folders = [f"{root}/base={base}" for base in sorted({base for _, base in known})]
        ranges = self.spark.read.schema(_RANGE + ", base long").option("basePath", root).parquet(*folders)
        days = self.spark.createDataFrame(known, "day string, base long")
        return ranges.join(days, ["day", "base"], "left_semi"), set(settled) - {day for day, _ in known}

    def _first_rows(self, family: str, limit: int) -> DataFrame:
        """Current rows among which the first ``limit`` are."""
        batches, cells = self._batches(family), FAMILIES[family]
        settled, contested = _settled_and_contested(batches)
        bases = {day: b for (run, b), days in batches.items() if run == _BASE_RUN for day in days & settled}
        ranges, others = self._ranges(family, bases)
        if ranges is None or not 0 < limit <= _RANGE_ROWS:
            return self.family(family)
        # Two keys up to which there are ``limit`` rows: the largest of the first files
        # that hold as many, and the first key of as many files, each of which has it.
        # The days' files overlap, since a day holds all sensors; the second is the
        # tighter one then.
        rows, bounds = 0, []
        for file in ranges.orderBy("largest", "base", "file").limit(limit).collect():
            rows += file["rows"]
            if rows >= limit:
                bounds.append(file["largest"])
                break
        starts = ranges.select("least").orderBy("least").limit(limit).collect()
        bounds += [starts[-1]["least"]] if len(starts) == limit else []
        last = min(bounds, default=None)
        up_to = F.lit(True) if last is None else F.col("rowkey") <= last
        near = ranges if last is None else ranges.where(F.col("least") <= last)
        files = near.select("base", "day", "file").limit(_RANGE_ROWS + 1).collect()
        if len(files) > _RANGE_ROWS:
            return self.family(family).where(up_to)
        folder = self._folder_of
        paths = [f"{folder(family, _BASE_RUN, base, day)}/{file}" for base, day, file in sorted(files)]
        paths += [folder(family, _BASE_RUN, bases[day], day) for day in sorted(others)]
        parts = [self._stored(self.spark, family, *paths).where(up_to).select("rowkey", *cells)] if paths else []
        disputed = [folder(family, *name, day) for name, days in batches.items() for day in sorted(days & contested)]
        if disputed:
            versions = self._stored(self.spark, family, *disputed).where(up_to)
            parts.append(newest(versions, cells, "version"))
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return found

    def scan_wide(self, limit: int | None = None) -> DataFrame:
        """Whole rows in row-key order, cells prefixed with their family.

        A key among the first ``limit`` of the table is among the first
        ``limit`` of each family that has it, so a limited scan joins only those.
        """
        data, alert, stats = (
            (self.family(family) if limit is None else self.scan_family(family, limit)).select(
                "rowkey", *[F.col(c).alias(f"{family}_{c}") for c in FAMILIES[family]]
            )
            for family in FAMILIES
        )
        # A statistics key has no space and so never meets a reading's key: rows
        # to add, not to join.
        rows = data.join(alert, "rowkey", "full_outer")
        wide = rows.unionByName(stats, allowMissingColumns=True).orderBy("rowkey")
        return wide if limit is None else wide.limit(limit)

    # Maintenance

    def compact(self, family: str, idle: bool = False) -> int:
        """Merge a family's batch folders into the base and return how many.

        Only days that the merged folders hold are read and written again; the
        other days' files stay as they are. A base holds the newest versions
        sorted by row key, and the key range of each of its files is noted for
        limited scans. Its number is claimed, so that two compactions at once write
        two bases, whose days are then compared again. It is
        written before what it replaces is deleted; a job lost in between
        leaves equal versions twice, which reading merges. Each run's newest
        batch stays, because a stream may be working on it, unless the table
        is ``idle``. Readers that planned before the delete must run again.
        """
        batches = self._batches(family)
        newest_batch = {}
        for run, batch in batches:
            newest_batch[run] = max(batch, newest_batch.get(run, -1))
        bases = {b: days for (run, b), days in batches.items() if run == _BASE_RUN}
        tail = {
            (run, batch): days
            for (run, batch), days in batches.items()
            if run != _BASE_RUN and (idle or batch != newest_batch[run])
        }
        held = Counter(day for days in bases.values() for day in days)
        twice = {day for day, count in held.items() if count > 1}
        touched = twice.union(*tail.values())
        replaced = {batch: days & touched for batch, days in bases.items() if days & touched}
        merged = [self._folder_of(family, *name) for name in tail]
        parts = [
            self._folder_of(family, _BASE_RUN, batch, day)
            for batch, days in replaced.items()
            for day in sorted(days)
        ]
        if touched:
            read = [folder for folder, days in zip(merged, tail.values()) if days] + parts
            # The aggregate comes first: it merges a hot key's versions before
            # the range shuffle, in which a busy day takes several tasks.
            with sized_shuffle(self.spark, *read):
                last = newest(
                    self._stored(self.spark, family, *read),
                    (*FAMILIES[family], "version"),
                    "version",
                )
                base = _in_order(last)
                number = self._claim(f"base-{family}", max(bases, default=-1) + 1)
                if family == "data":
                    self._note_unseen(number, {n: d for n, d in batches.items() if n in tail}, {
                        (_BASE_RUN, batch): days for batch, days in replaced.items()
                    })
                self._put(base, family, _BASE_RUN, number, placed=True)
            self._note_ranges(family, number)
        emptied = [
            self._folder_of(family, _BASE_RUN, batch)
            for batch, days in bases.items()
            if days <= touched
        ]
        for folder in merged + parts + emptied:
            storage.delete(self.spark, folder)
        return len(merged) + len(replaced)

    def _note_unseen(self, base: int, *merged: dict[tuple[str, int], set[str]]) -> None:
        """Note which days of a new base hold batches that no statistics have seen.

        Written before the base; without statistics there is nothing to note, since
        the first ones read all days.
        """
        last = self.seen_batches()
        if last is None:
            return
        finished = self.finished_batches()
        days = set().union(*(self._unseen_days(batches, finished, last[1]) for batches in merged))
        frame = self.spark.createDataFrame([(day,) for day in sorted(days)], "day string").coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.folder(_UNSEEN)}/base={base}")

    def _note_ranges(self, family: str, base: int) -> None:
        """Write the first and last key and the number of rows of a base's files."""
        rows = self._stored(self.spark, family, self._folder_of(family, _BASE_RUN, base))
        ranges = rows.groupBy("day", F.col("_metadata.file_name").alias("file")).agg(
            F.min("rowkey").alias("least"), F.max("rowkey").alias("largest"), F.count("*").alias("rows")
        )
        ranges.write.mode("overwrite").parquet(f"{self.folder(_RANGES)}/{family}/base={base}")

    def _folder_of(self, family: str, run: str, batch: int, day: str | None = None) -> str:
        folder = storage.batch_folder(self.folder(family), run, batch)
        return folder if day is None else f"{folder}/day={day}"


def _settled_and_contested(
    batches: dict[tuple[str, int], set[str]],
) -> tuple[set[str], set[str]]:
    """Days that one base alone holds, and all other days."""
    seen, contested = set(), set()
    for (run, _), days in batches.items():
        contested |= days if run != _BASE_RUN else days & seen
        seen |= days
    return seen - contested, contested


def _held_by_one_base(batches: dict[tuple[str, int], set[str]]) -> set[str]:
    """Days that stand in exactly one base, whatever else holds them."""
    held = Counter(day for (run, _), days in batches.items() if run == _BASE_RUN for day in days)
    return {day for day, count in held.items() if count == 1}


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows with their day, by day and row key.

    The day is a column before the rows are ordered: a sort by its expression would
    work it out again in every comparison.
    """
    order = ("day", "rowkey")
    placed = rows.withColumn("day", day_folder())
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)


def _on(versions: DataFrame, days: set[str]) -> DataFrame:
    return versions.where(F.col("day").isin(sorted(days)))


def _key_bytes(versions: DataFrame) -> int:
    """Size of the row keys with their versions in memory; reads one column."""
    size = F.sum(F.octet_length("rowkey") + _TAIL_ROW_BYTES).alias("bytes")
    return versions.agg(size).first()["bytes"] or 0
