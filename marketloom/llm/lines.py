"""Dropping lines that many documents share, by levelled sorted runs of line hashes.

The documents come in batches. Each batch's line hashes, with the number of its documents that
hold them, are one run, dealt by hash and sorted. Runs are kept in levels: when a level is full
its runs are merged into one of the next level, and hashes that have reached the number of
documents wanted move to the runs of settled hashes. A new batch is merge-anti-joined with those
first, so that the lines seen most often stop being written, and what is left of it is added as a
run of its own.

DataFrame functions only. A hash has 128 bits, and every line is looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import BROADCAST_ROWS, Scratch
from marketloom.operators.joins import heavy_keys, lookup_join

LEAST_DOCS = 10
LEAST_CHARS = 1
#: Batches into which a whole table is dealt, and runs that make a level full.
BATCHES = 4
FANOUT = 2

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """Each line without blanks (space, tab to carriage return) at its ends, A-Z in lower case."""
    bare = F.transform(split_lines(text), lambda line: F.btrim(line, F.lit(_BLANKS)))
    return F.transform(bare, _lowered)


def _lowered(line: Column) -> Column:
    plain = F.length(line) == F.octet_length(line)
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, _UPPER, _UPPER.lower()))


class LineRuns:
    """How many documents hold each line hash, as levelled sorted runs in the shared folder.

    `add` takes a batch, `settled` gives the hashes found in `settled_at` documents or more so
    far. The number of runs that are open grows with the logarithm of the number of batches. Every
    run is a written table, so a lost executor costs tasks of one merge.
    """

    def __init__(self, spark: SparkSession, settled_at: int = LEAST_DOCS, fanout: int = FANOUT):
        self.scratch = Scratch(spark)
        self.settled_at = settled_at
        self.fanout = fanout
        #: By level, runs of (key, docs) and runs of settled (key).
        self.open: list[list[DataFrame]] = []
        self.done: list[list[DataFrame]] = []

    def add(self, batch: DataFrame) -> None:
        """Add a batch: (key binary), a row for each document that holds the line."""
        fresh = self.unsettled(batch.groupBy("key").agg(F.count("*").alias("docs")))
        self._place(self.open, 0, self._run(fresh))
        level = 0
        while len(self.open[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def unsettled(self, rows: DataFrame) -> DataFrame:
        """Rows, one for each key, whose key has not been settled: a merge-anti-join.

        Written as an outer join, since Spark would carry out an anti-join before the rows
        have been combined by key.
        """
        runs = _all(self.done)
        if runs is None:
            return rows
        settled = runs.withColumn("_settled", F.lit(True)).hint("merge")
        return rows.join(settled, "key", "left").where("_settled is null").drop("_settled")

    def settled(self) -> DataFrame:
        """(key): hashes in at least `settled_at` documents of all batches, a written table."""
        runs = _all(self.open)
        known = _all(self.done)
        if runs is None:
            return self.scratch.spark.createDataFrame([], "key binary")
        late = self.unsettled(_merged([runs])).where(F.col("docs") >= self.settled_at)
        late = late.select("key")
        return self._run(late if known is None else late.unionByName(known))

    def _compact(self, level: int) -> None:
        """Merge a level's runs into one of the next level; settled hashes leave them."""
        merged = self.scratch.table(self.unsettled(_merged(self.open[level])))
        self.open[level] = []
        ready = F.col("docs") >= self.settled_at
        self._place(self.open, level + 1, self._run(merged.where(~ready)))
        self._place(self.done, 0, self._run(merged.where(ready).select("key")))
        for place, runs in enumerate(self.done):
            if len(runs) >= self.fanout:
                self.done[place] = []
                self._place(self.done, place + 1, self._run(reduce(DataFrame.unionByName, runs)))

    def _run(self, rows: DataFrame) -> DataFrame:
        """Write rows, dealt by hash already, with each file in the order of the hashes."""
        return self.scratch.table(rows.sortWithinPartitions("key"))

    @staticmethod
    def _place(levels: list[list[DataFrame]], level: int, run: DataFrame) -> None:
        while len(levels) <= level:
            levels.append([])
        levels[level].append(run)


def _all(levels: list[list[DataFrame]]) -> DataFrame | None:
    runs = [run for level in levels for run in level]
    return reduce(DataFrame.unionByName, runs) if runs else None


def _merged(runs: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, runs)
    return rows.groupBy("key").agg(F.sum("docs").alias("docs"))


def drop_common_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_docs: int = LEAST_DOCS,
    least_chars: int = LEAST_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    keep_text: bool = False,
) -> DataFrame:
    """Documents without the lines that at least `least_docs` documents hold.

    Lines are compared by `line_keys`; keys of fewer than `least_chars` code points stay, so blank
    lines do unless `least_chars` is 0. A line is dropped wherever it stands. Returns a row for
    each input row: (doc_id, n_lines, n_dropped, kept_sha256[, kept]), the hash of the lines left,
    joined by line feeds, as UTF-8.

    A null or empty text is one empty line. Each row counts as a document of its own, repeated
    rows and rows without a doc_id too; a line repeated within a row counts once. Very long texts
    and lines are read whole; a row's hashes, 32 characters a line, must fit a task. A number of
    documents just equal to `least_docs` drops. An empty table gives no rows. Other columns of the
    input, whatever their names, are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    doc_id, text = F.col(id_column).cast("long"), F.col(text_column)
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"))
    # Rows with equal ids and texts have equal results, so they may share a name.
    name = F.md5(
        F.concat(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.lit("\n"),
            F.coalesce(F.col("text"), F.lit("")),
        ).cast("binary")
    )
    hashes = F.transform(
        line_keys(F.col("text")),
        lambda key: F.when(F.length(key) >= least_chars, F.unhex(F.md5(key))),
    )
    hashed = rows.select(name.alias("row"), hashes.alias("keys"))
    path = scratch.path()
    batch = F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int")
    hashed.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    hashed = spark.read.schema("row string, keys array<binary>, batch int").parquet(path)

    runs = LineRuns(spark, least_docs, fanout)
    for n in range(batches):
        # As text, since Spark finds equal strings of an array by hash, but not equal bytes.
        each = F.array_distinct(F.transform("keys", F.hex))
        held = hashed.where(F.col("batch") == n).select(F.explode(each).alias("key"))
        runs.add(held.where("key is not null").select(F.unhex("key").alias("key")))
    dropped = _dropped(scratch, hashed, runs.settled())

    named = rows.withColumn("row", name)
    # Rows of one name are equal, so only where they lie can spread them.
    named = named.withColumn("part", F.spark_partition_id())
    heavy = heavy_keys(hashed, "row")
    joined = lookup_join(named, dropped, "row", "left", heavy, ["part"], hint="merge")
    lines = split_lines(F.col("text"))
    kept = F.when(F.col("gone").isNull(), lines).otherwise(_without(lines, F.col("gone")))
    result = joined.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )
    result = result.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
    return result.select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256", *(["kept"] if keep_text else [])
    )


def _dropped(scratch: Scratch, hashed: DataFrame, settled: DataFrame) -> DataFrame:
    """(row, gone): the numbers of the lines to drop, for rows that have any."""
    lines = hashed.select("row", F.posexplode("keys").alias("at", "key")).where("key is not null")
    if settled.count() <= BROADCAST_ROWS:
        found = lines.join(F.broadcast(settled), "key")
    else:
        # As text, whose heavy values Spark can count.
        lines, settled = (rows.withColumn("key", F.hex("key")) for rows in (lines, settled))
        found = lookup_join(
            lines, settled, "key", "inner", heavy_keys(lines, "key"), ["row", "at"]
        )
    gone = found.groupBy("row").agg(F.array_sort(F.collect_set("at")).alias("gone"))
    return scratch.table(gone)


def _without(items: Column, gone: Column) -> Column:
    """An array without the places in `gone`, which is sorted: the stretches between them."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size(gone)),
            lambda k: _stretch(
                items,
                F.coalesce(F.get(gone, k - 1) + 1, F.lit(0)),
                F.coalesce(F.get(gone, k), F.size(items)),
            ),
        )
    )


def _stretch(items: Column, start: Column, end: Column) -> Column:
    return F.slice(items, start + 1, end - start)
