"""Line deduplication by levelled sorted runs of line hashes.

The hashes of all lines are dealt to batches by descending id. Each batch becomes a run: its
distinct hashes with counts, and those that no earlier run holds, found by a merge anti-join of
the sorted, bucketed runs, with the id that keeps the line. As ids descend, the first holder of a
hash has the largest id. When a level has ``fan_in`` runs they are compacted into one run of the
next level. A line's hash is half of a SHA-256 digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmart.llm.common import lower_ascii, new_folder, row_key, stored, text_of

BATCHES = 4
FAN_IN = 2
MIN_LENGTH = 20
MIN_DOCS = 3
#: Hashes with more than this part of all lines are joined by broadcast; there are at most so many.
HEAVY = 10_000
BLANK = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(text: Column, min_length: int) -> Column:
    """A hash for each line of the text; null for lines whose key is too short to count."""
    trimmed = F.transform(split_lines(text), lambda line: F.btrim(line, F.lit(BLANK)))
    keys = F.transform(trimmed, lower_ascii)
    digest = lambda key: F.substring(F.unhex(F.sha2(key, 256)), 1, 16)
    return F.transform(keys, lambda key: F.when(F.length(key) >= min_length, digest(key)))


class LineRuns:
    """Runs of line hashes, each a pair of tables that are bucketed and sorted by the hash.

    ``counts`` (hash, n, last) has all hashes of the run's batches, ``holders`` (hash, keeper) only
    those that were new then. So every hash has one holder over all runs.
    """

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN, buckets: int | None = None):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = [[]]
        self.tables: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables[name] = new_folder(self.spark, "line-run")
        (
            rows.write.bucketBy(self.buckets, "hash")
            .sortBy("hash")
            .option("path", self.tables[name])
            .option("compression", "zstd")
            .saveAsTable(name)
        )
        return name

    def runs(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch of (hash, id), one row per document and line, and returns its new hashes.

        The ids of a batch are not above those of earlier batches.
        """
        counted = lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
        counts = self._write(counted)
        fresh = self.spark.table(counts)
        for _, holders in self.runs():
            fresh = fresh.join(self.spark.table(holders).select("hash"), "hash", "left_anti")
        holders = self._write(fresh.select("hash", F.col("last").alias("keeper")))
        self.levels[0].append((counts, holders))
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fan_in:
                self._compact(level)
        return self.spark.table(holders)

    def _merged(self, runs: list[tuple[str, str]]) -> tuple[str, str]:
        counts, holders = (self._union([run[part] for run in runs]) for part in (0, 1))
        summed = counts.groupBy("hash").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        return self._write(summed), self._write(holders)

    def _union(self, names: list[str]) -> DataFrame:
        """The tables' rows, read as files: a union of bucketed tables counts as bucketed to Spark,
        which then groups it without a shuffle although it doesn't read the buckets in turn."""
        schema = self.spark.table(names[0]).schema
        rows = self.spark.createDataFrame([], schema)
        for name in names:
            rows = rows.unionByName(self.spark.read.schema(schema).parquet(self.tables[name]))
        return rows

    def _compact(self, level: int) -> None:
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(self._merged(self.levels[level]))
        self.levels[level] = []

    def whole(self) -> DataFrame:
        """All hashes: hash, n and keeper."""
        runs = self.runs()
        counts, holders = runs[0] if len(runs) == 1 else self._merged(runs)
        return self.spark.table(counts).drop("last").join(self.spark.table(holders), "hash")

    def drop(self) -> None:
        """Forgets the tables; their files stay in the shared folder until the application ends."""
        for name in self.tables:
            self.spark.sql(f"drop table if exists {name}")


def _dealt(docs: DataFrame, text_col: str, id_col: str, min_length: int, batches: int) -> DataFrame:
    """id, digest and the hashes of the lines of each row, stored by ``batch`` in descending ids."""
    spark = docs.sparkSession
    parts = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashes = line_hashes(text_of(text_col), min_length)
    rows = docs.select(row_key(id_col, text_col).alias("row"), hashes.alias("hashes"))
    # Stored first: finding the ranges reads the rows once more.
    return stored(
        stored(rows.select("row.id", "row.digest", "hashes"), "line-hashes-read")
        .repartitionByRange(parts, F.desc_nulls_last("id"), "digest")
        .withColumn("batch", F.floor(F.spark_partition_id() * F.lit(batches) / F.lit(parts)).cast("int")),
        "line-hashes",
        by="batch",
    )


def _flags(gone: Column) -> Column:
    """One byte per line up to the last dropped one, ``1`` where it goes, from sorted places."""
    before = F.concat(F.array(F.lit(-1)), F.slice(gone, 1, F.size(gone) - 1))
    runs = F.zip_with(gone, before, lambda b, a: F.concat(F.repeat(F.lit("0"), b - a - 1), F.lit("1")))
    return F.array_join(runs, "").cast("binary")


def repeated_places(lines: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """id, digest, n_dropped and flags of the rows that lose lines.

    A hash of more than ``total / HEAVY`` lines, of which there are at most ``HEAVY``, meets its
    lines by broadcast; no other hash has more lines than that, so no join key is hot.
    """
    places = lines.select("id", "digest", F.posexplode("hashes").alias("at", "hash")).where("hash is not null")
    most = total // HEAVY
    heavy = F.broadcast(repeated.where(F.col("n") > most).select("hash", "keeper"))
    light = repeated.where(F.col("n") <= most).select("hash", "keeper")
    met = places.join(heavy, "hash").unionByName(
        places.join(heavy.select("hash"), "hash", "left_anti").join(light, "hash")
    )
    gone = met.where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id", "digest")
    places = gone.agg(F.array_sort(F.collect_set("at")).alias("gone"))
    return places.select("id", "digest", F.size("gone").cast("long").alias("n_dropped"), _flags(F.col("gone")).alias("flags"))


def line_dedup(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    min_length: int = MIN_LENGTH,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """For each row: its id as ``doc_id``, n_lines, n_dropped, the text ``kept`` and its kept_sha256.

    Lines are told by their key: blanks at both ends off, A-Z lower-cased. Keys of at least
    ``min_length`` code points in at least ``min_docs`` rows stay in the row of the largest id and
    go elsewhere. A null or empty text is one empty line. Every row counts as a document, also
    where ids or whole rows repeat; rows that share the largest id all keep their lines, and null
    ids are smaller than all others. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    lines = _dealt(docs, text_col, id_col, min_length, batches)
    runs = LineRuns(spark, fan_in)
    # Repeats inside a row count once. Text is told apart in linear time, binary is not.
    own = F.array_distinct(F.transform(F.filter("hashes", lambda h: h.isNotNull()), F.hex))
    for batch in range(batches):
        part = lines.where(F.col("batch") == batch)
        runs.add(part.select("id", F.explode(own).alias("hash")).withColumn("hash", F.unhex("hash")))
    repeated = stored(runs.whole().where(F.col("n") >= min_docs), "repeated-lines")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    gone = stored(repeated_places(lines, repeated, total), "dropped-lines")
    runs.drop()
    rows = docs.select(row_key(id_col, text_col).alias("row"), text_of(text_col).alias("text"))
    same = rows["row.id"].eqNullSafe(gone["id"]) & (rows["row.digest"] == gone["digest"])
    # As many rows lose lines as the corpus has: merged at every size.
    whole = rows.join(gone.hint("merge"), same, "left").select("row", "text", "n_dropped", "flags")
    stays = F.filter(
        split_lines(F.col("text")),
        lambda line, at: F.substring(F.col("flags"), at + 1, F.lit(1)) != F.lit(b"1"),
    )
    kept = F.when(F.col("flags").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    return whole.select(
        F.col("row.id").alias("doc_id"),
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        kept.alias("kept"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )
