"""Persistent sorted runs: key and value tables that grow batch by batch.

A run is a Parquet table, bucketed and sorted by its key, with one file a bucket.
Spark therefore merge-joins a batch with a run without shuffling or sorting the run.
``fanout`` runs of one level are merged into one of the next, bucket by bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import shuffle_width

#: Makes Spark use the order of a bucket that is one file.
FILE_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def file_order(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(FILE_ORDER)
    spark.conf.set(FILE_ORDER, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_ORDER, before)


class SortedRuns:
    """Runs below the folder ``path``, which is opened if it holds some.

    ``path/manifest`` has one row a live run and version. A run counts only once the
    manifest names it, so what a lost job left half written is never read. One writer
    at a time. Files of merged runs stay in the folder. The catalog names of runs are
    of this session alone: ``close`` drops them, files stay.
    """

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], value: str, fanout: int, buckets: int = 0):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.keys, self.value = list(keys), value
        self.schema = ", ".join(f"{k} {t}" for k, t in keys.items()) + f", {value} long"
        self.levels: list[list[str]] = []
        self.version, self.buckets = 0, buckets or shuffle_width(spark)
        self._named: set[str] = set()
        self._open()

    # -- the manifest ---------------------------------------------------------

    def _open(self) -> None:
        try:
            listed = self.spark.read.parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        newest = listed.agg(F.max("version").alias("newest"))
        for r in listed.join(F.broadcast(newest), F.col("version") == F.col("newest")).orderBy("level", "at").collect():
            while len(self.levels) <= r["level"]:
                self.levels.append([])
            self.levels[r["level"]].append(r["run"])
            self.version, self.buckets = r["version"], r["buckets"]

    def _commit(self) -> None:
        self.version += 1
        live = [
            F.struct(F.lit(level).alias("level"), F.lit(at).alias("at"), F.lit(run).alias("run"))
            for level, runs in enumerate(self.levels)
            for at, run in enumerate(runs)
        ]
        rows = self.spark.range(0, 1, 1, 1).select(F.explode(F.array(*live)).alias("r")).select(
            F.lit(self.version).alias("version"), F.lit(self.buckets).alias("buckets"), "r.*"
        )
        rows.write.mode("append").parquet(f"{self.path}/manifest")

    # -- runs -----------------------------------------------------------------

    def live(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def table(self, run: str) -> DataFrame:
        if run not in self._named:
            by, place = ", ".join(self.keys), f"{self.path}/{run}".replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {run} ({self.schema}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
            )
            self._named.add(run)
        return self.spark.table(run)

    def _write(self, rows: DataFrame) -> str:
        """``rows`` as a run; they come dealt into its buckets."""
        run = f"run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).format("parquet")
        # Hashes don't compress.
        writer.option("compression", "none").option("path", f"{self.path}/{run}").saveAsTable(run)
        self._named.add(run)
        return run

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows whose key no run has, dealt into buckets. To be run in ``file_order``."""
        new = rows.repartition(self.buckets, *self.keys)
        for run in self.live():
            new = new.hint("merge").join(self.table(run).select(*self.keys), self.keys, "left_anti")
        return new

    def merged(self, runs: list[str]) -> DataFrame:
        """Some runs as one table. They share no key, so the least value is the only one;
        grouping keeps equal buckets together."""
        rows = reduce(DataFrame.unionByName, [self.table(run) for run in runs])
        return rows.groupBy(*self.keys).agg(F.min(self.value).alias(self.value))

    def add(self, rows: DataFrame) -> None:
        """Take the rows (one a key) whose key no run has."""
        with file_order(self.spark):
            self._put(0, self._write(self.unseen(rows.select(*self.keys, self.value))))
        self._commit()

    def _put(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        runs = self.levels[level] + [run]
        if len(runs) < self.fanout:
            self.levels[level] = runs
            return
        self._put(level + 1, self._write(self.merged(runs)))
        self.levels[level] = []

    def files(self) -> DataFrame:
        """All runs as plain files, so that a join with them shuffles both sides
        and Spark can split a key which very many rows hold."""
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{run}" for run in self.live()])

    def found(self, rows: DataFrame) -> DataFrame:
        """The keys of ``rows`` (one row a key) that runs have, with the value held there
        and the columns of ``rows``. To be run in ``file_order``."""
        mine = rows.repartition(self.buckets, *self.keys)
        hits = [mine.hint("merge").join(self.table(run), self.keys) for run in self.live()]
        return reduce(DataFrame.unionByName, hits)

    def close(self) -> None:
        for run in self._named:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        self._named.clear()
