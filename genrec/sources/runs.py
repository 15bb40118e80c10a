"""Committed runs: a folder of tables counts once its manifest is written.

The tables of a run are written to a new folder; the manifest comes last, as one
small table with the name, row count and schema of each.  Readers refuse a
folder without one, so a run that failed midway is never mistaken for a whole
one.  Nothing is moved: on an object store a move copies every file, and
the manifest is the mark either way.  Helper tables live below ``_helpers`` and are
deleted when the run ends, also when it fails.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from genrec.session import delete_folder, path_exists

MANIFEST = "_manifest"
_SCHEMA = "name string, n_rows long, schema string"


class Run:
    """A run being written: ``with Run(spark, folder) as run: run.write({...})``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.written: list[tuple[str, int, str]] = []

    def __enter__(self) -> Run:
        if path_exists(self.spark, self.folder):
            raise FileExistsError(f"a run is a new folder, this one exists: {self.folder}")
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        try:
            if kind is None:
                rows = self.spark.createDataFrame(sorted(self.written), _SCHEMA)
                rows.coalesce(1).write.mode("errorifexists").json(f"{self.folder}/{MANIFEST}")
        finally:
            if path_exists(self.spark, f"{self.folder}/_helpers"):
                delete_folder(self.spark, f"{self.folder}/_helpers")

    def helper(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table that only this run reads (one job)."""
        path = f"{self.folder}/_helpers/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str, df: DataFrame, writer: DataFrameWriter | None = None, kind: str = "parquet", path: str | None = None) -> None:
        """Write one table of the run as ``<folder>/<path or name>`` (one job, which also counts its rows)."""
        count = Observation()
        seen = df.observe(count, F.count(F.lit(1)).alias("n"))
        out = (writer or (lambda d: d.write))(seen).mode("errorifexists").format(kind)
        out.save(f"{self.folder}/{path or name}")
        self.written.append((name, count.get["n"], df.schema.json()))

    def tables(self, tables: dict[str, DataFrame]) -> None:
        """Write independent tables as concurrent jobs; small jobs leave no cores idle."""
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:
            for f in [pool.submit(self.table, name, df) for name, df in tables.items()]:
                f.result()


def manifest(spark: SparkSession, folder: str) -> dict[str, tuple[int, str]]:
    """``name -> (rows, schema)`` of a committed run; raises for a folder that is none."""
    path = f"{folder.rstrip('/')}/{MANIFEST}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no committed run: {folder}")
    return {r.name: (r.n_rows, r.schema) for r in spark.read.schema(_SCHEMA).json(path).collect()}


def verify(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> None:
    """Raise unless the tables have the manifest's rows (one counting job per table)."""
    for name, (n_rows, _) in manifest(spark, folder).items():
        if name in tables and (n := tables[name].count()) != n_rows:
            raise ValueError(f"{folder}: {name} has {n} rows, its manifest {n_rows}")
