"""Lake layout and writers (2.1-2.4, 6.1 storage side).

Layout under a lake root (any Hadoop file system URI)::

    raw/<entity>/dt=<ds>/                  JSON Lines, one record per line
    bronze/<entity>/dt=<ds>/               Parquet, every column text + lineage
    bronze/_catalogue/dt=<ds>/             JSON, one row per entity
    silver/<stage>/<entity>/dt=<ds>/       Parquet (cleaned, enriched, validated, rejects;
                                           split: both sides of the gate until published)
    warehouse/history_<entity>/load_date=  Parquet, one partition per load day
    warehouse/fact_sales/cart_range=<n>/   Parquet, fact partitioned by cart-key range
    warehouse/dim_<name>/v=<n>/            Parquet snapshots of the dimensions
    audit/runs/                            Parquet, append-only

File-system calls go through the JVM's Hadoop ``FileSystem`` so they work on
HDFS/object stores exactly as Spark's own writers do.
"""

from __future__ import annotations

import re

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ── file-system helpers ──────────────────────────────────────────────────────
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def move_into(spark: SparkSession, source: str, path: str) -> None:
    """Folder ``source`` takes the place of ``path``: a rename, no row is read or written."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
    fs.mkdirs(p.getParent())
    if not fs.rename(_fs(spark, source)[1], p):
        raise OSError(f"could not move {source} to {path}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def partition_dir(root: str, ds: str, col: str = "dt") -> str:
    return f"{root.rstrip('/')}/{col}={ds}"


# ── stage layout (2.3) ───────────────────────────────────────────────────────
class Lake:
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def raw(self, entity: str) -> str:
        return f"{self.root}/raw/{entity}"

    def bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    def catalogue(self) -> str:
        return f"{self.root}/bronze/_catalogue"

    def silver(self, stage: str, entity: str) -> str:
        return f"{self.root}/silver/{stage}/{entity}"

    def history(self, entity: str) -> str:
        return f"{self.root}/warehouse/history_{entity}"

    def table(self, name: str) -> str:
        return f"{self.root}/warehouse/{name}"

    def audit(self) -> str:
        return f"{self.root}/audit/runs"


# ── writers ──────────────────────────────────────────────────────────────────
#: Compression of the lake's Parquet files: fewer bytes than the default, read by every engine.
PARQUET = {"compression": "zstd"}
#: Of its raw JSON Lines, a third of the plain bytes at no more time.  A compressed file is read by one
#: task, so files are bounded in records.
RAW_JSON = {"compression": "snappy", "maxRecordsPerFile": 250_000}


def land_json(df: DataFrame, root: str, ds: str) -> str:
    """Raw JSON sink (2.1): UTF-8 JSON Lines for one day, replaced on rerun.

    JSON Lines rather than one array per file, in files of bounded length, so that later reads split.
    Null fields are omitted, as an absent key in the source would be.
    """
    path = partition_dir(root, ds)
    df.write.mode("overwrite").option("encoding", "UTF-8").options(**RAW_JSON).json(path)
    return path


def counted(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    """Attach row metrics that are collected by the job that writes ``df``.

    Saves the separate ``count()`` job a read-back would cost.
    """
    obs = Observation(f"m_{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).alias("n_rows")] + [c.alias(k) for k, c in metrics.items()]
    return df.observe(obs, *exprs), obs


def write_day(df: DataFrame, root: str, ds: str, fmt: str = "parquet") -> str:
    """Stage/entity/day sink (2.2, 2.3): ``<root>/dt=<ds>``, overwritten on rerun."""
    path = partition_dir(root, ds)
    df.write.mode("overwrite").format(fmt).options(**(PARQUET if fmt == "parquet" else {})).save(path)
    return path


def write_day_counted(df: DataFrame, root: str, ds: str, fmt: str = "parquet") -> tuple[str, int]:
    observed, obs = counted(df)
    path = write_day(observed, root, ds, fmt)
    return path, int(obs.get["n_rows"])


def overwrite_partition(spark: SparkSession, df: DataFrame, root: str, ds: str,
                        col: str = "load_date") -> int:
    """Replace one partition of a partitioned table; returns the rows written.

    Dynamic partition overwrite replaces exactly the partitions present in
    ``df`` and commits them by rename at job end.  An empty frame writes no
    partition and would leave the old day in place, so that case deletes the
    partition directory explicitly.
    """
    observed, obs = counted(df)
    (observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**PARQUET)
       .partitionBy(col).parquet(root))
    n = int(obs.get["n_rows"])
    if n == 0:
        delete(spark, partition_dir(root, ds, col))
    return n


# ── versioned snapshots for upserted tables ─────────────────────────────────
_VERSION = re.compile(r"^v=(\d+)$")


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    out = []
    for name in list_dirs(spark, root):
        m = _VERSION.match(name)
        if m and exists(spark, f"{root.rstrip('/')}/{name}/_SUCCESS"):
            out.append(int(m.group(1)))
    return sorted(out)


def version_dir(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:06d}"


def read_version(spark: SparkSession, root: str, version: int, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(version_dir(root, version))


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Latest committed snapshot, or an empty frame of the declared schema."""
    versions = committed_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], schema)
    return read_version(spark, root, versions[-1], schema)


#: Snapshot versions that stay: the latest, and two for readers of an earlier state.
KEPT_VERSIONS = 3


def write_snapshot(spark: SparkSession, df: DataFrame, root: str, keep: int = KEPT_VERSIONS) -> int:
    """Write the next version; returns its row count (observed during the write).

    Parquet has no MERGE, so an upsert writes the new state as a new version;
    readers switch when its ``_SUCCESS`` marker lands and the previous version
    stays readable until then (the write is the commit).  Of the committed versions
    the last ``keep`` stay, so the table does not grow with the number of runs.
    """
    versions = committed_versions(spark, root)
    nxt = (versions[-1] + 1) if versions else 1
    observed, obs = counted(df)
    observed.write.mode("overwrite").options(**PARQUET).parquet(version_dir(root, nxt))
    n = int(obs.get["n_rows"])
    for version in [*versions, nxt][:-keep]:
        delete(spark, version_dir(root, version))
    return n


def append(df: DataFrame, root: str) -> None:
    df.write.mode("append").options(**PARQUET).parquet(root)
