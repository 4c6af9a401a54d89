"""Session helpers of the operators: scratch tables, worker imports, fold columns."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a folder of its own; on a
    cluster that is an error, since executors share no local folder.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="faregrid-llm-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: losing an executor later costs no recomputation of ``df``.
    The shuffle files of the finished job are removed at once (a Spark setting,
    restored afterwards), so only the table stays on disk. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{uuid.uuid4().hex[:12]}-{name}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(df: DataFrame) -> DataFrame:
    """``df``, once Python workers of its session can import this package."""
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    # workers are reused: large arrays go back to the system when they are freed
    for name, value in (("ARROW_DEFAULT_MEMORY_POOL", "system"), ("MALLOC_ARENA_MAX", "2"), ("MALLOC_MMAP_THRESHOLD_", str(4 << 20)), ("MALLOC_TRIM_THRESHOLD_", str(16 << 20))):
        env.setdefault(name, value)
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null id: null)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(col.cast("string").cast("binary")) % parts


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. ASCII texts, where both agree, take the faster built-in."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, upper, lower))


def fresh_names(taken: Sequence[str], n: int) -> list[str]:
    """``n`` column names that are not among ``taken`` (whatever their case)."""
    seen, out, i = {c.lower() for c in taken}, [], 0
    while len(out) < n:
        if f"own_{i}" not in seen:
            out.append(f"own_{i}")
        i += 1
    return out
