"""Publishing staged files as one step: all of a run's months become visible, or none stays half done.

Rows are first written to a staging folder inside the table (``_staging-ID``, which readers
skip). Then an intent (``_intent-ID``, a small text file that lists every move) is
written, and only then are folders and files moved. A run that is stopped before the intent
leaves the table as it was, and the next writer drops its staging folder; a run that is stopped later is finished by the next reader or
writer of the table (``recover``): every move is done if it has not been done yet. One
writer at a time is assumed for a table, beside any number of readers.

Moves are renames in one file system (cheap on HDFS; on an object store, where a rename is a copy,
each moved file is copied once).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

STAGING, REPLACED, INTENT = "_staging-", "_replaced-", "_intent-"


@dataclass
class Intent:
    """Moves of one run, as paths below the table: ``out`` is set aside first, then ``moves`` (from, to) follow."""

    run: str
    out: list[str] = field(default_factory=list)
    moves: list[tuple[str, str]] = field(default_factory=list)


class Files:
    """The few file-system calls that publishing needs, for paths below one table."""

    def __init__(self, spark: SparkSession, table: str):
        self.table = table.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.table).getFileSystem(spark._jsc.hadoopConfiguration())
        self._charset = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def at(self, name: str):
        return self._path(f"{self.table}/{name}")

    def names(self, pattern: str) -> list[str]:
        """Existing paths that match, as names below the table."""
        root = self._path(self.table).toUri().getPath()
        found = self.fs.globStatus(self.at(pattern)) or []
        return sorted(str(s.getPath().toUri().getPath())[len(root) + 1 :] for s in found)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.at(target).getParent())
        if not self.fs.rename(self.at(source), self.at(target)) and (self.exists(source) or not self.exists(target)):
            raise OSError(f"cannot move {source} to {target} in {self.table}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def write(self, name: str, text: str) -> None:
        """A small file, complete or absent: written beside its name and renamed."""
        out = self.fs.create(self.at(f"{name}.tmp"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(f"{name}.tmp", name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self._io.toString(stream, self._charset)
        finally:
            stream.close()


def new_run(spark: SparkSession, table: str) -> str:
    """A writer begins: runs stopped after their intent are finished, those stopped before it are dropped."""
    recover(spark, table)
    files = Files(spark, table)
    for name in [*files.names(f"{INTENT}*.tmp"), *files.names(f"{STAGING}*")]:
        files.delete(name)
    return uuid.uuid4().hex[:12]


def staging(table: str, run: str) -> str:
    """Where a run writes its rows before they are published."""
    return f"{table.rstrip('/')}/{STAGING}{run}"


def _finish(files: Files, intent: Intent) -> None:
    for name in intent.out:
        aside = f"{REPLACED}{intent.run}/{name}"
        # set aside once: what has the name later is the new one
        if files.exists(name) and not files.exists(aside):
            files.move(name, aside)
    for source, target in intent.moves:
        if files.exists(source):
            files.move(source, target)
    for name in (f"{REPLACED}{intent.run}", f"{STAGING}{intent.run}", f"{INTENT}{intent.run}"):
        files.delete(name)


def recover(spark: SparkSession, table: str) -> list[str]:
    """Finish the moves of runs that were stopped after their intent; returns the runs finished."""
    files = Files(spark, table)
    done = []
    for name in files.names(f"{INTENT}*"):
        if name.endswith(".tmp"):
            continue
        found = json.loads(files.read(name))
        _finish(files, Intent(found["run"], found["out"], [tuple(m) for m in found["moves"]]))
        done.append(found["run"])
    return done


def _commit(files: Files, intent: Intent) -> None:
    files.write(f"{INTENT}{intent.run}", json.dumps(asdict(intent)))
    _finish(files, intent)


def replace_partitions(spark: SparkSession, table: str, run: str, wanted: Iterable[str]) -> set[str]:
    """Publish a staged run: of the ``wanted`` partitions (names such as ``year=2023/month=1``) the staged ones replace
    what the table had, and the others go. Returns the staged ones."""
    files = Files(spark, table)
    prefix = f"{STAGING}{run}/"
    wanted = sorted(set(wanted))
    staged = {n for n in wanted if files.exists(prefix + n)}
    intent = Intent(run, [n for n in wanted if files.exists(n)], [(prefix + n, n) for n in sorted(staged)])
    _commit(files, intent)
    return staged


def move_in(spark: SparkSession, table: str, run: str, folder: str, partitions: Sequence[str], others: Sequence[str] = ()) -> None:
    """Publish a staged run by adding its files to the table: those of the partitions in the staged ``folder``, and those
    that match ``others`` beside it. Names of data files are unique, so what the table has stays."""
    files = Files(spark, table)
    prefix = f"{STAGING}{run}/"
    moves = [(n, n[len(prefix) + len(folder) + 1 :]) for p in partitions for n in files.names(f"{prefix}{folder}/{p}/*.parquet")]
    moves += [(n, n[len(prefix) :]) for p in others for n in files.names(prefix + p)]
    _commit(files, Intent(run, [], moves))
