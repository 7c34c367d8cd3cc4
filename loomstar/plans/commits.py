"""All tables of a batch become visible at once: versioned folders, and one commit record that names those that count."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loomstar.operators.merge import upsert
from loomstar.session import stored
from loomstar.sources.sinks import write_table
from loomstar.sources.touched import findable, touched_files


class Conflict(RuntimeError):
    """Another batch was committed since this one began."""


class Snapshot:
    """The tables as one commit left them. What later commits do is not seen."""

    def __init__(self, spark: SparkSession, record: Mapping):
        self.spark, self.record = spark, record

    @property
    def number(self) -> int:
        return self.record["number"]

    def __contains__(self, name: str) -> bool:
        return name in self.record["tables"]

    def table(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(f"commit {self.number} has no table {name}")
        held = self.record["tables"][name]
        return self.spark.read.schema(StructType.fromJson(held["schema"])).parquet(*held.get("files", [held["path"]]))


class Batch:
    """Tables written, not yet visible."""

    def __init__(self, commits: Commits, before: Snapshot):
        self.commits, self.before, self.written, self.rows = commits, before, {}, {}

    def put(self, name: str, df: DataFrame, keys: Sequence[str] = (), files: int | None = None) -> int:
        """Write the next version of a table into a folder of its own; returns its rows.

        With ``keys`` files are ranges of keys, as many as ``files`` or as Spark finds fit, and can be told apart by them.
        """
        path = f"{self.commits.root}/{name}/version={uuid.uuid4().hex}"
        dealt, options = findable(df, keys, files) if keys else (df, {})
        self.rows[name] = write_table(dealt, path, options=options)
        self.written[name] = {"path": path, "schema": json.loads(df.schema.json())}
        return self.rows[name]

    def upsert(self, name: str, batch: DataFrame, keys: Sequence[str], set_columns: Sequence[str], batch_date: str, order: Sequence[str] = (), unique: bool = False, files: int | None = None) -> tuple[int, int]:
        """The table after ``merge.upsert`` of ``batch``, where only files that hold a key of the batch are written anew.

        Returns how many files were replaced and how many stay where they are. All rows of a key lie in replaced files, so what
        finds no match there is new. Rows with a null in their key are added. An empty batch replaces nothing.
        """
        if name in self.written:
            raise ValueError(f"{name} is already written by this batch")
        before, held = self.before.table(name), self.before.record["tables"][name]
        known = stored(batch.select(*keys).dropna().distinct(), "keys")
        gone = set(touched_files(before, known))
        present = held.get("files") or self.commits.files_in(held["path"])
        stay = [f for f in present if f.rpartition("/")[2] not in gone]
        replaced = [f for f in present if f.rpartition("/")[2] in gone]
        read = self.commits.spark.read.schema(before.schema)
        part = read.parquet(*replaced) if replaced else self.commits.spark.createDataFrame([], before.schema)
        self.put(name, upsert(part, batch, keys, set_columns, batch_date, order, unique), keys, files)
        self.written[name]["files"] = stay + self.commits.files_in(self.written[name]["path"])
        return len(replaced), len(stay)

    def table(self, name: str) -> DataFrame:
        """A table as this batch will leave it."""
        return Snapshot(self.commits.spark, {"number": self.before.number, "tables": self.before.record["tables"] | self.written}).table(name)


class Commits:
    """Tables under ``root``. Nothing is ever overwritten: a batch writes new folders and then one record, ``_commits/<number>``.

    A record is written under another name and renamed, and a rename onto a record that is there fails, so a commit is there
    whole or not at all, and of two batches begun on one commit only the first to finish is taken. Needs a file system whose
    rename is atomic. Tables that a batch does not write stay as they were.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._paths(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def files_in(self, folder: str) -> list[str]:
        """Data files of a version."""
        paths = [s.getPath() for s in self._files.listStatus(self._paths(folder)) if s.isFile()]
        return sorted(p.toString() for p in paths if not p.getName().startswith(("_", ".")))

    def _record_path(self, number: int) -> str:
        return f"{self.root}/_commits/{number:012d}"

    def numbers(self) -> list[int]:
        folder = self._paths(f"{self.root}/_commits")
        if not self._files.exists(folder):
            return []
        return sorted(int(n) for n in (s.getPath().getName() for s in self._files.listStatus(folder)) if n.isdigit())

    def _read(self, number: int) -> dict:
        stream = self._files.open(self._paths(self._record_path(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest commit, or an older one."""
        known = self.numbers()
        if number is None and not known:
            return Snapshot(self.spark, {"number": 0, "label": "", "tables": {}})
        if number is not None and number not in known:
            raise ValueError(f"no commit {number}")
        return Snapshot(self.spark, self._read(known[-1] if number is None else number))

    def _write(self, before: int, label: str, tables: Mapping) -> int:
        number = before + 1
        hidden = self._paths(f"{self.root}/_commits/.{uuid.uuid4().hex}")
        stream = self._files.create(hidden, False)
        stream.write(json.dumps({"number": number, "label": label, "tables": tables}).encode())
        stream.close()
        final = self._paths(self._record_path(number))
        if self._files.exists(final) or not self._files.rename(hidden, final):
            self._files.delete(hidden, False)
            raise Conflict(f"commit {number} is already there")
        return number

    @contextmanager
    def batch(self, label: str) -> Iterator[Batch]:
        """Tables ``put`` inside the block are committed together at its end; if it fails, none is, and readers see what was before."""
        batch = Batch(self, self.snapshot())
        try:
            yield batch
            self._write(batch.before.number, label, batch.before.record["tables"] | batch.written)
        except BaseException:
            for held in batch.written.values():
                self._files.delete(self._paths(held["path"]), True)
            raise

    def roll_back(self, number: int) -> int:
        """A new commit with the tables of an older one."""
        return self._write(self.snapshot().number, f"back to {number}", self.snapshot(number).record["tables"])

    def vacuum(self, keep: int) -> int:
        """Drop all but the newest ``keep`` records, and folders (of upserted tables: files) that no kept record names; returns the folders dropped. Not while a batch runs or a reader holds an older commit."""
        known = self.numbers()
        kept = [self._read(n) for n in known[-keep:]] if keep > 0 else []
        if not kept:
            raise ValueError("keep one commit at least")
        tables = [t for r in kept for t in r["tables"].values()]
        whole = {t["path"].rpartition("/")[2] for t in tables if "files" not in t}
        listed = {tuple(f.rsplit("/", 2)[1:]) for t in tables for f in t.get("files", [])}
        used, removed = whole | {folder for folder, _ in listed}, 0
        for number in known[:-keep]:
            self._files.delete(self._paths(self._record_path(number)), False)
        for table in self._files.listStatus(self._paths(self.root)):
            if table.isDirectory() and not table.getPath().getName().startswith("_"):
                for version in self._files.listStatus(table.getPath()):
                    folder = version.getPath().getName()
                    if folder not in used:
                        removed += bool(self._files.delete(version.getPath(), True))
                    elif folder not in whole:
                        for file in self.files_in(version.getPath().toString()):
                            if (folder, file.rpartition("/")[2]) not in listed:
                                self._files.delete(self._paths(file), False)
        return removed
