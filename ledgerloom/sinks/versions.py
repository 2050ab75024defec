"""Several tables that change together: versions, a commit journal, roll back (B-01, B-06, J-05, J-07, J-11).

A batch writes new folders only; nothing that is read now is touched.  Its last step renames a
finished manifest, the list of all folders of all tables, to the next version number.  That one
rename makes every write of the batch visible at once, or, if the run stops at any point before
it, none.  The manifest also lists the batches it holds, so a batch that is repeated changes nothing.

Every version stays readable until ``vacuum``; ``restore`` makes an old one the newest again.  The
folder must lie on a file system whose rename is atomic and fails where the target exists (HDFS,
ABFS, a local disk), so of two runs that commit at once one fails and can be repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.tables import local_table

_MANIFEST = "entry string, table_name string, part string, folder string, batch string, schema string"
WHOLE = "all"


class CommitConflict(RuntimeError):
    """Another run committed the version this one was to be."""


@dataclass(frozen=True)
class Write:
    """What a batch does to one table: its rows become ``df`` (replace), get ``df`` added (append), those
    of the parts that ``df`` holds, or ``parts`` names, become ``df`` (parts), or the parts that ``parts``
    names go and ``df`` is added, to whatever parts its rows are of (move).

    ``df`` may be a function of a reader of what the batch has written to earlier tables.  ``by`` is a
    column or its name; where all rows are of one part, ``one`` names it and they are written as they
    come.  ``hidden`` columns are written for later tables of the batch; they are no columns of the
    table.  ``options`` are the writer's.
    """

    df: DataFrame | Callable[[Callable[[str], DataFrame]], DataFrame]
    how: str = "replace"
    by: str | Column | None = None
    parts: tuple[str, ...] = ()
    one: str | None = None
    hidden: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)


class VersionedTables:
    """Tables of one folder.  Parts are values of one column (a day, as a rule), as text."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # the manifest

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of all versions that can be read, oldest first."""
        fs, home = self._fs(), self._path(f"{self.root}/_manifests")
        names = [s.getPath().getName() for s in fs.listStatus(home)] if fs.exists(home) else []
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def manifest(self, version: int | None = None) -> DataFrame:
        """Entries of a version (the newest): folders of tables and batches that it holds."""
        known = self.versions()
        version = (known[-1] if known else None) if version is None else version
        if version is None:
            return local_table(self.spark, _MANIFEST, [])
        if version not in known:
            raise ValueError(f"version {version} can't be read; there are {known}")
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/_manifests/v={version}")

    def _publish(self, entries: DataFrame, version: int) -> None:
        """The one step that makes a version: a rename that fails if the version is there."""
        made = f"{self.root}/_manifests/next-{uuid.uuid4().hex}"
        entries.coalesce(1).write.parquet(made)
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self._path(made), self._path(f"{self.root}/_manifests/v={version}"), none)
        except Py4JJavaError as exc:
            if "FileAlreadyExists" in exc.java_exception.getClass().getName():
                self._fs().delete(self._path(made), True)
                raise CommitConflict(f"version {version} of {self.root} was made by another run") from None
            raise

    # reading

    def tables(self, version: int | None = None) -> list[str]:
        rows = self.manifest(version).where("entry = 'table'").select("table_name").distinct().collect()
        return sorted(r["table_name"] for r in rows)

    def read(self, table: str, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """Rows of a table in a version (the newest); ``parts`` leaves the folders of other parts unread."""
        rows = self.manifest(version).where((F.col("table_name") == table) & F.col("entry").isin("table", "folder")).collect()
        schema = next((r["schema"] for r in rows if r["entry"] == "table"), None)
        if schema is None:
            raise ValueError(f"no table {table} in {self.root}")
        kind = T.StructType.fromJson(json.loads(schema))
        folders = [r["folder"] for r in rows if r["entry"] == "folder" and (parts is None or r["part"] in parts)]
        if not folders:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).option("recursiveFileLookup", "true").parquet(*[f"{self.root}/{f}" for f in folders])

    def parts(self, table: str, version: int | None = None) -> list[str]:
        """Parts of a table in a version (the newest) that have folders."""
        rows = self.manifest(version).where((F.col("table_name") == table) & (F.col("entry") == "folder")).select("part").distinct().collect()
        return sorted(r["part"] for r in rows)

    def holds(self, batch: str, version: int | None = None) -> bool:
        """Is the batch part of the version?"""
        return not self.manifest(version).where((F.col("entry") == "batch") & (F.col("batch") == batch)).isEmpty()

    # writing

    def aside(self, df: DataFrame) -> DataFrame:
        """Rows that several steps of a batch read, written once and of a size that Spark knows; gone with the next ``vacuum``."""
        path = f"{self.root}/_aside/run={uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self, batch: str, writes: Mapping[str, Write], after_write: Callable[[str], None] | None = None) -> bool:
        """All of ``writes`` or none; False if the newest version holds the batch already.

        ``after_write`` is called with the name of each table once its folders are written, and with
        "commit" before the version is made; what it raises stops the run there.
        """
        known = self.versions()
        version = known[-1] if known else 0
        now = self.manifest(version if known else None)
        if self.holds(batch, version if known else None):
            return False
        run = uuid.uuid4().hex
        kept, new, made = now, [], {}
        for table, write in writes.items():
            folder = f"{table}/run={run}"
            df = write.df if isinstance(write.df, DataFrame) else write.df(lambda t: self.spark.read.schema(made[t].schema).parquet(f"{self.root}/{t}/run={run}").select(*made[t].columns))
            made[table] = df
            new.append(("table", table, None, None, batch, df.drop(*write.hidden).schema.json()))
            kept = kept.where(~((F.col("entry") == "table") & (F.col("table_name") == table)))
            gone = F.lit(True)
            if write.by is None:
                df.write.options(**write.options).parquet(f"{self.root}/{folder}")
                new.append(("folder", table, write.one or WHOLE, folder, batch, None))
                if write.how in ("parts", "move"):
                    raise ValueError(f"{table}: parts of which column?")
            else:
                by = F.col(write.by) if isinstance(write.by, str) else write.by
                part = F.coalesce(by.cast("string"), F.lit("null"))
                # rows of one part go together, those of a large one to several tasks
                df.withColumn("__part", part).hint("rebalance", "__part").write.options(**write.options).partitionBy("__part").parquet(f"{self.root}/{folder}")
                values = self._parts_of(folder)
                new += [("folder", table, value, f"{folder}/{name}", batch, None) for value, name in values]
                gone = F.col("part").isin(([] if write.how == "move" else [v for v, _ in values]) + list(write.parts))
            if write.how != "append":
                old = (F.col("entry") == "folder") & (F.col("table_name") == table)
                kept = kept.where(~(old & (gone if write.how in ("parts", "move") else F.lit(True))))
            if after_write:
                after_write(table)
        new.append(("batch", None, None, None, batch, None))
        if after_write:
            after_write("commit")
        self._publish(kept.unionByName(local_table(self.spark, _MANIFEST, new)), version + 1)
        return True

    def _parts_of(self, folder: str) -> list[tuple[str, str]]:
        """Values of the parts written to a folder, and their folders' names."""
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path(f"{self.root}/{folder}")) if s.isDirectory()]
        return [(unquote(n.split("=", 1)[1]), n) for n in names if n.startswith("__part=")]

    def restore(self, version: int) -> int:
        """Make the tables, and the batches held, those of an old version again; the new version's number."""
        entries, newest = self.manifest(version), self.versions()[-1]
        self._publish(entries, newest + 1)
        return newest + 1

    def vacuum(self, keep: int = 1) -> None:
        """Delete all versions but the newest ``keep``, and folders no version is left that reads; not while another run writes."""
        fs, known = self._fs(), self.versions()
        for version in known[:-keep]:
            fs.delete(self._path(f"{self.root}/_manifests/v={version}"), True)
        read = set()
        for version in known[-keep:]:
            read |= {f"{r['table_name']}/{r['folder'].split('/')[1]}" for r in self.manifest(version).where("entry = 'folder'").collect()}
        for table in (s.getPath().getName() for s in fs.listStatus(self._path(self.root))):
            for run in fs.listStatus(self._path(f"{self.root}/{table}")):
                name = run.getPath().getName()
                if (table == "_manifests" and name.startswith("next-")) or (table != "_manifests" and f"{table}/{name}" not in read):
                    fs.delete(run.getPath(), True)


def replace_days(tables: VersionedTables, table: str, source: DataFrame, by: str, batch: str, check: Callable[[DataFrame], bool] | None = None) -> int:
    """J-05: the days that ``source`` holds are replaced, other days stay; back to the old state if the new rows fail their ``check``.

    The number of the version that holds afterwards.
    """
    before = tables.versions()
    tables.commit(batch, {table: Write(source, "parts" if before else "replace", by)})
    if check is None or not before or check(tables.read(table)):
        return tables.versions()[-1]
    return tables.restore(before[-1])
