"""Tables as Parquet folders plus one small commit file per version.

A version names, for each partition value, the write that holds its rows. A commit adds files and then
creates the next numbered commit file, which fails if somebody else was first; readers resolve the newest
file once. So a failed write changes nothing, and a merge rewrites only the partitions it touches.
"""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.versions import merge_by_key

WRITE, DAY = "_write", "_day"  # partition folders: the write that produced the files, then the business day
NO_DAY = "none"
COMMIT_ATTEMPTS = 5
# File systems where a rename refuses an existing target (a link, for local files), so only one writer can win.
EXCLUSIVE_COMMITS = ("file", "hdfs")


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


class MissingTable(LookupError):
    pass


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    days: dict[str, str] | None  # day -> write, or None for a table without partitions
    write: str | None = None
    applied: dict[str, str] | None = None  # what the version was made from: days of a source, versions or measures


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ files

    def _drop(self, *parts: str) -> None:
        self._fs().delete(self._path(*parts), True)

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return sorted(status.getPath().getName() for status in fs.listStatus(path)) if fs.exists(path) else []

    def _create(self, name: str, file: str, text: str) -> None:
        """Creates a commit file, whole or not at all, and fails if it is there already."""
        scheme = self._fs().getUri().getScheme()
        if scheme not in EXCLUSIVE_COMMITS:
            raise RuntimeError(f"a commit on {scheme} could be lost to another writer; use one of {EXCLUSIVE_COMMITS}")
        if scheme == "file":
            folder = os.path.join(urlparse(self.root).path, name, "commits")
            os.makedirs(folder, exist_ok=True)
            draft = os.path.join(folder, f".{uuid.uuid4().hex}")
            with open(draft, "w", encoding="utf-8") as out:
                out.write(text)
            try:
                os.link(draft, os.path.join(folder, file))  # atomic, and refuses an existing name
            except FileExistsError as taken:
                raise CommitConflict(f"{name} {file}") from taken
            finally:
                os.unlink(draft)
            return
        fs, target = self._fs(), self._path(name, "commits", file)
        draft = self._path(name, "commits", f".{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not fs.rename(draft, target):  # HDFS-like stores refuse to rename onto an existing file
            fs.delete(draft, False)
            raise CommitConflict(f"{name} {file}")

    def drop_at_exit(self) -> None:
        """The whole store goes when the driver's JVM ends."""
        self._fs().deleteOnExit(self._path())

    # ------------------------------------------------------------ versions

    def _latest(self, name: str) -> Version | None:
        files = self._commits(name)
        return self._version(name, files[-1]) if files else None

    def _commit_write(self, name: str, base: Version | None, schema: T.StructType, days, write: str, applied=None) -> int:
        """Commits the files of a write, of all days where `days` is None; they go if another writer was first."""
        try:
            return self._commit(name, base, schema, days, write if days is None else None, applied).number
        except CommitConflict:
            self._drop(name, "data", f"{WRITE}={write}")
            raise

    def _commit(self, name: str, base: Version | None, schema: T.StructType, days, write, applied=None) -> Version:
        version = Version((base.number if base else 0) + 1, schema, days, write, applied)
        body = {"number": version.number, "schema": schema.jsonValue(), "days": days, "write": write, "applied": applied}
        self._create(name, f"{version.number:012d}.json", json.dumps(body))
        return version

    def exists(self, name: str) -> bool:
        return self._latest(name) is not None

    def names(self) -> list[str]:
        return [name for name in self._names() if self.exists(name)]

    def version(self, name: str) -> int:
        latest = self._latest(name)
        return latest.number if latest else 0

    def _version(self, name: str, file: str) -> Version:
        stream = self._fs().open(self._path(name, "commits", file))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        body = json.loads(text)
        schema = T.StructType.fromJson(body["schema"])
        return Version(body["number"], schema, body["days"], body["write"], body.get("applied"))

    def _commits(self, name: str) -> list[str]:
        return [f for f in self._names(name, "commits") if f.endswith(".json") and not f.startswith(".")]

    def expire(self, name: str, keep: int = 2) -> int:
        """Deletes versions but the newest `keep`, and the files only they name; returns the versions deleted.

        Files of a write that is not committed yet belong to no version and are left alone.
        """
        files = self._commits(name)
        old, kept = files[: max(0, len(files) - max(keep, 1))], files[max(0, len(files) - max(keep, 1)) :]
        if not old:
            return 0

        def folders(version: Version) -> set[tuple[str, ...]]:
            if version.days is None:
                return {(f"{WRITE}={version.write}",)}
            return {(f"{WRITE}={write}", f"{DAY}={day}") for day, write in version.days.items()}

        alive = set().union(*(folders(self._version(name, file)) for file in kept))
        fs = self._fs()
        for file in old:
            for folder in folders(self._version(name, file)) - alive:
                fs.delete(self._path(name, "data", *folder), True)
            fs.delete(self._path(name, "commits", file), False)
        return len(old)

    # ------------------------------------------------------------ reading

    def read(self, name: str, from_day: str | None = None) -> DataFrame:
        """The newest version; with `from_day` only the folders of that day and later are opened."""
        latest = self._latest(name)
        if latest is None:
            raise MissingTable(name)
        days = None
        if from_day is not None and latest.days is not None:
            days = [day for day in latest.days if day >= from_day]  # rows without a day sort last
        return self._frame(name, latest, days).drop(DAY)

    def last_day(self, name: str) -> str | None:
        """Newest day folder; the maximum of the column the days are taken from lies in it."""
        latest = self._latest(name)
        days = [day for day in (latest.days or {}) if day != NO_DAY] if latest else []
        return max(days, default=None)

    def _frame(self, name: str, version: Version, days: list[str] | None = None) -> DataFrame:
        data = f"{self.root}/{name}/data"
        reader = self.spark.read
        if version.days is None:
            return reader.schema(version.schema).parquet(f"{data}/{WRITE}={version.write}")
        chosen = version.days if days is None else {d: version.days[d] for d in days if d in version.days}
        schema = T.StructType([*version.schema.fields, T.StructField(DAY, T.StringType())])
        if not chosen:
            return self.spark.createDataFrame([], schema)
        paths = [f"{data}/{WRITE}={write}/{DAY}={day}" for day, write in chosen.items()]
        partitions = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType())])
        return reader.schema(partitions).option("basePath", data).parquet(*paths).drop(WRITE)

    def days(self, name: str) -> dict[str, str]:
        """Day -> write of the newest version: two versions hold the same rows of a day if they name the same write."""
        latest = self._latest(name)
        return dict(latest.days or {}) if latest else {}

    def applied(self, name: str) -> dict[str, str] | None:
        """What a table's newest version says that it was made from; None where it says nothing."""
        latest = self._latest(name)
        return latest.applied if latest else None

    def read_days(self, name: str, days: dict[str, str]) -> DataFrame:
        """The rows of the given days as the given writes left them; the days may be those of an older version."""
        latest = self._latest(name)
        if latest is None:
            raise MissingTable(name)
        return self._frame(name, Version(latest.number, latest.schema, days)).drop(DAY)

    def holds(self, name: str, days: dict[str, str]) -> bool:
        """Whether the files of these days are still there: expired versions take theirs along."""
        fs = self._fs()
        return all(fs.exists(self._path(name, "data", f"{WRITE}={write}", f"{DAY}={day}")) for day, write in days.items())

    # ------------------------------------------------------------ writing

    def replace_parts(self, name: str, rows: DataFrame, part: Column, gone: set[str], applied: dict[str, str]) -> int:
        """Writes rows by part (a day as text, or any other name) in place of the parts in `gone`, or a new table.

        `applied` says which state of the source the table has then; both become visible in one commit.
        """
        base = self._latest(name)
        write, parts = self._write_files(name, rows.withColumn(DAY, part), by_day=True)
        kept = {d: w for d, w in (base.days or {}).items() if d not in gone} if base else {}
        return self._commit_write(name, base, rows.schema, {**kept, **dict.fromkeys(parts, write)}, write, applied)

    def _write_files(self, name: str, df: DataFrame, by_day: bool) -> tuple[str, list[str]]:
        write = uuid.uuid4().hex
        folder = f"{self.root}/{name}/data/{WRITE}={write}"  # a folder of its own: writers never share one
        try:
            if not by_day:
                df.write.parquet(folder)
                return write, []
            # Rebalancing keeps a day's files together, and splits a day that holds a large share of the rows.
            df.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(folder)
        except Exception:
            self._drop(name, "data", f"{WRITE}={write}")
            raise
        days = [n.removeprefix(f"{DAY}=") for n in self._names(name, "data", f"{WRITE}={write}") if n.startswith(DAY)]
        return write, days

    def overwrite(
        self, name: str, df: DataFrame, day: Column | None = None, new: bool = False, applied: dict[str, str] | None = None
    ) -> int:
        """Replaces the whole table; readers see the old rows until the commit.

        With `new` the table must not exist: of two writers creating it, the second gets a CommitConflict.
        """
        base = None if new else self._latest(name)
        frame = df if day is None else df.withColumn(DAY, day_text(day))
        write, days = self._write_files(name, frame, day is not None)
        by_day = None if day is None else dict.fromkeys(days, write)
        return self._commit_write(name, base, df.schema, by_day, write, applied)

    def overwrite_unless(
        self, name: str, df: DataFrame, measures: dict[str, Column], refused: Callable[[dict[str, str]], bool]
    ) -> dict[str, str] | None:
        """Replaces the whole table and returns measures of its rows, which are taken while they are written.

        Where `refused` says so of the measures, nothing is committed and None returned; nothing is committed either
        where they and the columns are those of the newest version.
        """
        base, seen = self._latest(name), Observation()
        write, _ = self._write_files(name, df.observe(seen, *(m.alias(c) for c, m in measures.items())), False)
        found = {c: str(value) for c, value in seen.get.items()}
        if refused(found):
            self._drop(name, "data", f"{WRITE}={write}")
            return None
        if base is not None and base.applied == found and base.schema == df.schema:
            self._drop(name, "data", f"{WRITE}={write}")
        else:
            self._commit_write(name, base, df.schema, None, write, found)
        return found

    def merge(
        self,
        name: str,
        rows: DataFrame,
        key: str,
        day: Column,
        choose: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Delete-and-insert by key, rewriting only days that hold an old or a new version of a key.

        `rows` is read more than once, so it should be a stored or staged table. `choose(stored)` sees the stored rows of
        those keys' days before anything is written and returns the rows to merge; of `rows` only the keys are read
        then. A writer that lost the race for the commit merges again onto the winner's version.
        """
        return self._retry(name, lambda base: self._merge_once(name, base, rows, key, day, choose))

    def delete(self, name: str, keys: DataFrame, key: str) -> int:
        """Removes the rows with the given keys, rewriting only the days that hold them."""

        def once(base: Version) -> int:
            touched = self._days_of(name, base, keys, key)
            kept = self._frame(name, base, touched).join(keys.select(key), key, "left_anti")
            return self._replace_days(name, base, touched, kept) if touched else base.number

        return self._retry(name, once)

    def _retry(self, name: str, attempt: Callable[[Version], int]) -> int:
        for lost in range(COMMIT_ATTEMPTS):
            time.sleep(lost * random.random())  # writers that met once should not meet again
            base = self._latest(name)
            if base is None or base.days is None:
                raise MissingTable(f"{name} is not a table by day")
            try:
                return attempt(base)
            except CommitConflict:
                continue
        raise CommitConflict(f"{name}: no commit in {COMMIT_ATTEMPTS} attempts")

    def _days_of(self, name: str, base: Version, keys: DataFrame, key: str, days: list[str] | None = None) -> list[str]:
        """Stored days that hold one of the keys; only the key column and the folder names are read."""
        bounds = keys.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
        if bounds["low"] is None:
            return []
        found = (
            self._frame(name, base, days)
            .filter(F.col(key).between(bounds["low"], bounds["high"]))  # reaches the Parquet statistics
            .select(key, DAY)
            .join(keys.select(key), key, "left_semi")
            .select(DAY)
            .distinct()
        )
        return sorted(row[0] for row in found.collect())  # at most one value per stored day

    def _merge_once(self, name, base, rows, key, day, choose) -> int:
        touched = self._days_of(name, base, rows, key)
        if choose is not None:
            rows = choose(self._frame(name, base, touched).drop(DAY))
            touched = self._days_of(name, base, rows, key, touched)
        dated = rows.withColumn(DAY, day_text(day))
        new_days = {row[0] for row in dated.select(DAY).distinct().collect()}
        if not new_days:
            return base.number
        touched = sorted(set(touched) | (new_days & set(base.days)))
        return self._replace_days(name, base, touched, merge_by_key(self._frame(name, base, touched), dated, key))

    def _replace_days(self, name: str, base: Version, touched: list[str], rows: DataFrame) -> int:
        write, days = self._write_files(name, rows, by_day=True)
        kept = {d: w for d, w in base.days.items() if d not in touched}
        schema = T.StructType([f for f in rows.schema.fields if f.name != DAY])
        return self._commit_write(name, base, schema, {**kept, **dict.fromkeys(days, write)}, write)

    # ------------------------------------------------------------ staging

    def stage(self, df: DataFrame) -> Staged:
        """Writes an intermediate result to shared storage and reads it back: computed once, survives lost executors."""
        shared = self.spark.conf.get("spark.checkpoint.dir", None) or f"{self.root}/_staging"
        return Staged(self.spark, df, f"{shared.rstrip('/')}/sparkmarts-{uuid.uuid4().hex}")


class Staged:
    """A written intermediate table, dropped at the end of a `with` block."""

    def __init__(self, spark: SparkSession, df: DataFrame, path: str):
        self._spark, self._path = spark, path
        try:
            df.write.parquet(path)
        except Exception:
            self.__exit__()
            raise
        self.frame = spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> DataFrame:
        return self.frame

    def __exit__(self, *_) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


def day_text(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NO_DAY))
