"""Folders that hold a file for each run: made, listed and read by the tasks.

Spark's local file system starts a process for each file that it makes and for its
checksum (some 10 ms each), lists folders in a task for each and keeps a status of
every file on the driver.  On a file system that driver and executors mount
(``file:``) the tasks make, list and read such files by plain calls, and the driver
only moves finished folders into place.  Any other store keeps Spark's own writers
and readers; ``small_files`` has these deal many files to a task.

A job's files lie in a hidden folder until all of them are written: a job that
fails leaves nothing, and a task that runs again writes the same names again.
"""

from __future__ import annotations

import importlib.util
import itertools
import os
import re
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that a partition folder's name holds in escaped form.
ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
#: What the folder of a null or empty key is called.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
#: Bytes that opening a file counts for, beside its own, when files are dealt to tasks.
OPEN_COST = 64 << 10
#: Folders moved at a time, files and bytes handed on at a time.
MOVED, FILES_A_BATCH, BYTES_A_BATCH = 10_000, 1_000, 16 << 20


def small_files(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose readers list folders in as many tasks as a shuffle has, and put many small files into a task."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.files.openCostInBytes", OPEN_COST)
    own.conf.set("spark.sql.sources.ignoreDataLocality", True)  # else the driver holds a host's names for each file
    return own


def mounted(spark: SparkSession, path: str) -> str | None:
    """``path`` as driver and executors open it, or None if it lies in another store."""
    if importlib.util.find_spec("pyarrow") is None:
        return None
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def folder_name(key: str, value: str | None) -> str:
    return f"{key}=" + (ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_KEY)


# ------------------------------------------------------------------ writing
def write_lines(rows: DataFrame, folder: str, keys: list[str], suffix: str, mode: str, encoding: str, blank_lines: bool) -> None:
    """One file of lines for each value of ``keys``; the other column of ``rows`` is the line.

    ``rows`` are sorted by ``keys`` in each partition, and no value lies in two.
    Without ``blank_lines`` these are left out, and so is a file without a byte."""
    n = len(keys)

    class Lines:
        def __init__(self, path, schema):
            self.path, self.out = path, None

        def add(self, batch, at, end):
            for line in batch.column(n).slice(at, end - at).to_pylist():
                if line or blank_lines:
                    self.out = self.out or open(self.path, "wb")
                    self.out.write((line or "").encode(encoding, "replace"))
                    self.out.write(b"\n")

        def close(self):
            if self.out:
                self.out.close()
            return self.out is not None

    _write(rows, folder, keys, suffix, mode, Lines)


def write_parquet(rows: DataFrame, folder: str, keys: list[str], mode: str) -> None:
    """One zstd Parquet file for each value of ``keys``, of the other columns; ``rows`` as for ``write_lines``."""
    n = len(keys)

    class Parquet:
        def __init__(self, path, schema):
            import pyarrow as pa
            import pyarrow.parquet as pq

            self.out = pq.ParquetWriter(path, pa.schema(list(schema)[n:]), compression="zstd")

        def add(self, batch, at, end):
            import pyarrow as pa

            self.out.write_table(pa.Table.from_batches([pa.RecordBatch.from_arrays(batch.columns[n:], schema=self.out.schema).slice(at, end - at)]))

        def close(self):
            self.out.close()
            return True

    _write(rows, folder, keys, "zstd.parquet", mode, Parquet)


def _write(rows: DataFrame, folder: str, keys: list[str], suffix: str, mode: str, kind) -> None:
    job = str(uuid.uuid4())
    staging = f"{folder}/.staging-{job}"
    rows = rows.select(*keys, *[c for c in rows.columns if c not in keys])
    n, escaped, none = len(keys), ESCAPED.pattern, NO_KEY

    def write(batches):
        import os
        import re

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{job}.c000.{suffix}"
        part = lambda key, value: f"{key}=" + (re.sub(escaped, lambda m: f"%{ord(m[0]):02X}", value) if value else none)
        done, last, out, place = 0, None, None, None

        def finish():
            if out is not None and out.close():
                os.replace(f"{place}/.{name}-{task.taskAttemptId()}", f"{place}/{name}")
                return 1
            return 0

        for batch in batches:
            values = [*zip(*[batch.column(i).to_pylist() for i in range(n)], strict=True)]
            at = 0
            while at < len(values):
                end = at + 1
                while end < len(values) and values[end] == values[at]:
                    end += 1
                if out is None or values[at] != last:
                    done += finish()
                    last, place = values[at], "/".join([staging, *map(part, keys, values[at])])
                    os.makedirs(place, exist_ok=True)
                    out = kind(f"{place}/.{name}-{task.taskAttemptId()}", batch.schema)
                out.add(batch, at, end)
                at = end
        done += finish()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["files"])

    os.makedirs(staging)
    try:
        rows.mapInArrow(write, "files long").agg(F.sum("files")).collect()
        if mode == "overwrite":
            _drop([x.path for x in os.scandir(folder) if x.path != staging])
        _settle(staging, folder, n, mode == "partitions", f"{staging}/.old")
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def _drop(paths: list[str]) -> None:
    for path in paths:
        if os.path.isdir(path) and not os.path.islink(path):
            shutil.rmtree(path)
        else:
            os.remove(path)


def _settle(staging: str, folder: str, levels: int, replace: bool, old: str) -> None:
    """Moves what lies in ``staging`` to ``folder``: whole folders where there is none yet; a file's
    folder on the last level takes the place of an earlier one (``replace``) or its files join those there."""
    while True:
        with os.scandir(staging) as found:
            names = [x.name for x in itertools.islice(found, MOVED + 1) if not (x.is_dir() and x.name == ".old")]
        if not names:
            return
        for name in names:
            here, there = f"{staging}/{name}", f"{folder}/{name}"
            if levels == 0:
                os.replace(here, there)
            elif not os.path.lexists(there):
                os.rename(here, there)
            elif levels == 1 and replace:
                os.makedirs(old, exist_ok=True)
                os.rename(there, f"{old}/{uuid.uuid4().hex}")
                os.rename(here, there)
            else:
                _settle(here, there, levels - 1, replace, old)
                os.rmdir(here)


# ------------------------------------------------------------------ listing and reading
def read_files(spark: SparkSession, folder: str, glob: str, content: bool = True) -> DataFrame:
    """(path, modified, length, content): all files below ``folder`` with a byte whose names fit ``glob``,
    hidden ones apart; listed when the result is computed, ``modified`` in milliseconds.

    Every task lists the upper folders, and goes on below with its share of their entries."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few, at_a_time, most = 64 * parts, FILES_A_BATCH, BYTES_A_BATCH

    def read(batches):
        import fnmatch
        import os
        import zlib

        import pyarrow as pa

        shown = lambda name: not (name.startswith(".") or (name.startswith("_") and "=" not in name))

        def entries(tops):
            for top in tops:
                with os.scandir(top) as found:
                    yield from (x for x in found if shown(x.name))

        def below(x):
            if not x.is_dir():
                yield x
                return
            for y in entries([x.path]):
                yield from below(y)

        def share(part):
            """The files of one part: entries of the first level that has enough of them are dealt by path."""
            mine, tops = lambda x: zlib.crc32(os.fsencode(x.path)) % parts == part, [folder]
            while tops:
                level = []
                for x in entries(tops):
                    level.append(x)
                    if len(level) > few:
                        for y in entries(tops):
                            if mine(y):
                                yield from below(y)
                        return
                yield from (x for x in level if mine(x) and not x.is_dir())
                tops = [x.path for x in level if x.is_dir()]

        schema = pa.schema([("path", pa.string()), ("modified", pa.int64()), ("length", pa.int64()), ("content", pa.binary())])
        for batch in batches:
            for part in batch.column(0).to_pylist():
                rows, size = [], 0
                for x in share(part):
                    if not fnmatch.fnmatchcase(x.name, glob) or (stat := x.stat()).st_size == 0:
                        continue
                    data = None
                    if content:
                        with open(x.path, "rb") as f:
                            data = f.read()
                        size += len(data)
                    rows.append((f"file://{x.path}", stat.st_mtime_ns // 1_000_000, stat.st_size, data))
                    if len(rows) == at_a_time or size > most:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return spark.range(0, parts, 1, parts).mapInArrow(read, "path string, modified long, length long, content binary")


def with_content(files: DataFrame, limit: int) -> DataFrame:
    """``files`` (path, modificationTime, length) with ``content``: null above ``limit`` bytes, which are never read; a file that is gone is passed over."""
    most, at_a_time = BYTES_A_BATCH, FILES_A_BATCH

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            paths, lengths = batch.column("path").to_pylist(), batch.column("length").to_pylist()
            rows, contents, size = [], [], 0
            for i, (path, length) in enumerate(zip(paths, lengths)):
                data = None
                if length <= limit:
                    try:
                        with open(path.removeprefix("file:"), "rb") as f:
                            data = f.read()
                    except FileNotFoundError:
                        continue
                    size += length
                rows.append(i)
                contents.append(data)
                if size > most or len(rows) == at_a_time:
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows, pa.int64())).columns, pa.array(contents, pa.binary())], names=[*batch.schema.names, "content"])
                    rows, contents, size = [], [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows, pa.int64())).columns, pa.array(contents, pa.binary())], names=[*batch.schema.names, "content"])

    files = files.select("path", "modificationTime", "length")
    return files.mapInArrow(read, "path string, modificationTime timestamp, length long, content binary")


def note_arrivals(spark: SparkSession, folder: str, glob: str, lists: str, most: int | None = None) -> None:
    """Lists the files below ``folder`` that no list in ``lists`` (a mounted folder of Parquet files) has yet, in new lists of (path,
    modificationTime, length) there: of at most ``most`` files each, oldest first, which the lists' own times follow."""
    os.makedirs(lists, exist_ok=True)
    found = read_files(spark, folder, glob, content=False).select(
        F.concat(F.lit("file:"), F.substring("path", len("file://") + 1, 1 << 30)).alias("path"), F.timestamp_millis("modified").alias("modificationTime"), "length")
    earlier = [x.path for x in os.scandir(lists) if x.name.endswith(".parquet")]
    if earlier:
        found = found.join(spark.read.schema(found.schema).parquet(f"file://{lists}").select("path"), "path", "left_anti").select(*found.columns)
    new = f"{lists}/.new-{uuid.uuid4()}"
    try:
        if most:
            found.sort("modificationTime", "path").write.option("maxRecordsPerFile", most).parquet(f"file://{new}")
        else:
            found.write.parquet(f"file://{new}")
        if spark.read.schema(found.schema).parquet(f"file://{new}").isEmpty():
            return
        at = max((os.stat(x).st_mtime_ns for x in earlier), default=0) // 1_000_000
        order = lambda name: [int(x) for x in re.match(r"part-(\d+)-.*[.-]c(\d+)\.", name).groups()]
        for name in sorted((x for x in os.listdir(new) if x.endswith(".parquet")), key=order):
            at = max(at + 1, os.stat(f"{new}/{name}").st_mtime_ns // 1_000_000)
            os.utime(f"{new}/{name}", ns=(at * 1_000_000, at * 1_000_000))
            os.rename(f"{new}/{name}", f"{lists}/{name}")
    finally:
        shutil.rmtree(new, ignore_errors=True)


def read_folders(keys: DataFrame, folder: str, glob: str) -> DataFrame:
    """(path, content): the files that fit ``glob`` in the folder of each value of ``keys``, a DataFrame of one column; no other folder is looked at."""
    (key,) = keys.columns
    escaped, none = ESCAPED.pattern, NO_KEY

    def read(batches):
        import fnmatch
        import os
        import re

        import pyarrow as pa

        for batch in batches:
            paths, contents = [], []
            for value in batch.column(0).to_pylist():
                place = f"{folder}/{key}=" + (re.sub(escaped, lambda m: f"%{ord(m[0]):02X}", value) if value else none)
                for name in sorted(os.listdir(place)):
                    if fnmatch.fnmatchcase(name, glob) and not name.startswith((".", "_")) and os.path.getsize(f"{place}/{name}"):
                        with open(f"{place}/{name}", "rb") as f:
                            contents.append(f.read())
                        paths.append(f"file://{place}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])

    return keys.mapInArrow(read, "path string, content binary")
