"""ZIP-of-CSV archives as a Spark source (S1-S5) with a per-archive status side
output (S3), plus the archive writer the test bed uses to produce inputs.

Scan: ``binaryFile`` lists the archives (path, time, length; any depth, or one month's
directories only).  A first map reads each archive's central directory, a few KB at its
end, and gives one row for every CSV member; these rows are dealt round-robin, and a
second map streams each member through the filesystem, in chunks.  So a task holds a
block of lines whatever the size of the archive or of its members, archives have no size
limit, and one big archive of many members is many tasks.  The rows' semantics are those
of ``csvrows``.

Members not ending in ``.csv`` (any case) are ignored; every CSV member is read.  A fault
(bad checksum, truncation, encryption, unknown compression, a field beyond the csv
module's limit) ends its member: all complete rows before it are kept, and the archive's
other members are read.  What is no ZIP gives no rows.  A quote that is never closed takes
the rest of its member into its field, as in the csv module, and is named too.

Status: with ``status_to``, the tasks that read the rows also write what they found, a
small Parquet file a task, under a temporary name and renamed; a repeated task replaces
its file.  So rows and status come from the one pass that the caller's write makes, and
``read_status`` sums them up by archive afterwards.

Stores that only Spark opens (no filesystem of pyarrow has their scheme) are read through
the ``content`` column of ``binaryFile``, an archive a row.  That column ends at 2 GiB;
larger archives there are an error of the scan, unless only their status is asked for.
"""

from __future__ import annotations

import csv
import io
import math
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
import pyarrow.parquet as papq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.schema import RAW_COLUMNS
from ontime.sources.catalog import exists
from ontime.sources.csvrows import CsvRows

#: Largest value of the binary column of the ``content`` way.
MAX_CONTENT = (1 << 31) - 1
#: Bytes of archives for each task of the second map, and of a read from storage.
SPLIT_BYTES, READ_BYTES = 64 << 20, 1 << 20
FAULTS = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError, csv.Error, struct.error)
_DIRECT = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs"}

STATUS_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("members", T.IntegerType()),
    T.StructField("csv_members", T.IntegerType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])
#: One row for each CSV member; number -1 stands for an archive without any, or that cannot be opened.
_MEMBERS = ("path string, members int, csv_members int, number int, name string, offset long, packed long, size long, "
            "method int, flags int, crc long, error string")
_MEMBER_SCHEMA = pa.schema([
    ("path", pa.string()), ("members", pa.int32()), ("csv_members", pa.int32()), ("number", pa.int32()), ("name", pa.string()),
    ("offset", pa.int64()), ("packed", pa.int64()), ("size", pa.int64()), ("method", pa.int32()), ("flags", pa.int32()),
    ("crc", pa.int64()), ("error", pa.string())])
_FOUND_SCHEMA = pa.schema([("path", pa.string()), ("members", pa.int32()), ("csv_members", pa.int32()), ("number", pa.int32()),
                           ("rows", pa.int64()), ("error", pa.string())])
_FOUND = "path string, members int, csv_members int, number int, rows long, error string"


def _scheme(path: str) -> str:
    return path.split(":", 1)[0].lower() if ":" in path.split("/", 1)[0] else "file"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's filesystem of a path as Spark gives it, and the path in it."""
    scheme = _scheme(path)
    if scheme == "file":
        local = path[5:] if path.lower().startswith("file:") else path
        return pafs.LocalFileSystem(), "/" + local.lstrip("/") if path != local or path.startswith("/") else local
    _, rest = path.split(":", 1)
    return pafs.FileSystem.from_uri(f"{_DIRECT[scheme]}:{urllib.parse.quote(rest, safe='/@:=')}")


def _open(path: str) -> io.BufferedReader:
    fs, at = filesystem(path)
    return io.BufferedReader(fs.open_input_file(at), READ_BYTES)


def _csv_members(f) -> tuple[int, list[zipfile.ZipInfo]]:
    """(number of members, the CSV members), from the central directory."""
    try:
        with zipfile.ZipFile(f) as archive:
            infos = archive.infolist()
    except pa.ArrowInvalid as e:        # a seek before the start of a file that is too short
        raise zipfile.BadZipFile("File is not a zip file") from e
    return len(infos), [i for i in infos if i.filename.lower().endswith(".csv")]


class MemberStream:
    """The unpacked bytes of a member whose directory entry is known.  Its checksum is tested when all
    has been read, so that a wrong one costs no row."""

    def __init__(self, f, info: zipfile.ZipInfo):
        if info.flag_bits & 0x41:
            raise RuntimeError(f"member {info.filename!r} is encrypted")
        f.seek(info.header_offset)
        header = f.read(30)
        if header[:4] != b"PK\x03\x04":
            raise zipfile.BadZipFile(f"no member begins at byte {info.header_offset}")
        f.seek(info.header_offset + 30 + sum(struct.unpack("<HH", header[26:30])))
        entry = zipfile.ZipInfo(info.filename)
        entry.compress_size, entry.file_size, entry.compress_type = info.compress_size, info.file_size, info.compress_type
        self.stream, self.expected, self.crc = zipfile.ZipExtFile(f, "r", entry), info.CRC, 0

    def read(self, n: int) -> bytes:
        chunk = self.stream.read(n)
        if chunk:
            self.crc = zlib.crc32(chunk, self.crc)
        elif self.crc != self.expected:
            raise zipfile.BadZipFile("bad CRC-32 of a member")
        return chunk


def _member_rows(f, info: zipfile.ZipInfo, columns: Sequence[str], found: dict) -> Iterator[pa.RecordBatch]:
    """The rows of one member; ``found`` gets their number and the error."""
    rows = None
    try:
        rows = CsvRows(MemberStream(f, info).read, columns, FAULTS)
        yield from rows.batches()
    except FAULTS as e:
        found["error"] = f"{type(e).__name__}: {e}"
    if rows is not None:
        found["rows"], found["error"] = rows.rows, found.get("error") or rows.error


class Archive:
    """One archive in memory: ``batches`` yields its rows; the counts and the error grow with it."""

    def __init__(self, content: bytes | None):
        self.content = content
        self.members = self.csv_members = self.rows = 0
        self.error: str | None = None

    def batches(self, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
        if self.content is None:
            return
        f = io.BytesIO(self.content)
        try:
            self.members, infos = _csv_members(f)
        except FAULTS as e:
            self.error = f"{type(e).__name__}: {e}"
            return
        self.csv_members = len(infos)
        for info in infos:
            found: dict = {"rows": 0}
            yield from _member_rows(io.BytesIO(self.content), info, columns, found)
            self.rows += found["rows"]
            self.error = self.error or found.get("error")


def archive_status_of(path: str, content: bytes | None) -> dict:
    archive = Archive(content)
    for _ in archive.batches(["\0"]):       # one absent column: rows are parsed and counted only
        pass
    return {"path": path, "members": archive.members, "csv_members": archive.csv_members, "rows": archive.rows,
            "error": archive.error}


def list_archives(spark: SparkSession, root: str, glob: str = "*.zip",
                  months: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """(path, modificationTime, length, content) of every archive below ``root`` (any depth); content is
    only read if it is selected.  With ``months``, pairs of a year and a month, only the directories
    ``year=<y>/month=<m>`` of these are listed."""
    scan = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if months is None:
        return scan.load(root)
    folders = [f"{root.rstrip('/')}/year={y}/month={m}" for y, m in dict.fromkeys(months)]
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return scan.load(folders)


def members(archives: DataFrame) -> DataFrame:
    """A row for each CSV member of ``archives`` (path): where it lies and how it is packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                blank = dict.fromkeys(_MEMBER_SCHEMA.names) | {"path": path, "members": 0, "csv_members": 0, "number": -1}
                try:
                    with _open(path) as f:
                        n, infos = _csv_members(f)
                except FAULTS as e:
                    out = [blank | {"error": f"{type(e).__name__}: {e}"}]
                else:
                    blank |= {"members": n, "csv_members": len(infos)}
                    out = [blank | {"number": i, "name": m.filename, "offset": m.header_offset, "packed": m.compress_size,
                                    "size": m.file_size, "method": m.compress_type, "flags": m.flag_bits, "crc": m.CRC}
                           for i, m in enumerate(infos)] or [blank]
                yield pa.RecordBatch.from_pylist(out, schema=_MEMBER_SCHEMA)

    return archives.select("path").mapInArrow(run, _MEMBERS)


def _info(row: dict) -> zipfile.ZipInfo:
    info = zipfile.ZipInfo(row["name"])
    info.header_offset, info.compress_size, info.file_size = row["offset"], row["packed"], row["size"]
    info.compress_type, info.flag_bits, info.CRC = row["method"], row["flags"], row["crc"]
    return info


def _leave(found: list[dict], folder: str) -> None:
    """Write what a task found, replacing what an earlier attempt of it wrote."""
    fs, base = filesystem(folder)
    at = f"{base}/part-{TaskContext.get().partitionId():06d}.parquet"
    temporary = f"{base}/_{uuid.uuid4().hex}"
    papq.write_table(pa.Table.from_pylist(found, schema=_FOUND_SCHEMA), temporary, filesystem=fs)
    fs.move(temporary, at)


def _scanned(archives: DataFrame, columns: Sequence[str], status_to: str | None, path_as: str | None,
             status_only: bool = False) -> DataFrame:
    """The rows of ``archives``, or, with ``status_only``, a row of ``_FOUND`` for each member."""
    spark = archives.sparkSession
    cols = list(columns)
    size = archives.agg(F.sum("length").alias("bytes"), F.max("length").alias("largest"), F.first("path").alias("one")).first()
    direct = size["one"] is None or _scheme(size["one"]) in _DIRECT
    if direct:
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil((size["bytes"] or 0) / SPLIT_BYTES))
        units = members(archives).repartition(tasks)
    else:
        if size["largest"] > MAX_CONTENT and not status_only:
            raise ValueError(f"an archive of {size['largest']} bytes is too large for a store that only Spark opens")
        units = archives.select("path", F.when(F.col("length") <= MAX_CONTENT, F.col("content")).alias("content"))

    def rows_of(row: dict, found: list[dict]) -> Iterator[pa.RecordBatch]:
        if direct:
            own = {k: row[k] for k in ("path", "members", "csv_members", "number", "error")} | {"rows": 0}
            if row["number"] >= 0:
                with _open(row["path"]) as f:
                    yield from _member_rows(f, _info(row), cols, own)
        else:
            archive = Archive(row["content"])
            yield from archive.batches(cols)
            own = {"path": row["path"], "members": archive.members, "csv_members": archive.csv_members, "number": 0,
                   "rows": archive.rows, "error": archive.error if row["content"] is not None else "too large to be read"}
        found.append(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for out in rows_of(row, found):
                    if not status_only:
                        yield out.append_column(path_as, pa.array([row["path"]] * out.num_rows, pa.string())) if path_as else out
                if status_only:
                    yield pa.RecordBatch.from_pylist(found, schema=_FOUND_SCHEMA)
                    found.clear()
        if found and status_to:
            _leave(found, status_to)

    if status_only:
        return units.mapInArrow(run, _FOUND)
    names = [*cols, *([path_as] if path_as else [])]
    return units.mapInArrow(run, T.StructType([T.StructField(c, T.StringType(), True) for c in names]))


def scan_archives(archives: DataFrame, columns: Sequence[str] = RAW_COLUMNS, status_to: str | None = None,
                  path_as: str | None = None) -> DataFrame:
    """The rows of all CSV members of ``archives`` (rows of ``list_archives``) as strings.
    ``status_to``: a folder for the status of what is read, emptied first; ``path_as``: the name of a
    further column with the archive's path."""
    if status_to:
        archives.sparkSession.createDataFrame([], _FOUND).write.mode("overwrite").parquet(status_to)
    return _scanned(archives, columns, status_to, path_as)


def read_zip_csv(spark: SparkSession, root: str, columns: Sequence[str] = RAW_COLUMNS, glob: str = "*.zip",
                 months: Sequence[tuple[int, int]] | None = None, status_to: str | None = None) -> DataFrame:
    """All rows of all CSV members of all archives below ``root`` (of some ``months`` only, if given)."""
    return scan_archives(list_archives(spark, root, glob, months), columns, status_to)


def _by_archive(found: DataFrame) -> DataFrame:
    """S3: one row per archive -- member counts, rows read, and the first error met (NULL when all was fine)."""
    return (found.groupBy("path").agg(
        F.max("members").alias("members"), F.max("csv_members").alias("csv_members"), F.sum("rows").alias("rows"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("number"))).alias("error"))
        .select(*STATUS_SCHEMA.fieldNames()))


def read_status(spark: SparkSession, folder: str) -> DataFrame:
    """The status that a scan with ``status_to`` has left, by archive."""
    return _by_archive(spark.read.schema(_FOUND).parquet(folder))


def archive_status(spark: SparkSession, root: str, glob: str = "*.zip",
                   months: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """S3 by itself: reads the archives for their status only."""
    return _by_archive(_scanned(list_archives(spark, root, glob, months), ["\0"], None, None, status_only=True))


def extract_rows(files: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """(content) rows, as a file stream gives them, -> CSV rows as strings."""
    cols = list(columns)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            contents = b.column(b.schema.get_field_index("content"))
            for i in range(b.num_rows):
                yield from Archive(contents[i].as_py()).batches(cols)

    return files.select("content").mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# writer (test bed): Spark rows -> year=Y/month=M/part-<task>.zip, one CSV each
# ---------------------------------------------------------------------------
class _Sink:
    """What ``zipfile`` needs to write to a stream that cannot be sought in."""

    def __init__(self, stream):
        self.write, self.flush = stream.write, stream.flush


class _ArchiveWriter:
    """One archive with one CSV member, written batch by batch under a temporary name and renamed at
    the end: a retried or speculative task replaces the file instead of adding a copy."""

    def __init__(self, fs: pafs.FileSystem, base: str, key: tuple[str, str], tag: str, schema: pa.Schema):
        folder = f"{base}/year={key[0]}/month={key[1]}"
        fs.create_dir(folder, recursive=True)
        self.fs, self.path, self.rows = fs, f"{folder}/part-{tag}.zip", 0
        self.temporary = f"{self.path}.{TaskContext.get().attemptNumber()}.tmp"
        self.stream = fs.open_output_stream(self.temporary)
        self.archive = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        self.member = self.archive.open(f"flights_{key[0]}_{key[1]}_{tag}.csv", "w", force_zip64=True)
        self.csv = pacsv.CSVWriter(pa.PythonFile(self.member, "w"), schema)     # header, then rows; NULL -> empty field

    def add(self, batch: pa.RecordBatch) -> None:
        self.csv.write(batch)
        self.rows += batch.num_rows

    def close(self) -> pa.RecordBatch:
        self.csv.close()
        self.member.close()
        self.archive.close()
        self.stream.close()
        self.fs.move(self.temporary, self.path)
        return pa.RecordBatch.from_pydict({"path": [self.path], "rows": pa.array([self.rows], pa.int64())})


def write_zip_archives(df: DataFrame, root: str, columns: Sequence[str] = RAW_COLUMNS,
                       date_col: str = "FlightDate") -> DataFrame:
    """Write each partition's rows as one archive per (year, month) directory.

    Runs where the rows are (``mapInArrow``, no shuffle): they are sorted by directory within their
    partition, so a task has one archive open and holds one batch of rows, however many rows a
    partition or a directory has.  Files go through pyarrow's
    filesystem layer, so ``root`` may be any URI the cluster's storage understands.
    File names depend only on the input partition, so re-running a lost task is
    idempotent.
    Returns one row per archive written (path, rows) -- lazily; count it to write.
    """
    cols = list(columns)
    out_schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("rows", T.LongType())])
    year = F.coalesce(F.substring(date_col, 1, 4), F.lit(""))
    month = F.coalesce(F.substring(date_col, 6, 2), F.lit(""))
    # the directories' names as Python makes them: 'unknown' or the digits (of the month without leading zeros)
    keyed = df.select(*cols, F.when(year.rlike("^[0-9]{4}$"), year).otherwise("unknown").alias("_y"),
                      F.when(month.rlike("^[0-9]+$"), month.cast("int").cast("string")).otherwise("unknown").alias("_m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        tag, key, writer = f"{TaskContext.get().partitionId():05d}", None, None
        for batch in batches:
            y, m = batch.column("_y").to_pylist(), batch.column("_m").to_pylist()
            cuts = [i for i in range(1, len(y)) if y[i] != y[i - 1] or m[i] != m[i - 1]]
            rows = batch.select(cols)
            for start, end in zip([0, *cuts], [*cuts, len(y)]):
                if start == end:
                    continue
                if key != (y[start], m[start]):
                    if writer is not None:
                        yield writer.close()
                    key = (y[start], m[start])
                    writer = _ArchiveWriter(fs, base, key, tag, rows.schema)
                writer.add(rows.slice(start, end - start))
        if writer is not None:
            yield writer.close()

    return keyed.sortWithinPartitions("_y", "_m").mapInArrow(run, out_schema)
