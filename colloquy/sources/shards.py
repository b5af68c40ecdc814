"""Shards of samples: gzipped tar archives whose members are named ``<key>.<extension>``.

``spark.read.format("shards")`` has one partition per archive, read as a stream, member by member: an archive may be far
larger than memory or a binary column. Options: ``tolerant`` (default true), and ``content``:

- ``samples``: path, pos, key, meta, audio, diarization, diarization_error;
- ``meta``: the same columns, of which only key and meta are read, other members being skipped;
- ``members``: path, pos, name, data.

Consecutive members with the same key, all up to the first dot of the member's path, are one sample; a key that comes
again later begins another. Of members with the same extension the last wins. What is no file, or has no dot, is skipped.
Tolerant: a member that can't be read ends the archive, and what its sample has so far is kept; a fault between members
ends it too, and the sample then open is lost. Otherwise either raises.

``df.write.format("shards")`` writes columns key, meta, audio, diarization, diarization_error (strings, audio binary):
meta always, the rest where not null (audio: nor empty). Archives roll over at ``max_bytes`` of content, and get numbers
NNNNNN.tar.gz after those already there when the job commits; a failed task leaves nothing.
"""

from __future__ import annotations

import contextlib
import gzip
import io
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SAMPLES = "path string, pos int, key string, meta string, audio binary, diarization string, diarization_error string"
MEMBERS = "path string, pos int, name string, data binary"
#: The members of a sample, by column.
EXTENSIONS = {"meta": "meta.json", "audio": "audio.mp3", "diarization": "diarization.json", "diarization_error": "diarization_error.json"}
FAULTS = (EOFError, OSError, tarfile.TarError, ValueError)


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system a path is on, and its path there; ``file:`` with any number of slashes is this machine's."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def list_shards(folder: str) -> list[str]:
    """All archives below the folder, or the one named, in order of path; that order says which of two copies is first."""
    system, path = place_of(folder)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [folder]
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    prefix = folder.split("://")[0] + "://" if "://" in folder and not folder.startswith("file:") else ""
    return sorted(prefix + f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".tar.gz"))


def _open(path: str):
    system, inner = place_of(path)
    return system.open_input_stream(inner, compression=None)


class Fault(Exception):
    """A member couldn't be read (inside) or found."""

    def __init__(self, inside: bool, why: str) -> None:
        super().__init__(why)
        self.inside = inside


def members(path: str, wanted=lambda name: True) -> Iterator[tuple[str, bytes]]:
    """(name, content) of the archive's files; raises Fault where it breaks off."""
    try:
        with _open(path) as raw, gzip.GzipFile(fileobj=raw) as gz, tarfile.open(fileobj=gz, mode="r|") as tar:
            for member in tar:
                if not member.isfile() or not wanted(member.name):
                    continue
                try:
                    content = tar.extractfile(member).read()
                    if len(content) < member.size:
                        raise EOFError("member cut off")
                except FAULTS as e:
                    raise Fault(True, f"{path}: {e}") from e
                yield member.name, content
    except FAULTS as e:
        raise Fault(False, f"{path}: {e}") from e


def samples(path: str, tolerant: bool, meta_only: bool) -> Iterator[tuple[str, dict[str, bytes]]]:
    key, parts, keep = None, {}, True
    try:
        for name, content in members(path, (lambda n: n.endswith(".meta.json")) if meta_only else lambda n: "." in n):
            own, _, extension = name.partition(".")
            if own != key:
                if parts:
                    yield key, parts
                key, parts = own, {}
            parts[extension] = content
    except Fault as e:
        if not tolerant:
            raise
        keep = e.inside
    if parts and keep:
        yield key, parts


class ShardPartition(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class ShardReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.content = options["path"], options.get("content", "samples")
        self.tolerant = str(options.get("tolerant", "true")).lower() == "true"

    def partitions(self) -> list[ShardPartition]:
        return [ShardPartition(p) for p in list_shards(self.folder)] or [ShardPartition("")]

    def read(self, partition: ShardPartition) -> Iterator[tuple]:
        path = partition.path
        if not path:
            return
        if self.content == "members":
            try:
                for pos, (name, content) in enumerate(members(path)):
                    yield path, pos, name, content
            except Fault:
                if not self.tolerant:
                    raise
            return
        for pos, (key, parts) in enumerate(samples(path, self.tolerant, self.content == "meta")):
            text = lambda x: parts[x].decode("utf-8", "replace") if x in parts else None  # noqa: B023, E731
            yield path, pos, key, text("meta.json"), parts.get("audio.mp3"), text("diarization.json"), text("diarization_error.json")


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class ShardWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.folder, self.overwrite = options["path"], overwrite
        self.max_bytes = int(options.get("max_bytes", 3 * 1024**3))

    def _system(self) -> tuple[fs.FileSystem, str]:
        system, path = place_of(self.folder)
        system.create_dir(path, recursive=True)
        return system, path

    def write(self, iterator: Iterator) -> Written:
        system, path = self._system()
        names: list[str] = []
        with contextlib.ExitStack() as stack:
            size, tar = self.max_bytes, None
            for row in iterator:
                if size >= self.max_bytes:
                    stack.close()
                    names.append(f"{path}/_{uuid.uuid4().hex}.tmp")
                    gz = stack.enter_context(gzip.GzipFile(fileobj=stack.enter_context(system.open_output_stream(names[-1], compression=None)), mode="wb", compresslevel=6))
                    tar, size = stack.enter_context(tarfile.open(fileobj=gz, mode="w|")), 0
                for column, extension in EXTENSIONS.items():
                    content = row[column] if column in row else None
                    if content is None and column == "meta":
                        content = "{}"
                    if content is None or column == "audio" and not content:
                        continue
                    content = content.encode() if isinstance(content, str) else bytes(content)
                    info = tarfile.TarInfo(f"{row['key']}.{extension}")
                    info.size = len(content)
                    tar.addfile(info, io.BytesIO(content))
                    size += len(content)
        return Written(names)

    def commit(self, messages: list) -> None:
        system, path = self._system()
        there = [f for f in system.get_file_info(fs.FileSelector(path)) if f.base_name.endswith(".tar.gz")]
        if self.overwrite:
            for f in there:
                system.delete_file(f.path)
            there = []
        numbers = [int(f.base_name[:-7]) for f in there if f.base_name[:-7].isdigit()]
        for n, name in enumerate((x for m in messages if m for x in m.names), start=max(numbers, default=-1) + 1):
            system.move(name, f"{path}/{n:06d}.tar.gz")

    def abort(self, messages: list) -> None:
        system, _ = self._system()
        for name in (x for m in messages if m for x in m.names):
            with contextlib.suppress(OSError):
                system.delete_file(name)


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> str:
        return MEMBERS if self.options.get("content") == "members" else SAMPLES

    def reader(self, schema) -> ShardReader:
        return ShardReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShardSource)


def read_shards(spark: SparkSession, folder: str, content: str = "samples", tolerant: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("shards").option("content", content).option("tolerant", str(tolerant).lower()).load(folder)


def write_shards(rows: DataFrame, folder: str, writers: int | None = None, max_bytes: int = 3 * 1024**3, mode: str = "append") -> None:
    """``writers``: rows are dealt round robin to so many tasks; None: as they are partitioned."""
    register(rows.sparkSession)
    rows = rows.repartition(writers) if writers else rows
    rows.write.format("shards").option("max_bytes", str(max_bytes)).mode(mode).save(folder)


def repair_shards(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Rewrites each archive below ``target`` with the members that can be read, as a stream. Rows: path, n_files,
    truncated. An archive without any is not written."""
    paths = list_shards(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_repair(p, folder, target) for p in b.column("path").to_pylist()]
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.bool_()))], ["path", "n_files", "truncated"])

    table = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return table.mapInArrow(run, "path string, n_files bigint, truncated boolean")


def _repair(path: str, folder: str, target: str) -> tuple[str, int, bool]:
    # paths of a listing and the folder may name the same place in two ways
    out = target.rstrip("/") + "/" + place_of(path)[1][len(place_of(folder)[1].rstrip("/")) + 1 :]
    system, inner = place_of(out)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    n, broken = 0, False
    with system.open_output_stream(inner, compression=None) as raw, gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=6) as gz, tarfile.open(fileobj=gz, mode="w|") as tar:
        try:
            for name, content in members(path):
                info = tarfile.TarInfo(name)
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
                n += 1
        except Fault:
            broken = True
    if not n:
        system.delete_file(inner)
    return path, n, broken


def assemble(rows: DataFrame, group: str, position: str, name: str, data: str) -> DataFrame:
    """Samples of members that lie as rows: consecutive rows of a ``group`` with the same key, in order of ``position``, are
    one sample; of the same extension the last wins. Result: group, run_no, key, members (map)."""
    from pyspark.sql import Window as W

    dot = F.instr(name, ".")
    keyed = rows.where(dot > 0).withColumn("__key", F.substr(name, F.lit(1), dot - 1)).withColumn("__ext", F.substr(name, dot + 1))
    order = W.partitionBy(group).orderBy(position)
    new = F.when(F.lag("__key").over(order).eqNullSafe(F.col("__key")), 0).otherwise(1)
    runs = keyed.withColumn("__new", new).withColumn("run_no", F.sum("__new").over(order) - 1)
    last = runs.groupBy(group, "run_no", F.col("__key").alias("key"), "__ext").agg(F.max_by(data, position).alias("__data"))
    return last.groupBy(group, "run_no", "key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__ext", "__data")))).alias("members"))
