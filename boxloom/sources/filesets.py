"""Python data sources for what is read or written file by file: sets of files, single lists, fetched addresses.

Writers write into a folder of their own below the target. Each task tells the driver, in its commit message,
where it has listed what it wrote; only the job's commit moves the files to their places, an abort deletes the
folder. So a job that fails leaves nothing, a task that runs twice counts once, and a reader of the target sees
a file as a whole or not at all. Workers reach the target through pyarrow's file systems.

    filesets   rows (name, content binary[, source string]): a file each; a null content is copied from the
               source, or linked to it with option ``link`` where both are local
    linefile   rows (line): one text file, the partitions' lines in their order; sorted rows give a sorted file
    listed     a folder: (path, name, size) of its files, by one task; Spark's own readers leave out empty files
    fetched    a list of addresses, a line each, in partitions of byte ranges: (url, status, error, content)
"""

from __future__ import annotations

import importlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from boxloom.sources.external import with_retries

COPY_BYTES = 1 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI, on the session's file system if it names none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub(r"^file:/+", "file:///", at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString())


def reachable(spark: SparkSession, path: str) -> str:
    """``path`` as a URI that all workers reach; refuses a local one unless the master is local."""
    uri = qualified(spark, path)
    if uri.startswith("file:") and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"{path} is a local folder of each worker of {spark.sparkContext.master}")
    return uri


def store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{os.path.abspath(uri)}")


def _copy(source: str, to: fs.FileSystem, at: str) -> int:
    there, path = store(re.sub(r"^file:/+", "file:///", source))
    n = 0
    with there.open_input_stream(path) as a, to.open_output_stream(at) as b:
        while piece := a.read(COPY_BYTES):
            b.write(piece)
            n += len(piece)
    return n


def _move(at: fs.FileSystem, source: str, to: str) -> None:
    if not isinstance(at, fs.LocalFileSystem) and at.get_file_info(to).type != fs.FileType.NotFound:
        at.delete_file(to)  # a local move replaces; others refuse
    at.move(source, to)


@dataclass
class Written(WriterCommitMessage):
    """A task's commit message: where its list lies, and how much it wrote."""

    part: int
    listed: str | None
    files: int
    size: int


class _Staged(DataSourceArrowWriter):
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("save() needs a path")
        self.root = options["path"].rstrip("/")
        self.staging = f".staging-{uuid.uuid4().hex}"
        self.link = options.get("link", "false") == "true"

    def _own(self, at: fs.FileSystem, base: str) -> tuple[int, str]:
        task = TaskContext.get()
        folder = f"{base}/{self.staging}/{task.partitionId():06d}-{task.taskAttemptId()}"
        at.create_dir(folder, recursive=True)
        return task.partitionId(), folder

    def abort(self, messages) -> None:
        at, base = store(self.root)
        if at.get_file_info(f"{base}/{self.staging}").type == fs.FileType.Directory:
            at.delete_dir(f"{base}/{self.staging}")


class FileSetWriter(_Staged):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        at, base = store(self.root)
        part, folder = self._own(at, base)
        n = size = 0
        listed = f"{folder}/list"
        with at.open_output_stream(listed) as names:
            for batch in iterator:
                columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
                for i, name in enumerate(columns["name"]):
                    if name is None or name.startswith("/") or ".." in name.split("/"):
                        raise ValueError(f"{name!r} does not lie below {self.root}")
                    staged, content = f"{folder}/{n}", columns["content"][i]
                    source = columns["source"][i] if "source" in columns else None
                    if content is None and source and self.link and isinstance(at, fs.LocalFileSystem):
                        os.symlink(store(re.sub(r"^file:/+", "file:///", source))[1], staged)
                    elif content is None and source:
                        size += _copy(source, at, staged)
                    else:
                        content = b"" if content is None else content.encode() if isinstance(content, str) else content
                        with at.open_output_stream(staged) as out:
                            out.write(content)
                        size += len(content)
                    names.write(json.dumps([staged, name]).encode() + b"\n")
                    n += 1
        return Written(part, listed, n, size)

    def commit(self, messages: list[Written | None]) -> None:
        at, base = store(self.root)
        made: set[str] = set()
        for m in messages:
            if m is None or not m.files:
                continue
            with at.open_input_stream(m.listed) as listed:
                rest = b""
                while piece := listed.read(COPY_BYTES):
                    *lines, rest = (rest + piece).split(b"\n")
                    for line in lines:
                        staged, name = json.loads(line)
                        folder = f"{base}/{name}".rsplit("/", 1)[0]
                        if folder not in made:
                            at.create_dir(folder, recursive=True)
                            made.add(folder)
                        _move(at, staged, f"{base}/{name}")
        self.abort(messages)


class LineFileWriter(_Staged):
    def __init__(self, options: dict):
        super().__init__(options)
        self.root, _, self.name = self.root.rpartition("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        at, base = store(self.root)
        part, folder = self._own(at, base)
        n = size = 0
        with at.open_output_stream(f"{folder}/lines") as out:
            for batch in iterator:
                data = "".join(f"{line}\n" for line in batch.column("line").to_pylist() if line is not None).encode()
                out.write(data)
                n, size = n + batch.num_rows, size + len(data)
        return Written(part, f"{folder}/lines", n, size)

    def commit(self, messages: list[Written | None]) -> None:
        at, base = store(self.root)
        at.create_dir(f"{base}/{self.staging}", recursive=True)
        with at.open_output_stream(f"{base}/{self.staging}/all") as out:
            for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
                with at.open_input_stream(m.listed) as part:
                    while piece := part.read(COPY_BYTES):
                        out.write(piece)
        _move(at, f"{base}/{self.staging}/all", f"{base}/{self.name}")
        self.abort(messages)


class FileSets(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filesets"

    def writer(self, schema, overwrite: bool) -> FileSetWriter:
        if not {"name", "content"} <= set(schema.fieldNames()):
            raise ValueError("rows (name, content) are needed")
        return FileSetWriter(dict(self.options))


class LineFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "linefile"

    def writer(self, schema, overwrite: bool) -> LineFileWriter:
        if schema.fieldNames() != ["line"]:
            raise ValueError("rows (line) are needed")
        return LineFileWriter(dict(self.options))


@dataclass
class Range(InputPartition):
    begin: int
    end: int


class FetchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.client = options["urls"], options["client"]
        self.parts, self.tries, self.wait = int(options.get("partitions", 32)), int(options.get("tries", 3)), float(options.get("wait", 1.0))

    def partitions(self) -> list[Range]:
        at, path = store(self.path)
        size = at.get_file_info(path).size
        edges = sorted({size * k // self.parts for k in range(self.parts + 1)})
        return [Range(a, b) for a, b in zip(edges, edges[1:])] or [Range(0, 0)]

    def _lines(self, part: Range) -> Iterator[str]:
        """The lines that begin in the range."""
        at, path = store(self.path)
        with at.open_input_file(path) as f:
            place = max(0, part.begin - 1)
            f.seek(place)
            rest, skip = b"", part.begin > 0
            while place < part.end:
                piece = f.read(1 << 16)
                rest += piece
                while place < part.end and (b"\n" in rest or not piece and rest):
                    line, _, rest = rest.partition(b"\n")
                    if not skip:
                        yield line.decode(errors="replace")
                    skip = False
                    place += len(line) + 1
                if not piece:
                    return

    def read(self, partition: Range) -> Iterator[tuple]:
        module, _, name = self.client.partition(":")
        client = getattr(importlib.import_module(module), name)()
        for line in self._lines(partition):
            url = line.strip()
            if not url.startswith("http"):
                continue
            body, error = with_retries(lambda: client(url), self.tries, self.wait)  # noqa: B023  called at once
            if error is None and not body:
                error = "empty body"
            yield url, "error" if error else "ok", error, None if error else bytes(body)


class Fetched(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fetched"

    def schema(self) -> str:
        return "url string, status string, error string, content binary"

    def reader(self, schema) -> FetchReader:
        return FetchReader(dict(self.options))


class ListReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.recursive = options["path"], options.get("recursive", "false") == "true"

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at, path = store(self.path)
        for info in at.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=self.recursive)):
            if info.type == fs.FileType.File:
                yield info.path, info.base_name, info.size


class Listed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listed"

    def schema(self) -> str:
        return "path string, name string, size long"

    def reader(self, schema) -> ListReader:
        return ListReader(dict(self.options))


def listed(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(path, name, size) of all files of a folder; none if there is no such folder."""
    register(spark)
    return spark.read.format("listed").option("recursive", str(recursive).lower()).load(qualified(spark, folder))


def register(spark: SparkSession) -> None:
    """Makes the formats of this module known to the session."""
    for source in (FileSets, LineFile, Fetched, Listed):
        spark.dataSource.register(source)
