"""Stores of files as a Spark data source and sink: books of a folder, of any file system that Arrow opens, or of a class of the user's.

    register(spark)
    spark.read.format("store").option("root", "file:///books").load().filter("book_name = 'x' and extension = 'md'")

The driver lists the folders of the first level alone; each partition lists its books, and filters on book, stage and extension leave out books and files
before anything is read. A write stages the files of each task aside and moves them when all tasks are done, so a failed write leaves the store as it was.
write() moves them by tasks; the sink alone has no tasks left by then, and the driver moves them.
"""

from __future__ import annotations

import importlib
import os
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from quire.sources.shared import computed

LISTED = "path string, book_name string, stage string, file string, stem string, extension string, bytes long, modified timestamp"
STAGING = "_staging"
PARTITIONS = 64
MOVES_AT_ONCE = 16


@dataclass
class Entry:
    path: str  # below the root
    bytes: int
    modified: datetime


class FolderStore:
    """A folder of any file system that Arrow opens: a local path or a URI. Other stores have these methods, and take the reader's options."""

    def __init__(self, options: dict[str, str]) -> None:
        root = options["root"]
        if "://" in root or root.startswith("file:"):
            self.fs, self.root = pafs.FileSystem.from_uri(root)
        else:
            self.fs, self.root = pafs.LocalFileSystem(), os.path.abspath(root)
        self.made: set[str] = set()  # folders that this object has made

    def at(self, path: str) -> str:
        return posixpath.join(self.root, path) if path else self.root

    def folders(self) -> list[str]:
        """The folders of the first level."""
        found = self.fs.get_file_info(pafs.FileSelector(self.root, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == pafs.FileType.Directory)

    def files(self, folder: str, deep: bool = True) -> Iterator[Entry]:
        found = self.fs.get_file_info(pafs.FileSelector(self.at(folder), recursive=deep, allow_not_found=True))
        top = self.root.rstrip("/") + "/"
        for f in sorted((f for f in found if f.type == pafs.FileType.File), key=lambda f: f.path):
            path = f.path[len(top) :] if f.path.startswith(top) else posixpath.relpath(f.path, self.root)
            yield Entry(path, f.size, f.mtime or datetime.fromtimestamp(0, timezone.utc))

    def get(self, path: str) -> bytes:
        with self.fs.open_input_stream(self.at(path)) as stream:
            return stream.read()

    def has(self, path: str) -> bool:
        return self.fs.get_file_info(self.at(path)).type == pafs.FileType.File

    def put(self, path: str, content: bytes) -> None:
        self.make_folder(path)
        with self.fs.open_output_stream(self.at(path)) as stream:
            stream.write(content)

    def make_folder(self, path: str) -> None:
        """Makes the folder of a file."""
        folder = posixpath.dirname(self.at(path))
        if folder not in self.made:
            self.fs.create_dir(folder, recursive=True)
            self.made.add(folder)

    def move(self, source: str, target: str) -> None:
        self.make_folder(target)
        if self.has(target):
            self.remove(target)
        self.fs.move(self.at(source), self.at(target))

    def remove(self, path: str) -> None:
        self.fs.delete_file(self.at(path))

    def remove_folder(self, path: str) -> None:
        if self.fs.get_file_info(self.at(path)).type == pafs.FileType.Directory:
            self.fs.delete_dir(self.at(path))


def opened(options: dict[str, str]):
    """The store that the options name: class, as module:Class, or a folder."""
    name = options.get("class")
    if not name:
        return FolderStore(options)
    module, _, kind = name.partition(":")
    return getattr(importlib.import_module(module), kind)(options)


def parts(path: str) -> tuple[str | None, str | None, str, str, str]:
    """(book, stage, file, stem, extension) of book/stage/.../file; files further up have no book or no stage."""
    folders, file = path.split("/")[:-1], path.rsplit("/", 1)[-1]
    stem, dot, extension = file.rpartition(".")
    if not dot or not stem:
        stem, extension = file, ""
    return folders[0] if folders else None, folders[1] if len(folders) > 1 else None, file, stem, extension.lower()


@dataclass
class Part(InputPartition):
    folders: list[str]
    top: bool  # whether files beside the folders belong to it


class StoreReader(DataSourceReader):
    FILTERED = ("path", "book_name", "stage", "file", "stem", "extension")

    def __init__(self, options: dict[str, str], content: bool) -> None:
        self.options, self.content = options, content
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            known = isinstance(f, (EqualTo, In, StringStartsWith, StringEndsWith, IsNotNull)) and len(f.attribute) == 1 and f.attribute[0] in self.FILTERED
            if known:
                self.filters.append(f)
            else:
                yield f

    def fits(self, known: dict[str, str | None]) -> bool:
        """Whether the filters on the columns known so far hold."""
        for f in self.filters:
            name = f.attribute[0]
            if name not in known:
                continue
            value = known[name]
            if value is None:
                return False
            if isinstance(f, EqualTo) and value != f.value or isinstance(f, In) and value not in f.value:
                return False
            if isinstance(f, StringStartsWith) and not value.startswith(f.value) or isinstance(f, StringEndsWith) and not value.endswith(f.value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        folders = [f for f in opened(self.options).folders() if not f.startswith((".", "_")) and self.fits({"book_name": f})]
        n = max(1, min(int(self.options.get("partitions", PARTITIONS)), len(folders)))
        return [Part(folders[i::n], i == 0 and self.fits({"book_name": None})) for i in range(n)]

    def read(self, partition: Part) -> Iterator[tuple]:
        store = opened(self.options)
        for folder in [*([""] if partition.top else []), *partition.folders]:
            for entry in store.files(folder, deep=bool(folder)):
                book, stage, file, stem, extension = parts(entry.path)
                row = {"path": entry.path, "book_name": book, "stage": stage, "file": file, "stem": stem, "extension": extension}
                if self.fits(row):
                    yield (*row.values(), entry.bytes, entry.modified, *([store.get(entry.path)] if self.content else []))


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int


def stage(store, folder: str, path: str | None, content: bytes | None) -> None:
    """Puts a file below a folder of staged ones."""
    if path is None or content is None or posixpath.normpath(path) != path or path.startswith(("/", "../", "_", ".")):
        raise ValueError(f"a row without content, or a path that is no path below the root: {path!r}")
    store.put(f"{folder}/{path}", bytes(content))


class StoreWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool) -> None:
        if not {"path", "content"} <= set(schema.names):
            raise ValueError("rows to store need the columns path and content")
        self.options, self.overwrite, self.run = options, overwrite, f"{STAGING}/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        """Each attempt of a task has a folder of its own, so that one that is repeated or lost is never mixed with another."""
        store, folder, seen = opened(self.options), f"{self.run}/{uuid.uuid4().hex}", 0
        for row in iterator:
            stage(store, folder, row.path, row.content)
            seen += 1
        return Staged(folder, seen)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Moves the staged files, of which only names are looked at; a path that came twice fails the write before anything is moved."""
        store = opened(self.options)
        moves: dict[str, str] = {}
        for message in messages:
            found = 0
            for entry in store.files(message.folder) if message else ():
                target = posixpath.relpath(entry.path, message.folder)
                if target in moves:
                    raise ValueError(f"two rows have the path {target}")
                moves[target], found = entry.path, found + 1
            if message and found != message.files:
                raise ValueError("two rows of a task have one path, or staged files are missing")
        old = [e.path for f in store.folders() if not f.startswith((".", "_")) for e in store.files(f)] if self.overwrite else []
        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            list(pool.map(lambda m: store.move(m[1], m[0]), moves.items()))
            list(pool.map(store.remove, [p for p in old if p not in moves]))
        store.remove_folder(self.run)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Removes what was staged. A task that is still being stopped may stage more, which no reader sees and tidied() removes."""
        opened(self.options).remove_folder(self.run)


class StoreSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "store"

    @property
    def content(self) -> bool:
        return self.options.get("content", "true").lower() != "false"

    def schema(self) -> str:
        return LISTED + (", content binary" if self.content else "")

    def reader(self, schema: StructType) -> DataSourceReader:
        return StoreReader(dict(self.options), self.content)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return StoreWriter(dict(self.options), schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StoreSource)


def located(root: str, options: dict[str, str] | None) -> dict[str, str]:
    return {"root": root, **(options or {})}


def listing(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """(path, book_name, stage, file, stem, extension, bytes, modified) of the files of a store; none of them is opened. The extension is in lower case."""
    register(spark)
    return spark.read.format("store").options(**located(root, options), content="false").load()


def contents(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """A listing with the files' contents, each read where its book is listed."""
    register(spark)
    return spark.read.format("store").options(**located(root, options)).load()


def fetched(listed: DataFrame, root: str, partitions: int = PARTITIONS, **options: str) -> DataFrame:
    """listed with content, the files dealt out by path first, so that a book with most of the files is read by many tasks."""
    given, names = located(root, options), listed.columns
    schema = StructType([*listed.schema.fields, *StructType.fromDDL("content binary").fields])

    def run(batches):
        import pyarrow as pa

        store = opened(given)
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                path = one.column(names.index("path"))[0].as_py()
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([store.get(path)], pa.binary())], names=[*names, "content"])

    return listed.repartition(partitions, "path").mapInArrow(run, schema)


def write(files: DataFrame, root: str, overwrite: bool = False, **options: str) -> None:
    """Stores files (path, content): all of them or, if a task fails for good or two rows have one path, none. Files of the same paths are replaced; with
    overwrite all others go."""
    given, run = located(root, options), f"{STAGING}/{uuid.uuid4().hex}"

    def staged(batches):
        """(path, staged): each attempt of a task has a folder of its own, so that one that is repeated or lost is never mixed with another."""
        import pyarrow as pa

        store, folder = opened(given), f"{run}/{uuid.uuid4().hex}"
        for batch in batches:
            paths, contents = batch.column(0), batch.column(1)
            for at in range(batch.num_rows):
                stage(store, folder, paths[at].as_py(), contents[at].as_py())
            yield pa.RecordBatch.from_arrays([paths, pa.array([f"{folder}/{p}" for p in paths.to_pylist()], pa.string())], names=["path", "staged"])

    def moved(batches):
        store = opened(given)
        for batch in batches:
            for target, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if store.has(source):
                    store.move(source, target)
                elif not store.has(target):  # an attempt before this one may have moved it
                    raise FileNotFoundError(f"a staged file is missing: {source}")
            yield batch

    def removed(batches):
        store = opened(given)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if store.has(path):
                    store.remove(path)
            yield batch

    try:
        names = computed(files.select("path", "content").mapInArrow(staged, "path string, staged string"))
        twice = names.groupBy("path").count().filter("count > 1").first()
        if twice:
            raise ValueError(f"two rows have the path {twice.path}")
        names.repartition(PARTITIONS, "path").mapInArrow(moved, names.schema).count()
        if overwrite:
            old = listing(files.sparkSession, root, **options).filter("book_name is not null").select("path")
            missing(old, names).mapInArrow(removed, old.schema).count()
    finally:
        opened(given).remove_folder(run)


def copied(spark: SparkSession, source: dict[str, str], target: dict[str, str], only: Column | None = None) -> None:
    """Files of one store written to another: source and target are the options of each, root among them."""
    register(spark)
    found = spark.read.format("store").options(**source).load()
    write(found.filter(only) if only is not None else found, **target)


def saved(files: DataFrame, cache: str, remote: dict[str, str] | None = None) -> None:
    """Stores files in the cache folder and, if one is given, in the remote store, which gets what the cache holds."""
    write(files, cache)
    if remote:
        written = files.select("path")
        held = listing(files.sparkSession, cache).join(written, "path", "left_semi")
        write(fetched(held, cache), **remote)


def tidied(root: str, older: float = 86_400.0, **options: str) -> int:
    """Removes staged files of writes that never ended, if the last one is older than so many seconds, and says how many writes that were."""
    store, newest = opened(located(root, options)), {}
    for entry in store.files(STAGING):
        run = entry.path.split("/")[1]
        newest[run] = max(newest.get(run, entry.modified), entry.modified)
    gone = [run for run, at in newest.items() if (datetime.now(timezone.utc) - at).total_seconds() > older]
    for run in gone:
        store.remove_folder(f"{STAGING}/{run}")
    return len(gone)


def missing(wanted: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of wanted whose path no file of the listing has."""
    return wanted.join(listed.select("path"), "path", "left_anti")


def as_files(df: DataFrame, stage: str, text: str = "text") -> DataFrame:
    """(path, content) of rows (book_name, file, text): book/stage/file in UTF-8."""
    return df.select(F.concat_ws("/", "book_name", F.lit(stage), "file").alias("path"), F.encode(F.col(text), "UTF-8").alias("content"))
