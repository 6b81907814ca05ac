"""Header template files, any number of them (format ``headers``).

Many small files are the problem here: each is a few hundred bytes. Reading packs them into
splits by size, and a task opens several at once. Writing leaves the files where each task
put them and states them in lists, one for so many files; the commit writes the names of the
lists, so that neither it nor a later reader handles single files on the driver.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage)

from framelake.functions import header
from framelake.functions.header import HEADER_BYTES
from framelake.session import stored
from framelake.sources.recording import resolve

SUFFIX = ".header"
MANIFEST = "_manifest"
# Files stated in one list, and bytes of files read by one task.
LIST_FILES = 2000
SPLIT_BYTES = 16 << 20
# What opening a file counts for.
OPEN_BYTES = 4096
OPEN_THREADS = 16
# Tasks that write files, for each core.
TASKS_PER_CORE = 2
SCHEMA = "path string, key string, header_text string"


@dataclass
class Lists(WriterCommitMessage):
    """Lists written by a task: path, number of files, their bytes."""

    lists: list


class Files(InputPartition):
    """What one task reads: lists of files, or files themselves."""

    def __init__(self, lists: list, files: list):
        super().__init__((lists, files))
        self.lists, self.files = lists, files


def _each(items, work):
    with ThreadPoolExecutor(OPEN_THREADS) as pool:
        yield from pool.map(work, items)


def _packed(items, cost, limit):
    held, used = [], 0
    for item in items:
        if held and used + cost(item) > limit:
            yield held
            held, used = [], 0
        held.append(item)
        used += cost(item)
    if held:
        yield held


class HeaderReader(DataSourceReader):
    """Options: ``path``, ``split_bytes``. A folder without a manifest is listed."""

    def __init__(self, options):
        self.path = options["path"]
        self.limit = int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self):
        system, root = resolve(self.path)
        folder = posixpath.join(root, MANIFEST)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            lists = []
            for info in system.get_file_info(fs.FileSelector(folder)):
                if info.base_name.endswith(".commit"):
                    with system.open_input_stream(info.path) as src:
                        lists += json.loads(src.read())
            parts = _packed(sorted(lists), lambda x: x[2] + x[1] * OPEN_BYTES, self.limit)
            return [Files([x[0] for x in part], []) for part in parts]
        info = system.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(
            fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File
                       and not f.base_name.startswith((".", "_")))
        parts = _packed(files, lambda x: x[1] + OPEN_BYTES, self.limit)
        return [Files([], [x[0] for x in part]) for part in parts]

    def read(self, partition):
        system, root = resolve(self.path)

        def text(path):
            with system.open_input_stream(path) as src:
                # The fixed header size bounds a file; what is padded with zeros ends there.
                return src.read(HEADER_BYTES).rstrip(b"\x00").decode("utf-8", "replace")

        def batch(paths, keys):
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(keys, pa.string()), pa.array(list(_each(paths, text)), pa.string())],
                ["path", "key", "header_text"])

        # Without any file Spark reads one partition that is None.
        for name in getattr(partition, "lists", ()):
            with system.open_input_stream(posixpath.join(root, name)) as src:
                entries = json.loads(src.read())
            folder = posixpath.dirname(name)
            yield batch([posixpath.join(root, folder, f) for f, _ in entries], [k for _, k in entries])
        files = getattr(partition, "files", ())
        for at in range(0, len(files), LIST_FILES):
            paths = files[at:at + LIST_FILES]
            yield batch(paths, [posixpath.basename(p).removesuffix(SUFFIX) for p in paths])


class HeaderWriter(DataSourceArrowWriter):
    """Rows (key, header_text), a file each. Folders are unique for each task attempt; files of
    attempts that were not committed are in no list."""

    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator):
        system, root = resolve(self.path)
        task, lists, entries, size = f"part-{self.job}-{uuid.uuid4().hex}", [], [], 0

        def put(item):
            name, text = item
            with system.open_output_stream(posixpath.join(root, task, name)) as out:
                out.write(text)

        def finish():
            nonlocal entries, size
            name = f"{task}/_list-{len(lists):06d}"
            with system.open_output_stream(posixpath.join(root, name)) as out:
                out.write(json.dumps(entries).encode())
            lists.append((name, len(entries), size))
            entries, size = [], 0

        begun = 0
        for batch in iterator:
            keys, texts = batch.column("key").cast(pa.string()).to_pylist(), batch.column("header_text").to_pylist()
            for at in range(0, len(keys), LIST_FILES):
                some = [(f"{begun + i:08d}{SUFFIX}", k, (t or "").encode())
                        for i, (k, t) in enumerate(zip(keys[at:at + LIST_FILES], texts[at:at + LIST_FILES]))]
                if any(len(t) > HEADER_BYTES for _, _, t in some):
                    raise ValueError(f"a header of more than {HEADER_BYTES} bytes")
                if not begun:
                    system.create_dir(posixpath.join(root, task), recursive=True)
                begun += len(some)
                list(_each([(n, t) for n, _, t in some], put))
                entries += [(n, k) for n, k, _ in some]
                size += sum(len(t) for _, _, t in some)
                if len(entries) >= LIST_FILES:
                    finish()
        if entries:
            finish()
        return Lists(lists)

    def commit(self, messages):
        system, root = resolve(self.path)
        folder = posixpath.join(root, MANIFEST)
        system.create_dir(folder, recursive=True)
        before = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.base_name.endswith(".commit")]
        staged = posixpath.join(folder, f"_{self.job}")
        with system.open_output_stream(staged) as out:
            out.write(json.dumps([x for m in messages if m is not None for x in m.lists]).encode())
        system.move(staged, posixpath.join(folder, f"{self.job}.commit"))
        if self.overwrite:
            for path in before:
                system.delete_file(path)

    def abort(self, messages):
        system, root = resolve(self.path)
        if system.get_file_info(root).type != fs.FileType.Directory:
            return
        for info in system.get_file_info(fs.FileSelector(root)):
            if info.base_name.startswith(f"part-{self.job}-"):
                system.delete_dir(info.path)


class HeaderSource(DataSource):
    @classmethod
    def name(cls):
        return "headers"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return HeaderReader(dict(self.options))

    def writer(self, schema, overwrite):
        return HeaderWriter(dict(self.options), overwrite)


def read_text(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per file: ``path``, ``key`` (what it was written under, else its name) and
    the whole ``header_text``."""
    spark.dataSource.register(HeaderSource)
    return spark.read.format("headers").option("path", path).option("split_bytes", split_bytes).load()


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Parsed headers, and the rejects with the reason they were refused. The files are opened
    once: their texts are stored, for both tables."""
    checked = header.validate(stored(read_text(spark, path), "headers"))
    good = header.parse(checked.filter("ok").select("path", "key", "header_text"))
    return good, checked.filter("not ok")


def write_files(texts: DataFrame, path: str, key: str, mode: str = "append") -> None:
    """Write header texts (``key``, ``header_text``) as text files below ``path``, one a row. Rows
    are dealt out evenly: a file costs far more than moving its text, and a small table that
    lies in one partition is very many files."""
    spark = texts.sparkSession
    spark.dataSource.register(HeaderSource)
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (texts.select(F.col(key).cast("string").alias("key"), "header_text").repartition(tasks)
     .write.format("headers").option("path", path).mode(mode).save())


def write_text(headers: DataFrame, path: str, key: str, mode: str = "append") -> None:
    """Write typed headers as files with version lines. A header with a null among the
    required columns is an error, as its text would be."""
    text = F.coalesce(header.render(with_version=True), F.raise_error(F.lit("a header lacks a required value")))
    write_files(headers.select(key, text.alias("header_text")), path, key, mode)
