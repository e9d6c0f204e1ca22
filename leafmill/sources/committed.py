"""A Spark data source that writes one file per row and shows none of them before the whole write has succeeded.

A task puts its files into a staging folder of its own attempt, and says where. Only when
every task has succeeded are the files of the attempts that count renamed to their names;
what a failed attempt or an aborted write has staged is deleted unseen.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from leafmill.runtime import ship_package

NAME = "leafmill_files"
#: In a task's folder, the names of the files that go.
GONE = "_gone"
#: Renames under way at once.
THREADS = 16


def open_folder(folder: str):
    """(file system, path) of a folder by path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


@dataclass
class Staged(WriterCommitMessage):
    """Where a task's files are, and how many."""

    attempt: str
    files: int


class CommittedWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.staging = folder, f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Staged:
        """Stage rows (name, body); a null body asks for the file of that name to go."""
        from pyspark import TaskContext

        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}"
        store, path = open_folder(self.folder)
        own, files, gone = f"{path}/{self.staging}/{attempt}", 0, []
        store.create_dir(own, recursive=True)
        for row in iterator:
            if row.body is None:
                gone.append(row.name)
                continue
            with store.open_output_stream(f"{own}/{row.name}") as sink:
                sink.write(row.body.encode())
            files += 1
        if gone:
            with store.open_output_stream(f"{own}/{GONE}") as sink:
                sink.write("\n".join(gone).encode())
        return Staged(attempt, files)

    def commit(self, messages: list[Staged | None]) -> None:
        from pyarrow import fs

        store, path = open_folder(self.folder)

        def show(name: str, at: str) -> None:
            store.move(at, f"{path}/{name}")

        def drop(name: str) -> None:
            if store.get_file_info(f"{path}/{name}").type == fs.FileType.File:
                store.delete_file(f"{path}/{name}")

        with ThreadPoolExecutor(THREADS) as pool:
            for message in filter(None, messages):  # a task's files at a time
                held = store.get_file_info(fs.FileSelector(f"{path}/{self.staging}/{message.attempt}", allow_not_found=True))
                done = [pool.submit(show, f.base_name, f.path) for f in held if f.base_name != GONE]
                for f in held:
                    if f.base_name == GONE:
                        names = store.open_input_stream(f.path).read().decode().split("\n")
                        done += [pool.submit(drop, name) for name in names]
                for one in done:
                    one.result()
        self._clean(store, path)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clean(*open_folder(self.folder))

    def _clean(self, store, path: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{path}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/{self.staging}")


class CommittedFiles(DataSource):
    """``rows.write.format("leafmill_files").option("path", folder)``: rows (name, body) as files of a shared folder."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return CommittedWriter(self.options["path"])


def write_files(rows: DataFrame, folder: str) -> None:
    """Write (name, body) rows as files of a shared folder, all or none of them.

    Defined cases: a null body removes the file of that name, if there is one; an empty one
    makes an empty file; a file that is there already is replaced; of rows that share a
    name one stays; without rows nothing changes. Names hold no slash.
    """
    spark = rows.sparkSession
    ship_package(spark)
    spark.dataSource.register(CommittedFiles)
    rows.select(rows["name"].cast("string"), rows["body"].cast("string")).write.format(NAME).mode("append").option("path", folder).save()
