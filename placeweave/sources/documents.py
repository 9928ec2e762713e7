"""Text documents as files, one for each row: ``<name><suffix>`` below a folder.

A task writes its documents to a hidden folder of its own attempt. Only when every task is done does the commit move them
to their places, so a job that fails, or an attempt that is lost, leaves nothing behind. Whether a document exists already
is decided then. Names must be single path parts, and no two rows may share one: either stops the job before anything is
moved. The commit renames one file a document on the driver, several at once; it reads none.

The folder is a path or URI that executors and driver share; ``pyarrow.fs`` opens it.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# The writer travels with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "placeweave_documents"
MOVES_AT_ONCE = 16


def _opened(path: str):
    """(file system, plain path) of a path or URI."""
    from pyarrow import fs

    if ":/" in path:
        return fs.FileSystem.from_uri(path if "://" in path else path.replace(":/", ":///", 1))
    return fs.LocalFileSystem(), path


@dataclass
class Staged(WriterCommitMessage):
    """The folder that one task filled."""

    folder: str


class TextDocuments(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        return Writer(dict(self.options))


class Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.target, self.suffix = options["path"].rstrip("/"), options.get("suffix", "")
        self.create_only = options.get("createonly", options.get("createOnly", "false")) == "true"
        self.staging = f"{self.target}/.staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        from pyspark import TaskContext

        task = TaskContext.get()
        files, staging = _opened(self.staging)
        folder = f"{staging}/{task.partitionId()}-{task.taskAttemptId()}"
        files.create_dir(folder, recursive=True)
        seen = set()
        for name, text in iterator:
            if not name or "/" in name or name in (".", "..") or name in seen:
                raise ValueError(f"not a name for a document of its own: {name!r}")
            seen.add(name)
            with files.open_output_stream(f"{folder}/{name}{self.suffix}") as out:
                out.write((text or "").encode("utf-8"))
        return Staged(folder)

    def commit(self, messages):
        from concurrent.futures import ThreadPoolExecutor

        from pyarrow.fs import FileSelector, FileType

        files, target = _opened(self.target)
        staged: dict[str, str] = {}
        for message in messages:
            for found in files.get_file_info(FileSelector(message.folder)) if message else ():
                if found.base_name in staged:
                    self.abort(messages)
                    raise ValueError(f"two documents are named {found.base_name!r}")
                staged[found.base_name] = found.path
        files.create_dir(target, recursive=True)

        def move(name: str) -> None:
            place = f"{target}/{name}"
            if self.create_only and files.get_file_info(place).type != FileType.NotFound:
                return
            files.move(staged[name], place)

        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            list(pool.map(move, sorted(staged)))
        self.abort(messages)

    def abort(self, messages):
        """What is left in the hidden folder goes; after a commit that is only what existed already."""
        from pyarrow.fs import FileType

        files, staging = _opened(self.staging)
        if files.get_file_info(staging).type != FileType.NotFound:
            files.delete_dir(staging)


def write_text_documents(
    rows: DataFrame, path: str, name: str | Column = "name", text: str | Column = "text", suffix: str = "", create_only: bool = False
) -> None:
    """One file for each row. With ``create_only`` a file that exists stays as it is; otherwise it is replaced."""
    rows.sparkSession.dataSource.register(TextDocuments)
    columns = [(F.col(c) if isinstance(c, str) else c).cast("string").alias(n) for c, n in ((name, "name"), (text, "text"))]
    writer = rows.select(*columns).write.format(FORMAT).mode("append").option("suffix", suffix)
    writer.option("createOnly", str(create_only).lower()).save(path)
