"""Files that tasks write to and read from the shared folder.

A task writes under a name of its own attempt and renames the finished file, so
a task that is run again, or twice at once, leaves one whole file per name.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that a URI names (file, hdfs, s3, gs, or a plain path) and the path in it."""
    return fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(folder: str, name: str) -> Iterator:
    """A stream whose content becomes ``folder/name`` when the block ends well."""
    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    context = TaskContext.get()
    attempt = f"{path}/_{name}.{context.taskAttemptId() if context else 0}"
    with store.open_output_stream(attempt, compression=None) as stream:
        yield stream
    store.move(attempt, f"{path}/{name}")


@contextmanager
def old_file(uri: str) -> Iterator:
    store, path = open_folder(uri)
    with store.open_input_stream(path, compression=None) as stream:
        yield stream


def partition_name(prefix: str, number: int, suffix: str) -> str:
    context = TaskContext.get()
    return f"{prefix}-{context.partitionId() if context else 0:06d}-{number:05d}.{suffix}"
