"""Files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as fs


def at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


@contextmanager
def written_whole(uri: str) -> Iterator[object]:
    """A stream whose file gets its name only when all is written, so that a task that is lost or run twice leaves no half file."""
    store, path = at(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    try:
        with store.open_output_stream(draft, compression=None) as out:
            yield out
    except BaseException:
        store.delete_file(draft)
        raise
    store.move(draft, path)


def opened(uri: str, random: bool = False):
    store, path = at(uri)
    return store.open_input_file(path) if random else store.open_input_stream(path, compression=None)
