"""Binary files that tasks write to and read from the shared folder, on any store that Arrow's file systems reach."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs


def _resolve(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def writing(folder: str, name: str) -> Iterator:
    """A stream to a new file that gets its name only when it is whole; a repeated task replaces it by the same bytes."""
    system, path = _resolve(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, f"{path}/{name}")


def opened(uri: str):
    """A file for reading with seek."""
    system, path = _resolve(uri)
    return system.open_input_file(path)
