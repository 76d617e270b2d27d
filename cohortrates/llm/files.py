"""Files that tasks write to and read from the shared folder, over any file system pyarrow knows."""

from __future__ import annotations

import uuid
from typing import BinaryIO

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def create(folder: str, stem: str, suffix: str) -> tuple[str, BinaryIO]:
    """A new file of this attempt of a task.

    A task that is run again writes another file. Which files count is told by the rows that the
    successful attempts return; a file that no row names is never read.
    """
    system, base = located(folder)
    system.create_dir(base, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex[:12]}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{base}/{name}", compression=None)


def open_random(path: str):
    system, base = located(path)
    return system.open_input_file(base)


def open_stream(path: str):
    system, base = located(path)
    return system.open_input_stream(base, compression=None, buffer_size=1 << 20)
