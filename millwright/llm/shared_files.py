"""Plain files in the folder all executors share, for formats Spark has no writer for.

Writers run in tasks. A task writes under a name of its own and moves the finished file to
its final name, so a repeated or speculative attempt replaces a file by the same bytes.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or path, and the path within it."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def make_folder(folder: str) -> str:
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    return folder


def put(folder: str, name: str, data: bytes | list[bytes]) -> str:
    """Write one whole file; returns its name."""
    system, path = opened(folder)
    temporary, final = f"{path}/.{name}.{uuid.uuid4().hex}", f"{path}/{name}"
    with system.open_output_stream(temporary) as out:
        for piece in [data] if isinstance(data, bytes) else data:
            out.write(piece)
    if not isinstance(system, fs.LocalFileSystem) and system.get_file_info(final).type == fs.FileType.File:
        system.delete_file(final)  # some stores refuse to move onto a file
    system.move(temporary, final)
    return name
