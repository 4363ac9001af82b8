"""Files on any file system that Spark's paths name: listing, reading, writing beside and renaming."""

from __future__ import annotations

import hashlib
import os

from pyarrow import fs


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it; a plain path is local."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return fs.LocalFileSystem(), os.path.abspath(path)


def with_scheme(path: str, other: str) -> str:
    """A path in `other`'s file system, with the scheme of `path` in front."""
    return f"{path.split('://', 1)[0]}://{other}" if path.startswith("file://") else other


def exists(path: str) -> bool:
    system, name = resolve(path)
    return system.get_file_info(name).type != fs.FileType.NotFound


def listing(folder: str, suffixes: tuple[str, ...] = ()) -> list[str]:
    """Sorted paths of the files of a folder, or the file itself."""
    system, name = resolve(folder)
    info = system.get_file_info(name)
    if info.type == fs.FileType.File:
        return [folder]
    if info.type == fs.FileType.NotFound:
        return []
    found = [x.path for x in system.get_file_info(fs.FileSelector(name)) if x.type == fs.FileType.File]
    return sorted(with_scheme(folder, x) for x in found if not suffixes or x.lower().endswith(suffixes))


def open_read(path: str):
    system, name = resolve(path)
    return system.open_input_stream(name, compression=None)


def write_whole(path: str, chunks) -> str:
    """Write the byte chunks beside `path` and rename, so no reader ever sees half of a file."""
    system, name = resolve(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    with system.open_output_stream(f"{name}.tmp", compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(f"{name}.tmp", name)
    return path


def signature(path: str, *more: object) -> str:
    """A hash of a file's path, time and size (of all its files, if it is a folder) and of `more`."""
    digest = hashlib.sha1(repr(more).encode())
    for one in listing(path):
        system, name = resolve(one)
        info = system.get_file_info(name)
        digest.update(f"{one}|{info.mtime_ns}|{info.size}".encode())
    return digest.hexdigest()


def download(url: str, path: str, fetch, chunk: int = 1 << 20) -> bool:
    """Fetch `url` into `path` unless the file is there; `fetch(url)` opens a stream. Whether it was fetched."""
    if exists(path):
        return False
    with fetch(url) as stream:
        write_whole(path, iter(lambda: stream.read(chunk), b""))
    return True
