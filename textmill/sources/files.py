"""Files that Spark has no writer for, on any store: a local path, or a URI (file, hdfs, s3, gs) through Arrow's file systems."""

from __future__ import annotations

import os
import re

from pyarrow import fs


def at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), local(path)


def local(path: str) -> str:
    """The path of a local file, of its URI too. Of another store it is an error: what is mapped into memory has to be local."""
    path = re.sub("^file:/*", "/", path)
    if "://" in path:
        raise ValueError(f"{path} is no local file")
    return os.path.abspath(path)


def read(path: str):
    """A stream of the bytes of a file."""
    store, name = at(path)
    return store.open_input_stream(name, compression=None)


class Written:
    """A stream into a file that is in place only when it is whole; what fails leaves no file of that name."""

    def __init__(self, path: str):
        self.store, self.name = at(path)

    def __enter__(self):
        self.store.create_dir(os.path.dirname(self.name), recursive=True)
        self.out = self.store.open_output_stream(f"{self.name}.tmp", compression=None)
        return self.out

    def __exit__(self, kind, *_):
        if not self.out.closed:
            self.out.close()
        if kind is None:
            self.store.move(f"{self.name}.tmp", self.name)
        else:
            self.store.delete_file(f"{self.name}.tmp")


def move(path: str, to: str) -> None:
    store, name = at(path)
    store.move(name, at(to)[1])
