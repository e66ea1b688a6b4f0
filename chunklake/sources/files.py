"""File systems as tasks see them: what pyarrow reads and writes, by the paths Spark gives."""

from __future__ import annotations

import re

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it. A path may hold any character: only what stands before it is a location."""
    parts = re.match(r"(?:([A-Za-z0-9]+)://([^/]*)|file:)?(.*)", path, re.S)
    if (parts[1] or "file") == "file":
        return fs.LocalFileSystem(), parts[3]
    return fs.FileSystem.from_uri(f"{parts[1]}://{parts[2]}/")[0], parts[3]
