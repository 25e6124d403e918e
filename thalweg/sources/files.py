"""Files of formats that Spark doesn't read, through Arrow's file systems."""

from __future__ import annotations

import re


def file_system(uri: str):
    """The file system of a URI, or of a plain path, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return (fs.LocalFileSystem(), uri) if "://" not in uri else fs.FileSystem.from_uri(uri)
