"""Places that tasks read and write without Spark: local ones, and stores that Arrow has a file system for."""

from __future__ import annotations

import os
import re


def file_system(uri: str):
    """Arrow's file system of a place, and its path there; s3a and s3n are Hadoop's names of what Arrow calls s3."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if uri.startswith("file:"):
        return LocalFileSystem(), re.sub("^file:/+", "/", uri)
    if "://" not in uri:
        return LocalFileSystem(), os.path.abspath(uri)
    return FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
