"""Folders and file patterns on whatever file system the cluster uses."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _file_system(spark, folder)
    return fs.exists(path)


def require_folder(spark: SparkSession, folder: str) -> str:
    """The folder's full URI without a trailing slash; an error if it is none."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        raise FileNotFoundError(f"there is no folder {folder}")
    status = fs.getFileStatus(path)
    if not status.isDirectory():
        raise ValueError(f"{folder} is a file where a folder is needed")
    return status.getPath().toUri().toString().rstrip("/")


def entry_names(spark: SparkSession, folder: str, starting: str) -> list[str]:
    """Names of the direct entries of a folder that start with a text.

    For marker files, whose leading underscore hides them from Spark's own listing.
    """
    fs, _ = _file_system(spark, folder)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{starting}*")
    found = fs.globStatus(pattern)
    return [] if found is None else [status.getPath().getName() for status in found]


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.mkdirs(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def remove_files(spark: SparkSession, uris: Iterable[str]) -> None:
    """Delete single files, named as Spark's file metadata names them."""
    for uri in uris:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def glob_regex(pattern: str) -> str:
    """A file pattern below a folder as a regular expression on the relative path.

    ``**/`` stands for any number of folders, ``*`` and ``?`` stay within one name.
    """
    out = ""
    for part in re.split(r"(\*\*/|\*|\?|\[[^\]]+\])", pattern):
        if part == "**/":
            out += "(?:[^/]+/)*"
        elif part == "*":
            out += "[^/]*"
        elif part == "?":
            out += "[^/]"
        elif part.startswith("[") and part.endswith("]"):
            out += "[^" + part[2:] if part.startswith("[!") else part
        else:
            out += re.escape(part)
    return out


def below_regex(root: str, pattern: str) -> str:
    """Full paths below a root folder that match a file pattern.

    Only the path part of the root counts: its scheme has more than one spelling.
    """
    path = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root)
    return f"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?{re.escape(path)}/{glob_regex(pattern)}$"


def last_segment(pattern: str) -> str:
    return pattern.rsplit("/", 1)[-1]
