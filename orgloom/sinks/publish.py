"""Appends that become visible whole or not at all.

A stored dataset is a folder of appends, each in a folder of its own named after the moment at
which it began: ``append=<nanoseconds>-<id>``, or ``replace=...`` if it takes the place of all
earlier ones. What belongs together is written below that folder, and only when all of it
is there does one small file, the mark, make it count. Readers ask which folders have a
mark. A write that stops anywhere so leaves the earlier dataset as it was, and no file is
ever rewritten. Files of other origin in the same place (written by hand or by older
versions) are the dataset's beginning.
"""

from __future__ import annotations

import posixpath
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

MARK = "_PUBLISHED"
_OWN = re.compile(r"(append|replace)=(\d{20})-[0-9A-Za-z.-]+")
#: The part of a file's path that sorts appends in the order in which they began.
STAMP = r"/(?:append|replace)=(\d{20}-[0-9A-Za-z.-]+)/"


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that Spark reaches a path by, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names in a folder that Spark would read, and whether each is a folder."""
    files, where = _at(spark, path)
    if not files.exists(where) or files.getFileStatus(where).isFile():
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(where)]
    return sorted(x for x in found if x[0][0] not in "._")


def stamp(now: int | None = None) -> str:
    """A name that sorts after those given out before."""
    return f"{time.time_ns() if now is None else now:020d}-{uuid.uuid4().hex[:8]}"


@contextmanager
def publication(spark: SparkSession, path: str, replace: bool = False, name: str | None = None) -> Iterator[str]:
    """A folder to write into; what is in it counts from the end of the block on.

    With ``replace`` everything published before is superseded and then deleted. ``name``
    gives a rerun the folder of the run that stopped; what that one left is deleted first.
    """
    folder = posixpath.join(path, f"{'replace' if replace else 'append'}={name or stamp()}")
    assert _OWN.fullmatch(posixpath.basename(folder)), folder
    if name is not None:
        delete(spark, folder)
    yield folder
    files, mark = _at(spark, posixpath.join(folder, MARK))
    files.create(mark, True).close()
    if replace:
        _forget(spark, path, posixpath.basename(folder))


def _forget(spark: SparkSession, path: str, newest: str) -> None:
    since = _OWN.fullmatch(newest)[2]
    for name, is_folder in _children(spark, path):
        own = _OWN.fullmatch(name)
        if name != newest and (not own or own[2] < since):
            if own or not is_folder:
                delete(spark, posixpath.join(path, name))


@dataclass(frozen=True)
class Published:
    """Where the rows of a dataset are: paths of other origin, then the appends in order."""

    others: tuple[str, ...]
    appends: tuple[str, ...]

    @property
    def paths(self) -> list[str]:
        return [*self.others, *self.appends]


def published(spark: SparkSession, path: str) -> Published:
    """What counts now. A path without appends, be it a file or a folder, is of other origin as a whole."""
    names = _children(spark, path)
    own = [m for name, is_folder in names if is_folder and (m := _OWN.fullmatch(name))]
    if not own:
        return Published((path,), ())
    marked = sorted((m for m in own if exists(spark, posixpath.join(path, m[0], MARK))), key=lambda m: (m[2], m[0]))
    replaced = max((i for i, m in enumerate(marked) if m[1] == "replace"), default=None)
    others = [] if replaced is not None else [posixpath.join(path, n) for n, _ in names if not _OWN.fullmatch(n)]
    return Published(tuple(others), tuple(posixpath.join(path, m[0]) for m in marked[replaced or 0 :]))


def vacuum(spark: SparkSession, path: str, older_than_s: float = 86_400) -> list[str]:
    """Delete what stopped writes have left, and return it.

    A folder without its mark may belong to a write that is still running: only those that
    began more than ``older_than_s`` seconds ago go.
    """
    before = time.time_ns() - int(older_than_s * 1e9)
    left = []
    for name, is_folder in _children(spark, path):
        own = _OWN.fullmatch(name)
        if is_folder and own and int(own[2]) < before and not exists(spark, posixpath.join(path, name, MARK)):
            delete(spark, posixpath.join(path, name))
            left.append(name)
    return left
