"""Folders that are replaced as a whole.

``mode("overwrite")`` removes the old files before the new ones are there,
so a write that fails leaves nothing.  Here a table is a folder of

* ``attempt-<id>/``: the files of one attempt, written by Spark as usual;
* ``_manifest/<version>.json``: which attempt a version is, with the number
  and bytes of its files.

A writer fills a folder of its own and then publishes it: the manifest is
written under a temporary name and renamed to the next free version.  Readers take the
attempt of the highest version, so they see the old table until the new one
is whole.  A failed attempt is removed and changes nothing.  Of two writers
at one time each has its own folder; the one that publishes last is read.
Older versions stay for a time of grace, and the one before the last always,
for readers that are under way; :func:`vacuum` removes what crashed writers
left.

A folder without a manifest (written by something else) is read as it is,
and may be replaced like any other.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

_MANIFEST, _ATTEMPT = "_manifest", "attempt-"
GRACE_S = 3600              # readers may take so long over a table that was replaced
_VERSION = re.compile(r"(\d{12})\.json")


# Files that a task of a partitioned write holds open before it sorts.
OPEN_FILES = 4
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"
_lock = threading.Lock()
_within: dict[int, list] = {}       # writes under way and the setting before them, by session


class DamagedTable(RuntimeError):
    """The files of a published attempt are not those that its manifest names."""


class StaleTable(RuntimeError):
    """Another version was published since the one that a new version was made from."""


@dataclass(frozen=True)
class Version:
    """A published state of a table."""
    version: int
    attempt: str
    files: int
    bytes: int


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder with their times of change (ms); none if it is not there."""
    p, fs = _path(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)] if fs.exists(p) else []


def _remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _read(spark: SparkSession, path: str) -> dict:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _size(spark: SparkSession, path: str) -> tuple[int, int]:
    p, fs = _path(spark, path)
    found = fs.getContentSummary(p)
    return found.getFileCount(), found.getLength()


@contextmanager
def open_parts(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes within keep a file per value open instead of sorting the rows of each task by value.

    A task that meets over ``OPEN_FILES`` values sorts the rest of its rows.
    A session that has the setting keeps its own; the last of several
    writers at one time puts the setting back.
    """
    key = id(spark)
    with _lock:
        state = _within.setdefault(key, [0, None])
        if not state[0]:
            state[1] = int(spark.conf.get(_OPEN))
            if not state[1]:
                spark.conf.set(_OPEN, str(OPEN_FILES))
        state[0] += 1
    try:
        yield
    finally:
        with _lock:
            state[0] -= 1
            if not state[0]:
                if not state[1]:
                    spark.conf.unset(_OPEN)
                del _within[key]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    root = path.rstrip("/")
    return sorted(int(m[1]) for n, _ in _names(spark, f"{root}/{_MANIFEST}") if (m := _VERSION.fullmatch(n)))


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that readers get; None for a folder that has no manifest."""
    known = versions(spark, path)
    return Version(**_read(spark, _manifest_of(path, known[-1]))) if known else None


def _manifest_of(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{_MANIFEST}/{version:012d}.json"


def resolve(spark: SparkSession, path: str) -> str:
    """The folder to read for ``path``: its current attempt, or ``path`` itself if it was never replaced.

    Files that are missing or cut short are an error, not a smaller table.
    """
    if any(c in path for c in "*?[{"):
        return path
    now = current(spark, path)
    if now is None:
        return path
    folder = f"{path.rstrip('/')}/{now.attempt}"
    p, fs = _path(spark, folder)
    found = _size(spark, folder) if fs.exists(p) else (0, 0)
    if found != (now.files, now.bytes):
        raise DamagedTable(f"{folder} has {found[0]} files of {found[1]} bytes; version {now.version} has {now.files} of {now.bytes}")
    return folder


def replace(spark: SparkSession, path: str, write: Callable[[str], None], grace_s: float = GRACE_S,
            after: int | None = None) -> Version:
    """Call ``write`` with a new folder and publish what it wrote as the table ``path``.

    ``after`` is the version that the new one was made from (0: none); if
    another one was published since, this one is not (:class:`StaleTable`).

    Versions that were replaced longer ago than ``grace_s`` are removed,
    but for the last one before.
    """
    root = path.rstrip("/")
    attempt = f"{_ATTEMPT}{uuid.uuid4().hex}"
    folder = f"{root}/{attempt}"
    try:
        write(folder)
        files, size = _size(spark, folder)
        done = _publish(spark, root, attempt, files, size, after)
    except BaseException:
        _remove(spark, folder)
        raise
    _tidy(spark, root, done, grace_s)
    return done


def _publish(spark: SparkSession, root: str, attempt: str, files: int, size: int, after: int | None) -> Version:
    own, fs = _path(spark, f"{root}/{_MANIFEST}/_{attempt}")
    for _ in range(100):
        # another writer may take the number between listing and renaming; a rename onto a file fails
        number = (versions(spark, root) or [0])[-1] + 1
        if after is not None and number != after + 1:
            fs.delete(own, False)
            raise StaleTable(f"{root} has version {number - 1}, the new one was made from {after}")
        done = Version(number, attempt, files, size)
        out = fs.create(own, True)
        out.write(bytearray(json.dumps(asdict(done)).encode()))
        out.close()
        to, _fs = _path(spark, _manifest_of(root, number))
        if not fs.exists(to) and fs.rename(own, to) and Version(**_read(spark, _manifest_of(root, number))) == done:
            return done
    raise RuntimeError(f"{root}: no free version after 100 tries")


def _now(spark: SparkSession) -> int:
    return spark.sparkContext._jvm.java.lang.System.currentTimeMillis()


def _tidy(spark: SparkSession, root: str, done: Version, grace_s: float) -> None:
    """Remove versions (and files from before the first one) that were replaced longer ago than ``grace_s``.

    The version before ``done`` stays in any case.  Manifests go first.
    """
    published = {int(m[1]): t for n, t in _names(spark, f"{root}/{_MANIFEST}") if (m := _VERSION.fullmatch(n))}
    before = _now(spark) - int(grace_s * 1000)
    for v in sorted(published):
        replaced = published.get(v + 1)
        if v < done.version - 1 and replaced is not None and replaced <= before:
            old = Version(**_read(spark, _manifest_of(root, v)))
            _remove(spark, _manifest_of(root, v))
            _remove(spark, f"{root}/{old.attempt}")
    if done.version > 1 and min(published.values()) <= before:
        for name, _ in _names(spark, root):
            if name != _MANIFEST and not name.startswith(_ATTEMPT):
                _remove(spark, f"{root}/{name}")


def vacuum(spark: SparkSession, path: str, older_than_s: float = 86_400) -> list[str]:
    """Remove attempts that no manifest names and that were last changed so long ago; their names.

    The time must be longer than any write takes.
    """
    root = path.rstrip("/")
    named = {_read(spark, _manifest_of(root, v))["attempt"] for v in versions(spark, root)}
    before = _now(spark) - int(older_than_s * 1000)
    gone = [n for n, t in _names(spark, root) if n.startswith(_ATTEMPT) and n not in named and t <= before]
    for n in gone:
        _remove(spark, f"{root}/{n}")
        _remove(spark, f"{root}/{_MANIFEST}/_{n}")
    return gone
