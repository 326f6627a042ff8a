"""Folder-level helpers over the Hadoop file system, and the shared work folder.

Only names and existence pass through here; file contents and row data never do.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from lodeworks.errors import LakeError


#: Folders that are listed at a time.
LISTED = 32
#: What a file status says as text.
_STATUS = re.compile(
    r"path=[^;]*?([^/;]+); isDirectory=(true|false)(?:; length=(\d+))?[^{}]*?; modification_time=(\d+)", re.DOTALL
)


class Folders:
    """Existence, listing and removal of folders on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._util = spark._jvm.org.apache.hadoop.fs.FileUtil
        self._text = spark._jvm.scala.runtime.ScalaRunTime.stringOf

    def _at(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def write_text(self, path: str, text: str) -> None:
        """A small file, there with all of its text or not at all; an existing one is not replaced."""
        fs, p = self._at(path)
        aside = self._path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(p) or not fs.rename(aside, p):  # a local file system would rename over it
            fs.delete(aside, False)
            raise LakeError(f"{path} was written by someone else at the same time")

    def read_text(self, path: str) -> str:
        """The text of a small file."""
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def backdate(self, path: str, names: Iterable[str], days: int) -> None:
        """Make files in ``path`` look ``days`` older, as a copy that keeps times does."""
        fs, _ = self._at(path)
        for name in names:
            at = self._path(f"{path}/{name}")
            fs.setTimes(at, fs.getFileStatus(at).getModificationTime() - days * 86_400_000, -1)

    def listing(self, path: str) -> list[tuple[str, bool, int, int]]:
        """(name, whether a folder, length, milliseconds) of what is directly in ``path``; empty when it is missing.

        A few calls to the JVM for the whole folder: all statuses come over as one text. Where a name looks like
        the text around it, they are asked for one by one.
        """
        fs, p = self._at(path)
        try:
            found = fs.listStatus(p)
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return []
            raise
        n = len(found)
        if n == 1 and not found[0].isDirectory() and found[0].getPath().equals(fs.makeQualified(p)):
            return []  # a file, which lists itself
        text = self._text(found)
        parsed = _STATUS.findall(text)
        if all(x == n for x in (len(parsed), *(text.count(key) for key in ("path=", "; isDirectory=", "; modification_time=")))):
            return [(name, kind == "true", int(length or 0), int(time)) for name, kind, length, time in parsed]
        return [(s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in found]

    def files(self, path: str) -> list[str]:
        """Names of the files directly in ``path``, sorted; empty when it is missing."""
        return sorted(name for name, is_folder, *_ in self.listing(path) if not is_folder)

    def children(self, path: str) -> list[str]:
        """Names of the immediate sub-folders, sorted; empty when ``path`` is missing."""
        return sorted(name for name, is_folder, *_ in self.listing(path) if is_folder)

    def qualified(self, path: str) -> str:
        """``path`` as the file system spells it, without a trailing slash."""
        fs, p = self._at(path)
        return fs.makeQualified(p).toString()

    def walk(self, path: str) -> Iterator[list[tuple[str, int, int]]]:
        """(path, length, milliseconds) of every file below ``path``, a list for each folder.

        Folders are listed many at a time, as a store answers many requests at once.
        """
        with ThreadPoolExecutor(LISTED) as pool:
            open_ = {pool.submit(self.listing, top): top for top in [self.qualified(path)]}
            while open_:
                done, _ = wait(open_, return_when=FIRST_COMPLETED)
                for job in done:
                    folder, files = open_.pop(job).rstrip("/"), []
                    for name, is_folder, length, time in job.result():
                        if is_folder:
                            open_[pool.submit(self.listing, f"{folder}/{name}")] = f"{folder}/{name}"
                        else:
                            files.append((f"{folder}/{name}", length, time))
                    if files:
                        yield files

    def copy_files(self, pairs: Sequence[tuple[str, str]]) -> None:
        """Copy single files, many at a time; their bytes stream through the file system's own client."""

        def one(pair: tuple[str, str]) -> None:
            (a, p), (b, q) = map(self._at, pair)
            self._util.copy(a, p, b, q, False, self._conf)

        with ThreadPoolExecutor(LISTED) as pool:
            list(pool.map(one, pairs))

    def move(self, path: str, to: str) -> None:
        """Rename within one file system; what is at ``to`` is not replaced."""
        fs, p = self._at(path)
        q = self._path(to)
        if fs.exists(q) or not fs.rename(p, q):
            raise LakeError(f"{path} can't be moved to {to}")


_made: set[str] = set()


def clear_work(spark: SparkSession) -> None:
    """Remove the work folders that this process has asked for, and the databases in them.

    For callers that are done with every DataFrame read from there.
    """
    folders = Folders(spark)
    for database in spark.catalog.listDatabases():
        if any(folder in (database.locationUri or "") for folder in _made):
            spark.sql(f"DROP DATABASE `{database.name}` CASCADE")
    for folder in _made:
        folders.remove(folder)
    _made.clear()


def work_folder(spark: SparkSession, label: str = "work") -> str:
    """A fresh folder name that every executor can reach.

    The parent is the session's ``spark.checkpoint.dir``. A local master without that
    setting gets its own temporary folder; a cluster without it is refused, since a
    machine-local folder there would be lost with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise LakeError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="lodeworks-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/lodeworks-{label}-{uuid.uuid4().hex}"
    _made.add(folder)
    return folder
