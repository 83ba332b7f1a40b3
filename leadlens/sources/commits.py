"""Commit log of a folder: numbered entries that exist whole or not at all.

An entry is one JSON file ``_log/<number>.json``, put only if absent. Writers prepare data elsewhere in the folder, then put
the entry that names it; of two writers with the same number one wins and the other looks again. Readers follow the
entries alone, so data without an entry (a writer that died, one that is at work) are never seen.

Put-if-absent is a hard link on a local file system, a rename (which does not replace) elsewhere, both after the content is
complete. HDFS keeps this promise; an object store needs a committer that does.
"""
from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from ..session import hadoop_fs

LOG = "_log"


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{LOG}/{name}"

    def numbers(self) -> list[int]:
        fs, p = hadoop_fs(self.spark, f"{self.folder}/{LOG}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        fs, p = hadoop_fs(self.spark, self._path(f"{number:020d}.json"))
        with_bytes = fs.open(p)
        try:
            size = int(fs.getFileStatus(p).getLen())
            return json.loads(bytes(with_bytes.readNBytes(size)).decode())
        finally:
            with_bytes.close()

    def entries(self) -> list[dict]:
        return [self.read(n) for n in self.numbers()]

    def put(self, number: int, entry: dict) -> bool:
        """Put entry ``number`` if there is none; whether this call did."""
        final, temp = self._path(f"{number:020d}.json"), self._path(f".{uuid.uuid4().hex}.tmp")
        fs, t = hadoop_fs(self.spark, temp)
        out = fs.create(t, False)
        out.write(bytearray(json.dumps(entry), "utf-8"))
        out.close()
        _, f = hadoop_fs(self.spark, final)
        try:
            if fs.getUri().getScheme() == "file":
                os.link(unquote(urlparse(str(t.toUri())).path), unquote(urlparse(str(f.toUri())).path))
                return True
            return not fs.exists(f) and bool(fs.rename(t, f))
        except FileExistsError:
            return False
        finally:
            fs.delete(t, False)

    def commit(self, build: Callable[[list[dict]], dict | None], tries: int = 100) -> dict | None:
        """Put the entry that ``build`` makes of the earlier ones, again from the start if another writer was faster;
        None from ``build``: nothing to commit."""
        return self._put_next(lambda numbers: build([self.read(n) for n in numbers]), tries)

    def last(self) -> dict | None:
        """The newest entry."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def replace(self, build: Callable[[dict | None], dict | None], tries: int = 100) -> dict | None:
        """As ``commit``, for a log whose every entry is a whole state: ``build`` sees the newest one alone."""
        return self._put_next(lambda numbers: build(self.read(numbers[-1]) if numbers else None), tries)

    def _put_next(self, build: Callable[[list[int]], dict | None], tries: int) -> dict | None:
        for _ in range(tries):
            numbers = self.numbers()
            entry = build(numbers)
            if entry is None:
                return None
            if self.put(numbers[-1] + 1 if numbers else 1, entry):
                return entry
        raise RuntimeError(f"{self.folder}: other writers were faster {tries} times")
