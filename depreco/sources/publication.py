"""Publishing several outputs at once: stage, commit by one rename, then move into place.

Every output is written beside its place, in a folder that readers skip. The manifest of what goes where is
written last; renaming it is the commit. Before that a failure leaves nothing behind that counts; after it the
moves are made, and made to their end by the next run if this one dies between them. A move that was made already
is skipped, so the end is the same however often it is begun. One job at a time publishes to a folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

STAGED, COMMITTED = "_staged-", "_commit-"


class Files:
    """The few file operations that publishing needs, by the paths' own Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, in order; none if there is no such folder."""
        fs, at = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def rename(self, path: str, to: str) -> None:
        fs, at = self._at(path)
        new = self._jvm.org.apache.hadoop.fs.Path(to)
        fs.mkdirs(new.getParent())
        if not fs.rename(at, new):
            raise OSError(f"{path} can't be renamed to {to}")

    def write(self, path: str, text: str) -> None:
        fs, at = self._at(path)
        out = fs.create(at, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read(self, path: str) -> str:
        fs, at = self._at(path)
        source = fs.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def concatenate(self, parts: Sequence[str], to: str, head: str = "") -> None:
        """One file of ``head`` and the files ``parts`` in their order, copied through a small buffer."""
        fs, at = self._at(to)
        out = fs.create(at, True)
        try:
            out.write(bytearray(head.encode("utf-8")))
            for part in parts:
                source_fs, source_at = self._at(part)
                source = source_fs.open(source_at)
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
                finally:
                    source.close()
        finally:
            out.close()


def _parent(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0]


class Publication:
    """One run's outputs. ``base`` holds the manifest; outputs may lie elsewhere."""

    def __init__(self, spark: SparkSession, base: str):
        self.files, self.base, self.id = Files(spark), base.rstrip("/"), uuid.uuid4().hex
        self.moves: list[dict[str, str]] = []
        self.committed = False

    def stage(self, target: str, write: Callable[[str], None]) -> str:
        """Let ``write`` make the output at a hidden path beside ``target``; returns ``target``."""
        target = target.rstrip("/")
        at = f"{_parent(target)}/{STAGED}{self.id}/{len(self.moves)}"
        self.moves.append({"from": at, "to": target})
        write(at)
        return target

    def _folders(self) -> set[str]:
        return {_parent(m["from"]) for m in self.moves}

    def discard_staged(self) -> None:
        """Drop what was staged, unless it is committed already: then the next run finishes it."""
        if not self.committed:
            for folder in self._folders():
                self.files.delete(folder)

    def commit(self) -> None:
        staged, manifest = f"{self.base}/{STAGED}{self.id}.json", f"{self.base}/{COMMITTED}{self.id}.json"
        self.files.write(staged, json.dumps(self.moves))
        self.files.rename(staged, manifest)  # from here on the outputs count
        self.committed = True
        _finish(self.files, manifest)


def _finish(files: Files, manifest: str) -> None:
    moves = json.loads(files.read(manifest))
    for m in moves:
        if files.exists(m["from"]):
            files.delete(m["to"])
            files.rename(m["from"], m["to"])
    for folder in {_parent(m["from"]) for m in moves}:
        files.delete(folder)
    files.delete(manifest)


def recover(spark: SparkSession, base: str, *others: str) -> list[str]:
    """Finish what an earlier run committed to ``base`` and drop what it only staged, there and in ``others``.
    Returns the targets of the commits that were finished."""
    files, done = Files(spark), []
    base = base.rstrip("/")
    for name in files.names(base):
        if name.startswith(COMMITTED):
            done += [m["to"] for m in json.loads(files.read(f"{base}/{name}"))]
            _finish(files, f"{base}/{name}")
    for folder in (base, *(o.rstrip("/") for o in others)):
        for name in files.names(folder):
            if name.startswith(STAGED):
                files.delete(f"{folder}/{name}")
    return done
