"""Which folders of a store count: a versioned manifest that readers follow while writers append.

A store is a folder of run folders. Beside them ``_manifest`` holds one small file per version, put there by a single rename
that fails where the version exists already. A version names the files of the snapshot, with the range of keys of each, and
the runs that the snapshot covers. Readers take the snapshot of the newest version and every finished run that it does not
cover: a run appended while a snapshot is made is covered by no version yet, so nothing is lost at the swap. Readers lock
nothing; a reader keeps the folders it listed, since replaced ones stay until they are swept away.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_FOLDER = "_manifest"
#: What Spark leaves in a folder once all of its files are in place.
_DONE = "_SUCCESS"


class ManifestConflict(RuntimeError):
    """Another writer put the same version first."""


@dataclass(frozen=True)
class SnapshotFile:
    """A file of a snapshot: the keys in it, and the least time at which a row of it expires (0: none does)."""

    path: str
    least: str
    most: str
    rows: int
    expires: int


@dataclass(frozen=True)
class Manifest:
    """One version. ``files`` are sorted by their least key and share none; paths are relative to the store."""

    version: int = 0
    files: tuple[SnapshotFile, ...] = ()
    covered: frozenset[str] = field(default_factory=frozenset)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "covered": sorted(self.covered), "files": [vars(f) for f in self.files]})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["version"], tuple(SnapshotFile(**f) for f in found["files"]), frozenset(found["covered"]))


class Folder:
    """A folder of any file system Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self.at("").getFileSystem(self._conf)

    def at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """The names in a folder, none if there is no such folder."""
        if not self._fs.exists(self.at(name)):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self.at(name)))

    def holds(self, name: str) -> bool:
        return self._fs.exists(self.at(name))

    def text(self, name: str) -> str:
        stream = self._fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_once(self, name: str, text: str) -> bool:
        """Writes a file whole or, where there is one of that name, not at all."""
        draft = self.at(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self._fs.create(draft, False)
        stream.write(text.encode())
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at("").toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        options[0] = rename.NONE
        try:
            context.rename(draft, self.at(name), options)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def rename(self, name: str, to: str) -> None:
        """Moves a file or folder to a path of the same file system that is not there yet."""
        target = self._jvm.org.apache.hadoop.fs.Path(to)
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target) or not self._fs.rename(self.at(name), target):
            raise FileExistsError(f"{to} is there already, or cannot be made")

    def remove(self, name: str) -> None:
        self._fs.delete(self.at(name), True)


def _versions(store: Folder) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in store.names(_FOLDER) if name.endswith(".json"))


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest version; the empty one where a store has none."""
    store = Folder(spark, path)
    versions = _versions(store)
    return Manifest.from_json(store.text(f"{_FOLDER}/{versions[-1]:012d}.json")) if versions else Manifest()


def commit_manifest(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Puts a version. Fails where another writer has put it."""
    if not Folder(spark, path).put_once(f"{_FOLDER}/{manifest.version:012d}.json", manifest.to_json()):
        raise ManifestConflict(f"version {manifest.version} of {path} is there already")


def finished_runs(spark: SparkSession, path: str) -> list[str]:
    """The folders of all finished runs, of batches, streams and snapshots written as runs of a new store."""
    store = Folder(spark, path)
    found = []
    for name in store.names():
        if name.startswith("stream="):
            found += [f"{name}/{batch}" for batch in store.names(name) if batch.startswith("batch=")]
        elif name.startswith(("run=", "snapshot=")):
            found.append(name)
    return [name for name in found if store.holds(f"{name}/{_DONE}")]


def open_runs(spark: SparkSession, path: str, manifest: Manifest) -> list[str]:
    """The finished runs that the manifest's snapshot does not cover."""
    return [name for name in finished_runs(spark, path) if name not in manifest.covered]


def sweep_store(spark: SparkSession, path: str) -> int:
    """Removes what no reader of the newest version needs: covered runs, replaced snapshots, older versions.

    For a time when no reader of an older version is at work and no snapshot is being made. Returns the number of folders removed.
    """
    store, manifest = Folder(spark, path), read_manifest(spark, path)
    used = {f.path.split("/", 1)[0] for f in manifest.files}
    gone = [name for name in finished_runs(spark, path) if name in manifest.covered]
    gone += [name for name in store.names() if name.startswith("merged=") and name not in used]
    for name in gone:
        store.remove(name)
    for version in _versions(store)[:-1]:
        store.remove(f"{_FOLDER}/{version:012d}.json")
    return len(gone)
