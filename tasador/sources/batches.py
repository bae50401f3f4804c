"""Batches of rows for several folders that take effect once and together.

A batch has an id. Its rows are written to a staging folder below each target
first, where no reader looks. The commit is one rename: that of the batch's
manifest, a small file with the counts and the staging folders, which fails if
the batch has one already. Then the staged files are moved into place.

So a batch that failed before its commit has left nothing that is read, and is
simply run again; one that failed after it is completed by the next call of
``complete``, file by file, each moved once; one that was completed is not
written a second time. Files carry the id of their batch.
"""

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_MANIFESTS, _STAGED = "_batches", "_staged"


def check_batch_id(batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]{0,99}", batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits, points and hyphens only")
    return batch_id


class Folder:
    """Files of a folder on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._files = self._at(self.path).getFileSystem(self._conf)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, name: str) -> bool:
        return self._files.exists(self._at(f"{self.path}/{name}"))

    def names(self, name: str) -> list[str]:
        """Entries of a folder below this one; none if it is absent."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._at(f"{self.path}/{name}")))

    def files(self, name: str) -> list[str]:
        """Paths of all files below a folder, as seen from there."""
        if not self.exists(name):
            return []
        base = self._files.makeQualified(self._at(f"{self.path}/{name}")).toUri().getPath()
        found, each = [], self._files.listFiles(self._at(f"{self.path}/{name}"), True)
        while each.hasNext():
            found.append(each.next().getPath().toUri().getPath()[len(base) + 1:])
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._at(f"{self.path}/{target}").getParent())
        if not self._files.rename(self._at(f"{self.path}/{source}"), self._at(f"{self.path}/{target}")):
            raise OSError(f"cannot move {source} to {target} in {self.path}")

    def delete(self, name: str) -> None:
        self._files.delete(self._at(f"{self.path}/{name}"), True)

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file in one step; false if there is one of that name already."""
        draft = f"{self.path}/{name}.{uuid.uuid4().hex}.draft"
        stream = self._files.create(self._at(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.getUri(), self._conf
        )
        never = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        choice = self._jvm.java.lang.reflect.Array.newInstance(never.getClass(), 1)
        self._jvm.java.lang.reflect.Array.set(choice, 0, never)
        try:
            context.rename(
                self._files.makeQualified(self._at(draft)),
                self._files.makeQualified(self._at(f"{self.path}/{name}")), choice,
            )
        except Py4JJavaError as failed:
            self._files.delete(self._at(draft), False)
            if "FileAlreadyExistsException" not in str(failed.java_exception):
                raise
            return False
        return True


@dataclass
class Batch:
    """A batch of rows for ``targets``; the first one's folder holds the manifest."""

    spark: SparkSession
    batch_id: str
    targets: dict[str, str]

    def __post_init__(self):
        check_batch_id(self.batch_id)
        self._folders = {name: Folder(self.spark, path) for name, path in self.targets.items()}
        self._log = next(iter(self._folders.values()))
        self._attempt = f"{self.batch_id}_{uuid.uuid4().hex}"

    def counts(self) -> dict[str, int] | None:
        """Counts of a batch that has taken effect, after moving what is still staged."""
        name = f"{_MANIFESTS}/{self.batch_id}.json"
        if not self._log.exists(name):
            return None
        manifest = json.loads(self._log.read(name))
        self._move(manifest["attempt"])
        return manifest["counts"]

    def stage(self, name: str, rows: DataFrame, keys: tuple[str, ...]) -> None:
        rows.write.mode("overwrite").option("compression", "snappy").partitionBy(*keys).parquet(
            f"{self._folders[name].path}/{_STAGED}/{self._attempt}"
        )

    def commit(self, counts: dict[str, int]) -> dict[str, int]:
        """Make the staged rows those of the batch, unless another attempt was first."""
        manifest = json.dumps({"attempt": self._attempt, "counts": counts})
        if not self._log.create(f"{_MANIFESTS}/{self.batch_id}.json", manifest):
            self.discard()
        return self.counts()

    def discard(self) -> None:
        for folder in self._folders.values():
            folder.delete(f"{_STAGED}/{self._attempt}")

    def _move(self, attempt: str) -> None:
        for folder in self._folders.values():
            staged = f"{_STAGED}/{attempt}"
            for file in folder.files(staged):
                keys, _, name = file.rpartition("/")
                if name.startswith(("_", ".")):
                    continue
                folder.move(f"{staged}/{file}", f"{keys}/{self.batch_id}-{name}" if keys else f"{self.batch_id}-{name}")
            # What is left of this batch: the empty folders and attempts that failed.
            for other in folder.names(_STAGED):
                if other.startswith(f"{self.batch_id}_"):
                    folder.delete(f"{_STAGED}/{other}")


def committed(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches that took effect in a folder."""
    names = Folder(spark, path).names(_MANIFESTS)
    return [n.removesuffix(".json") for n in names if n.endswith(".json")]


def complete(spark: SparkSession, targets: dict[str, str]) -> None:
    """Move into place what committed batches have still staged."""
    folders = [Folder(spark, path) for path in targets.values()]
    waiting = {name.rpartition("_")[0] for f in folders for name in f.names(_STAGED)}
    for batch_id in sorted(waiting & set(committed(spark, next(iter(targets.values()))))):
        Batch(spark, batch_id, targets).counts()
