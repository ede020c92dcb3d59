"""Claims of a model by one builder at a time (A13 under concurrent builders).

Two builders of one model would both start from the same version, and the later swap would hide the rows of the
earlier one. So a build first claims its model: it creates the file
``<schema's folder>/_modelsmith_claims/<model>.<n>`` and fails with :class:`BuildConflict` where another
builder's claim is open. Claims are numbered; the highest number holds. Creating a file that
must not exist is the only step that has to be atomic (it is on local, network and HDFS file
systems; an object store needs a committer that grants it), as no claim is ever taken back by renaming or
overwriting: a released claim has a ``.done`` file beside it, and one not renewed for ``lifetime`` seconds counts
as that of a dead builder, and the next number may be created. A builder that was only slow finds at its swap
that its number is not the highest any more, and publishes nothing.

Builders of one schema need clocks that agree to well within ``lifetime``.
"""

from __future__ import annotations

import os
import time
from contextlib import contextmanager

from pyspark.sql import SparkSession

LIFETIME = 6 * 3600.0


class BuildConflict(RuntimeError):
    """Another builder has the model, or had it in the meantime."""


class Claims:
    """The claims of one builder in one folder that all builders of the schema share."""

    def __init__(self, spark: SparkSession, folder: str, lifetime: float = LIFETIME):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(folder)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.lifetime = lifetime
        self.held: dict[str, int] = {}

    def _file(self, name: str, number: int, suffix: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, f"{name.lower()}.{number}{suffix}")

    def _numbers(self, name: str) -> tuple[list[int], set[int]]:
        """The numbers of a model's claims in order, and those that were released."""
        stem = name.lower() + "."
        found, done = [], set()
        if self.fs.exists(self.path):
            for status in self.fs.listStatus(self.path):
                file = status.getPath().getName()
                number, _, rest = file.removeprefix(stem).partition(".")
                if file.startswith(stem) and number.isdigit():
                    if rest == "done":
                        done.add(int(number))
                    elif not rest:
                        found.append(int(number))
        return sorted(found), done

    def _create(self, path) -> bool:
        """Create an empty file; False where it is there already."""
        if self.fs.getUri().getScheme() == "file":
            try:  # the local file system of Hadoop looks first and creates then
                os.close(os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            except FileExistsError:
                return False
            return True
        try:
            self.fs.create(path, False).close()
        except Exception:
            if self.fs.exists(path):
                return False
            raise
        return True

    def open(self, name: str) -> bool:
        """Whether a builder has the model now."""
        return self._open(name, *self._numbers(name))

    def _open(self, name: str, numbers: list[int], done: set[int]) -> bool:
        return bool(numbers) and numbers[-1] not in done and not self._stale(self._file(name, numbers[-1]))

    def _stale(self, path) -> bool:
        return not self.fs.exists(path) or time.time() - self.fs.getFileStatus(path).getModificationTime() / 1000 > self.lifetime

    def take(self, name: str) -> int:
        self.fs.mkdirs(self.path)
        # One listing for both: a claim that came after a look at the open ones would be passed by the next number.
        numbers, done = self._numbers(name)
        if self._open(name, numbers, done):
            raise BuildConflict(f"another builder has {name}")
        number = max([0, *numbers, *done]) + 1
        if not self._create(self._file(name, number)):
            raise BuildConflict(f"another builder has {name}")
        if max(self._numbers(name)[0]) != number:  # others came and went since the listing
            self.fs.delete(self._file(name, number), False)
            raise BuildConflict(f"another builder has had {name}")
        self.held[name] = number
        for old in {*numbers, *done}:
            for suffix in ("", ".done"):
                self.fs.delete(self._file(name, old, suffix), False)
        return number

    def check(self, name: str) -> None:
        """Renew a claim that is still held; raise where another builder has come since."""
        if name not in self.held:
            return
        numbers, _ = self._numbers(name)
        if not numbers or numbers[-1] != self.held[name]:
            raise BuildConflict(f"another builder has taken {name} over; nothing was published")
        self.fs.setTimes(self._file(name, self.held[name]), int(time.time() * 1000), -1)

    def release(self, name: str) -> None:
        number = self.held.pop(name)
        if self._numbers(name)[0][-1:] == [number]:
            self._create(self._file(name, number, ".done"))

    @contextmanager
    def claimed(self, name: str):
        """Hold the model for the block; a claim already held by this builder is kept."""
        if name in self.held:
            yield
            return
        self.take(name)
        try:
            yield
        finally:
            self.release(name)
