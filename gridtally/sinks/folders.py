"""Folders of any file system that Spark knows, and the lease that keeps writers of a table apart."""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LEASE = "_lease"
#: A writer that has not renewed its lease for so long counts as dead.
LEASE_SECONDS = 600.0
#: Time between two looks at a lease that another writer holds.
POLL_SECONDS = 0.5


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self.path = path.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self._hadoop.Path(self.path).getFileSystem(conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str = "") -> bool:
        return self._system.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        if not self.has(name):
            return []
        return [entry.getPath().getName() for entry in self._system.listStatus(self._at(name))]

    def delete(self, name: str) -> None:
        if self.has(name) and not self._system.delete(self._at(name), True):
            raise OSError(f"could not delete {name} in {self.path}")

    def move(self, name: str, to: str) -> None:
        if "/" in to:
            self._system.mkdirs(self._at(to.rpartition("/")[0]))
        if not self._system.rename(self._at(name), self._at(to)):
            raise OSError(f"could not move {name} to {to} in {self.path}")

    def modified(self, name: str) -> float:
        return self._system.getFileStatus(self._at(name)).getModificationTime() / 1000

    def write(self, name: str, text: str) -> None:
        stream = self._system.create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create(self, name: str) -> bool:
        """Makes an empty file; False if there is one. Of several callers one succeeds."""
        self._system.mkdirs(self._at(""))
        place = self._system.makeQualified(self._at(name))
        if place.toUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates later
            return self._jvm.java.io.File(place.toUri().getPath()).createNewFile()
        try:
            self._system.create(place, False).close()
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def read(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


class TableBusy(RuntimeError):
    """Another writer holds the table."""


class LeaseLost(RuntimeError):
    """Another writer has taken the table over."""


def scope_name(scope: str) -> str:
    """The scope as part of a file name that Spark's scans skip."""
    return "".join(c if re.fullmatch(r"[A-Za-z0-9]", c) else f"%{ord(c):X}" for c in scope)


class Lease:
    """The right to write to a folder, or to one scope of it.

    Leases are numbered files. A new one is made by creating the next number, which only
    one writer can do, and counts if it is the highest then; so a lease is never passed
    on by deleting it, and a writer that was taken for dead finds a higher number and stops.
    A lease is free once its owner has said so or has not renewed it for ``seconds``.
    """

    def __init__(self, spark: SparkSession, path: str, scope: str = "", seconds: float = LEASE_SECONDS):
        self.folder = Folder(spark, path)
        self.owner = uuid.uuid4().hex
        self.seconds = seconds
        self.number = 0
        self._prefix = f"{LEASE}-{scope_name(scope)}-"
        self._stop = threading.Event()
        self._thread: threading.Thread | None = None

    def _name(self, number: int) -> str:
        return f"{self._prefix}{number:012d}"

    def _numbers(self) -> list[int]:
        found = [n.removeprefix(self._prefix) for n in self.folder.names() if n.startswith(self._prefix)]
        return sorted(int(n) for n in found if n.isdigit())

    def _free(self, number: int) -> bool:
        try:
            text = self.folder.read(self._name(number))
            age = time.time() - self.folder.modified(self._name(number))
            released = bool(text) and json.loads(text)["released"]
        except Py4JJavaError as error:
            name = error.java_exception.getClass().getName()
            if "FileNotFound" in name or "Checksum" in name:
                return False  # being replaced or renewed; the next look will tell
            raise
        except ValueError:
            return False
        return released or age > self.seconds

    def _say(self, released: bool) -> None:
        self.folder.write(self._name(self.number), json.dumps({"owner": self.owner, "released": released}))

    def try_take(self) -> bool:
        numbers = self._numbers()
        if numbers and not self._free(numbers[-1]):
            return False
        number = numbers[-1] + 1 if numbers else 1
        if not self.folder.create(self._name(number)):
            return False
        if self._numbers()[-1] != number:
            self.folder.delete(self._name(number))
            return False
        self.number = number
        self._say(False)
        for old in numbers:
            self.folder.delete(self._name(old))
        self._thread = threading.Thread(target=self._renew, daemon=True)
        self._thread.start()
        return True

    def take(self, wait: float = 0.0) -> None:
        until = time.monotonic() + wait
        while not self.try_take():
            if time.monotonic() >= until:
                raise TableBusy(f"another writer holds {self.folder.path}")
            time.sleep(POLL_SECONDS)

    def check(self) -> None:
        """Fails if another writer has taken over."""
        numbers = self._numbers()
        if not numbers or numbers[-1] != self.number:
            raise LeaseLost(f"another writer has taken over {self.folder.path}")

    def _renew(self) -> None:
        while not self._stop.wait(self.seconds / 4):
            try:
                self.check()
                self._say(False)
            except LeaseLost:
                return
            except Py4JJavaError:
                continue  # the next try may succeed; if none does, the lease runs out

    def release(self) -> None:
        self._stop.set()
        if self._thread is not None:
            self._thread.join()
        if self.number in self._numbers()[-1:]:
            self._say(True)


@contextmanager
def leased(
    spark: SparkSession, path: str, scope: str = "", wait: float = 0.0, seconds: float = LEASE_SECONDS
) -> Iterator[Lease]:
    """Holds the lease of a folder; fails with ``TableBusy`` if it is not free after ``wait`` seconds."""
    lease = Lease(spark, path, scope, seconds)
    lease.take(wait)
    try:
        yield lease
    finally:
        lease.release()
