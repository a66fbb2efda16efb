"""A lock file with a lease, so that one build at a time works on a warehouse.

The lock holds its owner's token. A thread of the owner keeps writing a beat
file of that token; whoever finds the lock looks at the beat: a beat younger
than the lease, by the store's own clock, or one that changes while it is
watched, is that of a live build, however old the lock is. Only a beat that
stands still for a whole lease is that of a dead one, and its lock is moved
away (one contender succeeds) before a new one is created.

An owner that was cut off so long that it lost its lock learns so from
``check``, which a build calls before it publishes.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Seconds without a beat after which a build counts as dead.
LEASE_SECONDS = 120.0


class LockHeld(RuntimeError):
    """Another build is at work."""


class Lease:
    def __init__(self, spark: SparkSession, path: str, seconds: float) -> None:
        self.path, self.seconds, self.token = path, seconds, uuid.uuid4().hex
        self._spark = spark
        self._jvm = spark.sparkContext._jvm
        self._lock = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._lock.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._stop = threading.Event()
        self._beaten = 0.0
        self._thread: threading.Thread | None = None

    # -- files

    def _at(self, suffix: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}.{suffix}")

    def _write(self, at, text: str, overwrite: bool) -> None:
        stream = self._fs.create(at, overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _read(self, at) -> str | None:
        """The file's line, empty if it can't be read; None if there is no file."""
        try:
            stream = self._fs.open(at)
        except Py4JJavaError:
            return None
        try:
            reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return reader.readLine() or ""
        except Py4JJavaError:
            return ""
        finally:
            stream.close()

    def _modified(self, at) -> int | None:
        try:
            return self._fs.getFileStatus(at).getModificationTime()
        except Py4JJavaError:
            return None

    # -- the owner's side

    def _beat(self) -> None:
        self._write(self._at(self.token), str(time.time()), True)
        self._beaten = time.monotonic()

    def _keep_beating(self) -> None:
        while not self._stop.wait(self.seconds / 6):
            try:
                self._beat()
            except Py4JJavaError:  # the store is away; ``check`` tells if it lasted too long
                continue

    def check(self) -> None:
        """Raise if the lock is not, or may no longer be, this build's."""
        if self._read(self._lock) != self.token or time.monotonic() - self._beaten > self.seconds:
            raise LockHeld(f"the lock {self.path} was lost")

    def acquire(self) -> None:
        self._beat()
        try:
            while True:
                try:
                    self._write(self._lock, self.token, False)
                    break
                except Py4JJavaError:
                    self._take_over()
        except BaseException:
            self._fs.delete(self._at(self.token), False)
            raise
        self._beat()  # a takeover may have taken a lease
        self._thread = threading.Thread(target=self._keep_beating, daemon=True, name="lakestar-lease")
        self._thread.start()

    def release(self) -> None:
        self._stop.set()
        if self._thread is not None:
            self._thread.join()
        if self._read(self._lock) == self.token:
            self._fs.delete(self._lock, False)
        self._fs.delete(self._at(self.token), False)

    # -- a contender's side

    def _take_over(self) -> None:
        """Move a dead build's lock away; raise if the build lives."""
        holder = self._read(self._lock)
        if holder is None:
            return  # released meanwhile
        held = LockHeld(f"another build holds {self.path}")
        beat = self._at(holder) if holder else self._lock  # a lock without a token was left while it was created
        before = self._modified(beat)
        self._beat()  # a fresh file gives the store's time
        now = self._modified(self._at(self.token))
        if before is not None and now - before < 1000 * self.seconds:
            raise held
        waited = time.monotonic()
        while time.monotonic() - waited < self.seconds:
            time.sleep(self.seconds / 12)
            if self._read(self._lock) is None:
                return
            if self._read(self._lock) != holder or self._modified(beat) != before:
                raise held
        away = self._at(f"dead-{uuid.uuid4().hex}")
        try:
            moved = self._fs.rename(self._lock, away)
        except Py4JJavaError:
            moved = False
        if not moved:
            return  # another contender moved it
        if self._read(away) != holder:  # a new owner's, moved by mistake
            self._fs.rename(away, self._lock)
            raise held
        self._fs.delete(away, False)
        if holder:
            self._fs.delete(self._at(holder), False)


@contextmanager
def held(spark: SparkSession, path: str, seconds: float = LEASE_SECONDS) -> Iterator[Lease]:
    lease = Lease(spark, path, seconds)
    lease.acquire()
    try:
        yield lease
    finally:
        lease.release()
