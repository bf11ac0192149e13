"""Claims: of several runs of one name only the one that made the entry file goes on.

The file is created on condition that it does not exist, in one step on the local disk and
on HDFS. A store that lets the later of two creations win is covered less tightly: the file
holds its run's token, and a run whose token is gone stops where it next asks.

A run that dies with its driver leaves its claim. It is not taken for dead by its age, since
a long run would be too: whoever starts the run again says ``take_over``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ClaimLost(RuntimeError):
    """Another run holds the claim."""


@dataclass(frozen=True)
class Claim:
    spark: SparkSession
    path: str
    token: str

    def _file(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def holder(self) -> str | None:
        """The token in the file, none where there is no file."""
        at, system = self._file()
        if not system.exists(at):
            return None
        stream = system.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def require(self) -> None:
        """Stops a run that has lost its claim."""
        held = self.holder()
        if held != self.token:
            raise ClaimLost(f"{self.path} is held by {held or 'nobody'}, not by {self.token}")

    def make(self, take_over: bool = False) -> None:
        at, system = self._file()
        if take_over:
            system.delete(at, False)
        system.mkdirs(at.getParent())
        if not self._create(at, system):
            raise ClaimLost(f"{self.path} is held by {self.holder()}; if that run is dead, start with take_over")
        self.require()

    def _create(self, at, system) -> bool:
        if system.getUri().getScheme() == "file":
            # Hadoop's local file system looks and creates in two steps.
            try:
                with open(at.toUri().getPath(), "xb") as file:
                    file.write(self.token.encode())
            except FileExistsError:
                return False
            return True
        try:
            stream = system.create(at, False)
        except Py4JJavaError as failed:
            if system.exists(at):
                return False
            raise failed
        stream.write(bytearray(self.token.encode()))
        stream.close()
        return True

    def release(self) -> None:
        if self.holder() == self.token:
            at, system = self._file()
            system.delete(at, False)


@contextmanager
def claimed(spark: SparkSession, path: str, token: str, take_over: bool = False) -> Iterator[Claim]:
    """Holds the claim while the block runs; another run's claim stops it before it starts."""
    claim = Claim(spark, path, token)
    claim.make(take_over)
    try:
        yield claim
    finally:
        claim.release()
