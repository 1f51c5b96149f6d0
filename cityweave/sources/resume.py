"""Jobs that may be killed at any time and run again, and results that appear whole or not at all.

Each step of a job is a written table with a marker beside it, in a folder of the shared scratch folder named after the job
and the version of its input. A rerun on the same input reads the marked steps instead of computing them; a changed
input starts anew. What a step writes in between lies in the same folder and is deleted when the step is done.

Results are written beside their place first. Only when all are written, with the expected number of rows, do they take the
place of the earlier ones; a rerun goes on with the replacing. Then the job's folder is deleted. Readers see the
earlier result until its replacement is complete, but for the moment between two renames.

Paths may be on any file system Spark can reach; files are looked at and moved through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cityweave.sources import scratch


class Files:
    """The few file operations that Spark's readers and writers lack."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def mark(self, path: str) -> None:
        system, place = self._at(path)
        system.create(place, True).close()

    def move(self, source: str, target: str) -> None:
        system, place = self._at(source)
        if not system.rename(place, self._at(target)[1]):
            raise OSError(f"cannot move {source} to {target}")

    def fact(self, path: str) -> str:
        system, place = self._at(path)
        status = system.getFileStatus(place)
        return f"{path} {status.getLen()} {status.getModificationTime()}"


def version_of(*frames: DataFrame) -> str:
    """Changes whenever a file that the frames read is added, removed or written again."""
    files = Files(frames[0].sparkSession)
    facts = [files.fact(path) for df in frames for path in sorted(df.inputFiles())]
    return hashlib.md5("\n".join(facts).encode()).hexdigest()


class Result(NamedTuple):
    """A table to publish: the frame, how many rows it must have (None: any), and how it is written to a path."""

    df: DataFrame
    rows: int | None
    write: Callable[[DataFrame, str], None]


class Job:
    """One run or rerun of a job. ``version`` names its input."""

    def __init__(self, spark: SparkSession, name: str, version: str):
        self.spark, self.version = spark, version
        self.files = Files(spark)
        self.folder = f"{scratch.shared_folder(spark)}/cityweave-jobs/{name}-{version}"

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table that ``make`` gives, computed unless an earlier run has finished it."""
        path, marker = f"{self.folder}/{name}", f"{self.folder}/{name}.done"
        if not self.files.exists(marker):
            with self._own_scratch():
                make().write.mode("overwrite").parquet(path)
            self.files.mark(marker)
        return self.spark.read.parquet(path)

    @contextmanager
    def _own_scratch(self) -> Iterator[None]:
        """What is written meanwhile goes at the end, shuffle files included; a killed run leaves it to the next one."""
        folder = f"{self.folder}/scratch"
        with scratch.inside(folder), scratch.shuffles_released(self.spark):
            yield
        self.files.delete(folder)

    def is_published(self, out: str) -> bool:
        return self.files.exists(f"{out}/_published-{self.version}")

    def publish(self, results: Mapping[str, Result], out: str) -> None:
        """Write all results below ``out`` in place of earlier ones, then delete what the job has written in between."""
        staged = {name: f"{out}/_staged-{self.version}/{name}" for name in results}
        marker = f"{self.folder}/staged.done"
        if not self.files.exists(marker):
            for name, result in results.items():
                self._stage(name, result, staged[name])
            self.files.mark(marker)
        for name, path in staged.items():
            if self.files.exists(path):  # else an earlier run has moved it
                self.files.delete(f"{out}/{name}")
                self.files.move(path, f"{out}/{name}")
        self.files.mark(f"{out}/_published-{self.version}")
        self.files.delete(f"{out}/_staged-{self.version}")
        self.files.delete(self.folder)

    def _stage(self, name: str, result: Result, path: str) -> None:
        seen = Observation()
        with self._own_scratch():
            result.write(result.df.observe(seen, F.count(F.lit(1)).alias("n")), path)
        if result.rows is not None and seen.get["n"] != result.rows:
            raise RuntimeError(f"{name} has {seen.get['n']} rows, not {result.rows}; nothing is replaced")
