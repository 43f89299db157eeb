"""Shared helpers: table access, text slices for Arrow workers, written tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word in the digest columns: space, tab to carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The same for Java's regular expressions.
JAVA_SPACE = r"[\x20\x09-\x0D]+"
JAVA_WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
#: Rows that a Python worker turns into str at a time; bounds its memory beside the Arrow batch.
SLICE = 256
#: Files of a kept table for each core, and the size of a partition that gets one of its own anyway.
FILES, FILE_BYTES = 8, 16_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into small ones, without a copy."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """Apply a function to small slices of the columns, each a dict of Python lists.

    ``make`` runs once a task and returns the function, so that tables are
    loaded there and not for every slice. The function returns a dict of lists.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = make()
        for part in slices(batches):
            made = work(part.to_pydict())
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in out], schema=out)

    return df.select(*columns).mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and every executor can reach.

    That is spark.checkpoint.dir where it is set; else, with a local master, a
    folder of this machine becomes it. On a cluster it has to be set: a folder
    of one machine would lose what executors write.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        import tempfile

        top = Path(tempfile.mkdtemp(prefix="roadglass-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/roadglass-{uuid.uuid4().hex}"


_open: list[list[Workspace]] = []


@contextmanager
def scratch():
    """Within it, the tables that operators keep are deleted at its end: what reads them has to be written before."""
    _open.append([])
    try:
        yield
    finally:
        for work in _open.pop():
            work.only()


class Workspace:
    """Tables written to the shared folder, which cut lineage and outlive executors.

    A table has as many files as ``FILES`` for each core at most, or one for each
    ``FILE_BYTES`` that the optimizer expects if these are more: partitions beyond
    that are written one after the other, without a shuffle. Tables that a
    returned DataFrame reads stay until the end of a ``scratch``, if there is one.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.top, self.n, self.paths = spark, shared_dir(spark), 0, []
        for works in _open[-1:]:
            works.append(self)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.top}/{self.n:03d}-{name}"
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        df.coalesce(min(1_000_000, max(FILES * self.spark.sparkContext.defaultParallelism, size // FILE_BYTES))).write.parquet(path)
        self.paths.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._rg_path = path
        return out

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for df in frames:
            self._delete(df._rg_path)
            self.paths.remove(df._rg_path)

    def only(self, *frames: DataFrame) -> None:
        """Delete all tables but these; without any, the folder too."""
        stay = [df._rg_path for df in frames]
        for path in self.paths if stay else [self.top]:
            if path not in stay:
                self._delete(path)
        self.paths = stay


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty where it is null or has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, JAVA_SPACE))


def held_out(doc_id: Column) -> Column:
    """crc32 of the decimal id modulo 3 is 1; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
