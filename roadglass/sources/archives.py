"""Archives as a sink that streams, and members of archives by their byte ranges.

``write`` makes a tar file of each shard's members. A task gets whole shards in
order and writes members as they come: header, bytes, padding; neither a shard nor
an index of one is held in memory, so a shard is bounded by the disk. Where each
member's bytes lie goes into an index, one Parquet part a task, beside the
archives. Tasks write into a hidden folder; the commit moves what the counted
attempts wrote, an abort deletes it.

``bodies`` reads members by path, offset and size, wherever these come from: rows
are dealt by their place, a task opens a file once, and ranges that nearly touch
are read as one.

A member takes a block of 512 bytes for its header and whole blocks for its bytes,
so very short bodies would make archives many times their size. ``bundles`` makes
members of many lines, and ``lines`` takes them apart again.

Results by case: a null name or body is an error, as is a name that doesn't fit a
header or comes twice in a shard; empty bodies are members; a range that is null
gives a null body, one beyond the end of its file an error; a table without rows
gives an empty index.
"""

from __future__ import annotations

import gzip
import os
import shutil
import tarfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

MEMBERS = "shard string, member string, body binary"
INDEX = "shard string, member string, offset long, size long"
_INDEX = pa.schema([("shard", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("size", pa.int64())])
#: Ranges closer than that are read as one, of so many bytes at most unless one range is longer; bytes of a task.
GAP, MERGED, TASK_BYTES = 64_000, 8_000_000, 64_000_000
#: Lines, and their bytes, that a task holds while it makes bundles of them.
LINES, LINE_BYTES = 1 << 17, 32_000_000
_BLOCK = 512


class TarStream:
    """Writes one archive member by member, and tells where each lies."""

    def __init__(self, path: str):
        self.stream, self.at, self.last = open(path, "wb"), 0, None

    def add(self, name: str, body: bytes) -> int:
        if name == self.last:
            raise ValueError(f"member {name} comes twice")
        info = tarfile.TarInfo(name)
        info.size = len(body)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        self.stream.write(head)
        self.stream.write(body)
        self.stream.write(b"\0" * (-len(body) % _BLOCK))
        start, self.last = self.at + len(head), name
        self.at = start + len(body) + -len(body) % _BLOCK
        return start

    def close(self) -> None:
        self.stream.write(b"\0" * (2 * _BLOCK))
        self.stream.close()


class _Part(WriterCommitMessage):
    def __init__(self, folder: str):
        self.folder = folder


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        if os.path.isdir(self.path) and os.listdir(self.path) and not overwrite:
            raise FileExistsError(f"{self.path} exists; the mode overwrite replaces it")
        self.hidden = f"{self.path}.{uuid.uuid4().hex}.parts"

    def write(self, iterator) -> _Part:
        from pyspark import TaskContext

        folder = f"{self.hidden}/{TaskContext.get().taskAttemptId()}"
        os.makedirs(folder)
        tar, shard, rows = None, None, []
        with pq.ParquetWriter(f"{folder}/index.parquet", _INDEX) as index:

            def flush():
                if rows:
                    index.write_batch(pa.RecordBatch.from_pylist(rows, schema=_INDEX))
                    rows.clear()

            for batch in iterator:
                for name, member, body in zip(*(batch.column(c).to_pylist() for c in ("shard", "member", "body"))):
                    if name is None or member is None or body is None:
                        raise ValueError("a member needs a shard, a name and bytes")
                    if name != shard:
                        if tar:
                            tar.close()
                        tar, shard = TarStream(f"{folder}/{name}.tar"), name
                    rows.append({"shard": name, "member": member, "offset": tar.add(member, body), "size": len(body)})
                    if len(rows) >= 10_000:
                        flush()
            if tar:
                tar.close()
            flush()
        return _Part(folder)

    def commit(self, messages: list[_Part | None]) -> None:
        """Moves archives and index parts by renaming; their number is that of the tasks and shards."""
        if self.overwrite and os.path.isdir(self.path):
            shutil.rmtree(self.path)
        os.makedirs(f"{self.path}/index")
        for i, m in enumerate(m for m in messages if m is not None):
            for name in os.listdir(m.folder):
                to = f"index/part-{i:06d}.parquet" if name == "index.parquet" else name
                os.rename(f"{m.folder}/{name}", f"{self.path}/{to}")
        shutil.rmtree(self.hidden, ignore_errors=True)

    def abort(self, messages: list[_Part | None]) -> None:
        shutil.rmtree(self.hidden, ignore_errors=True)


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return MEMBERS

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(dict(self.options), overwrite)


def write(members: DataFrame, path: str, shard: str = "shard", name: str = "member", body: str = "body", parts: int | None = None, force: bool = False) -> DataFrame:
    """One archive for each shard, its members in order of name; returns the index (shard, member, offset, size)."""
    spark = members.sparkSession
    spark.dataSource.register(Archives)
    rows = members.select(F.col(shard).cast("string").alias("shard"), F.col(name).alias("member"), F.col(body).cast("binary").alias("body"))
    rows = rows.repartition(parts, "shard") if parts else rows.repartition("shard")
    rows.sortWithinPartitions("shard", "member").write.format("archives").mode("overwrite" if force else "append").save(path)
    return index(spark, path)


def bundles(rows: DataFrame, shard: str = "shard", kind: str = "kind", line: str = "line", held: int = LINES) -> DataFrame:
    """Members (shard, member, body) of many lines: those of one shard and kind among ``held`` rows of a task, compressed, as ``{task}-{number}.{kind}.gz``.

    Every row is a line of one member; lines hold no line breaks.
    """
    def pack(batches):
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        some, n, size = [], 0, 0

        def flush():
            table = pa.Table.from_batches(some).sort_by([("shard", "ascending"), ("kind", "ascending")]).combine_chunks()
            shards, kinds = (table.column(c).combine_chunks().dictionary_encode() for c in ("shard", "kind"))
            codes = [c.indices.to_numpy(zero_copy_only=False) for c in map(_one, (shards, kinds))]
            new = np.flatnonzero(np.r_[True, (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])])
            ends = np.r_[new[1:], table.num_rows]
            lines_ = table.column("line").to_pylist()
            names = [f"{task:06d}-{number:06d}.{k}.gz" for k in table.column("kind").take(pa.array(new)).to_pylist()]
            packed = [gzip.compress("\n".join(lines_[a:b]).encode(), 1, mtime=0) for a, b in zip(new, ends)]
            return pa.RecordBatch.from_arrays([pa.array(table.column("shard").take(pa.array(new)).to_pylist(), pa.string()), pa.array(names, pa.string()), pa.array(packed, pa.binary())], names=["shard", "member", "body"])

        for batch in batches:
            some.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= held or size >= LINE_BYTES:
                yield flush()
                some, n, size, number = [], 0, 0, number + 1
        if n:
            yield flush()

    return rows.select(F.col(shard).cast("string").alias("shard"), F.col(kind).cast("string").alias("kind"), F.col(line).cast("string").alias("line")).mapInArrow(pack, MEMBERS)


def _one(array):
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def lines(rows: DataFrame, body: str = "body") -> DataFrame:
    """(line): the lines of bundles."""
    def unpack(batches):
        for batch in batches:
            for packed in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(gzip.decompress(packed.as_py()).decode().split("\n"), pa.string())], names=["line"])

    return rows.select(body).mapInArrow(unpack, "line string")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(shard, member, offset, size) of all archives of a folder."""
    return spark.read.schema(INDEX).parquet(f"{path.rstrip('/')}/index")


def _open(path: str):
    return open(path, "rb")


def bodies(ranges: DataFrame, path: str = "path", offset: str = "offset", size: str = "size", body: str = "body", task_bytes: int = TASK_BYTES, open_file: Callable = _open) -> DataFrame:
    """The rows with the bytes that lie at their path, offset and size."""
    keep = ranges.columns
    schema = ", ".join([*(f"`{c}` {ranges.schema[c].dataType.simpleString()}" for c in keep), f"`{body}` binary"])
    total = ranges.agg(F.sum(size)).first()[0] or 0
    dealt = ranges.repartitionByRange(max(1, -(-total // task_bytes)), path, offset).sortWithinPartitions(path, offset)

    def fetch(batches):
        stream, opened = None, None
        try:
            for batch in batches:
                where = list(zip(*(batch.column(c).to_pylist() for c in (path, offset, size))))
                start = 0
                while start < len(where):
                    name, low, n = where[start]
                    if name is None or low is None or n is None:
                        yield _with_body(batch.slice(start, 1), [None], body)
                        start += 1
                        continue
                    # all that nearly touches the first range goes into one read
                    stop, high = start + 1, low + n
                    while stop < len(where) and where[stop][0] == name and None not in where[stop] and where[stop][1] <= high + GAP and max(high, where[stop][1] + where[stop][2]) - low <= MERGED:
                        high = max(high, where[stop][1] + where[stop][2])
                        stop += 1
                    if name != opened:
                        if stream:
                            stream.close()
                        stream, opened = open_file(name), name
                    stream.seek(low)
                    data = stream.read(high - low)
                    if len(data) < high - low:
                        raise ValueError(f"{name} ends before byte {high}")
                    yield _with_body(batch.slice(start, stop - start), [data[a - low : a - low + m] for _, a, m in where[start:stop]], body)
                    start = stop
        finally:
            if stream:
                stream.close()

    return dealt.mapInArrow(fetch, schema)


def _with_body(batch: pa.RecordBatch, data: list[bytes | None], name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, name])


def parts(frames: DataFrame, folder: str, names: dict[str, str], key: list[str], **how) -> DataFrame:
    """(key, part, body): the bodies of several members of each frame of an index of frames.

    ``names``: part to the column with its archive's file name; offset and size are in ``{part}_offset`` and ``{part}_size``. Parts that a frame lacks have no row.
    """
    each = F.array(*[F.struct(F.lit(p).alias("part"), F.concat(F.lit(folder.rstrip("/") + "/"), F.col(file)).alias("path"), F.col(f"{p}_offset").cast("long").alias("offset"), F.col(f"{p}_size").cast("long").alias("size")) for p, file in names.items()])
    rows = frames.select(*key, F.explode(each).alias("_p")).select(*key, "_p.*").where("path IS NOT NULL AND offset IS NOT NULL AND size IS NOT NULL")
    return bodies(rows, **how).drop("path", "offset", "size")
