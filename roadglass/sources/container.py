"""Message containers by their chunk index: parts of a file in many tasks, and a sink.

A container (the public ``.mcap`` format) holds its messages in chunks, and at its
end a summary: schemas, channels, counts, and for each chunk where it lies, its
times and which channels it has. ``chunks`` makes that a table, one task a file
and a few reads each; what a query does not need is filtered out of it like any
other table, and the rest is dealt to tasks by its bytes, neighbours together.
``read`` then reads each chunk by its range alone. So a file of 51 GB is read by
many tasks, and a topic or a minute of it costs the chunks that hold some of it.

Every Nth message of a topic, or its first n, are found before any chunk is read:
the index of each chunk tells how many messages a topic has there, sums of these
counts give the ordinal of its first one, and chunks without a wanted ordinal are
left out. Where chunks of a file overlap in time, ordinals can't be told from
counts; such files are read and numbered by a window.

``Sink`` is a Spark data source that writes: each task writes whole containers
into a hidden folder, the commit moves them into place, an abort deletes them.

Results by case: files without a summary are read from the front by one task and
have no statistics (``chunks`` gives them one row without a range); files that end
early give the messages up to there; chunks of no or zstd compression are read,
others are an error; null topics, schemas or data can't be written.

Paths have to be open to all machines; ``open_file`` can open them in another way.
"""

from __future__ import annotations

import io
import os
import shutil
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import messages

#: The format's mark and the codes of its records.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, MESSAGE_INDEX, CHUNK_INDEX, STATISTICS, SUMMARY_OFFSET, DATA_END = 1, 2, 3, 4, 5, 6, 7, 8, 11, 14, 15
#: Bytes of a task's chunks, and of a chunk that is written.
TASK_BYTES, CHUNK_BYTES = 64_000_000, 1_000_000
CHUNKS = (
    "path string, file_seq int, chunk int, offset long, length long, start_ns long, end_ns long, compression string, "
    "channels array<struct<id:int,topic:string,schema_name:string,count:long>>"
)
_CHANNELS = pa.list_(pa.struct([("id", pa.int32()), ("topic", pa.string()), ("schema_name", pa.string()), ("count", pa.int64())]))


class Fields:
    """Reads the fields of a record one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def number(self, form: str) -> int:
        (v,) = struct.unpack_from("<" + form, self.data, self.at)
        self.at += struct.calcsize(form)
        return v

    def raw(self) -> bytes:
        n = self.number("I")
        self.at += n
        return self.data[self.at - n : self.at]

    def text(self) -> str:
        return self.raw().decode("utf-8", "replace")

    def pairs(self, key: str, value: str) -> dict[int, int]:
        part, step = self.raw(), struct.calcsize("<" + key + value)
        return dict(struct.unpack_from("<" + key + value, part, i) for i in range(0, len(part) - step + 1, step))


def records(stream, end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(code, content) up to a place, or until the file ends, also in the middle of a record."""
    while end is None or stream.tell() < end:
        head = stream.read(9)
        if len(head) < 9:
            return
        code, size = struct.unpack("<BQ", head)
        if code == 0:
            return
        content = stream.read(size)
        if len(content) < size:
            return
        yield code, content


def _schema(f: Fields) -> tuple[int, tuple[str, str, str]]:
    """id, (name, encoding, definition)"""
    return f.number("H"), (f.text(), f.text(), f.text())


def _channel(f: Fields) -> tuple[int, tuple[int, str]]:
    """id, (schema id, topic)"""
    return f.number("H"), (f.number("H"), f.text())


class Summary:
    """What the end of a file tells; ``known`` is False where it tells nothing."""

    def __init__(self, stream):
        self.schemas: dict[int, tuple[str, str, str]] = {}
        self.channels: dict[int, tuple[int, str]] = {}
        self.counts: dict[int, int] | None = None
        self.start = self.end = None
        self.chunks: list[tuple[int, int, int, int, dict[int, int], str]] = []
        size = stream.seek(0, io.SEEK_END)
        self.known = False
        if size < 37 + len(MAGIC):
            return
        stream.seek(size - 37)
        tail = stream.read(37)
        if tail[29:] != MAGIC or tail[0] != FOOTER:
            return
        (begin,) = struct.unpack_from("<Q", tail, 9)
        if not begin:
            return
        self.known = True
        stream.seek(begin)
        for code, content in records(stream, size - 37):
            f = Fields(content)
            if code == SCHEMA:
                self.schemas.update([_schema(f)])
            elif code == CHANNEL:
                self.channels.update([_channel(f)])
            elif code == STATISTICS:
                f.at = 26
                self.start, self.end = f.number("Q"), f.number("Q")
                self.counts = f.pairs("H", "Q")
            elif code == CHUNK_INDEX:
                start, end, at, length = (f.number("Q") for _ in range(4))
                index = f.pairs("H", "Q")
                f.number("Q")
                self.chunks.append((at, length, start, end, index, f.text()))
        self.chunks.sort()

    def topic(self, channel: int) -> tuple[str, str | None]:
        schema, topic = self.channels[channel]
        return topic, self.schemas[schema][0] if schema in self.schemas else None


def _index_counts(stream, at: dict[int, int]) -> dict[int, int]:
    """Messages of each channel in a chunk, from the sizes of its index records."""
    out = {}
    for channel, offset in at.items():
        stream.seek(offset)
        head = stream.read(15)
        if len(head) == 15 and head[0] == MESSAGE_INDEX:
            out[channel] = struct.unpack_from("<I", head, 11)[0] // 16
    return out


Opener = Callable[[str], io.BufferedIOBase]


def _open(path: str):
    return open(path, "rb")


def _files(spark: SparkSession, path: str, suffix: str = ".mcap") -> DataFrame:
    files = messages.bag_files(path, suffix)
    return spark.createDataFrame(list(enumerate(files)), "file_seq int, path string").repartition(max(1, min(len(files), 10_000)), "path")


def chunks(spark: SparkSession, path: str, counts: bool = False, open_file: Opener = _open) -> DataFrame:
    """One row for each chunk of a file, or of all files of a folder, by their summaries; ``counts`` reads the chunks' indexes too."""

    def look(batches):
        for batch in batches:
            for seq, name in zip(batch.column("file_seq").to_pylist(), batch.column("path").to_pylist()):
                with open_file(name) as stream:
                    told = Summary(stream)
                    rows = []
                    for k, (at, length, start, end, index, compression) in enumerate(told.chunks):
                        n = _index_counts(stream, index) if counts else {}
                        channels = [(c, *told.topic(c), n.get(c)) for c in sorted(index) if c in told.channels]
                        rows.append((name, seq, k, at, length, start, end, compression, [dict(zip(("id", "topic", "schema_name", "count"), c)) for c in channels]))
                    if not told.known or (not rows and sum((told.counts or {0: 1}).values())):
                        rows = [(name, seq, 0, None, None, None, None, None, None)]  # to be read from the front
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _CHANNELS)
                names = ("path", "file_seq", "chunk", "offset", "length", "start_ns", "end_ns", "compression", "channels")
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return _files(spark, path).select("file_seq", "path").mapInArrow(look, CHUNKS)


def schemas(spark: SparkSession, path: str, open_file: Opener = _open) -> DataFrame:
    """(schema_name, encoding, definition), each once, of all files with a summary."""

    def look(batches):
        for batch in batches:
            for name in batch.column("path").to_pylist():
                with open_file(name) as stream:
                    found = list(Summary(stream).schemas.values())
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in range(3)], names=["schema_name", "encoding", "definition"])

    return _files(spark, path).mapInArrow(look, "schema_name string, encoding string, definition string").distinct()


def _unpacked(compression: str, data: bytes, size: int) -> bytes:
    if not compression:
        return data
    if compression == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(data, max_output_size=max(size, 1))
    raise ValueError(f"chunks of compression {compression} can't be read")


def _chunk_records(content: bytes) -> Iterator[tuple[int, bytes]]:
    f = Fields(content)
    _, _, size, crc = f.number("Q"), f.number("Q"), f.number("Q"), f.number("I")
    compression = f.text()
    n = f.number("Q")
    data = _unpacked(compression, content[f.at : f.at + n], size)
    if crc and zlib.crc32(data) != crc:
        raise ValueError("a chunk has another checksum than it should")
    yield from records(io.BytesIO(data))


def _messages(found: Iterator[tuple[int, bytes]], names: dict[int, tuple[str, str | None]], schemas_: dict[int, str]) -> Iterator[tuple[str, str | None, int, int, bytes]]:
    """(topic, schema name, log time, place, data); schemas and channels met on the way become known."""
    for place, (code, content) in enumerate(found):
        f = Fields(content)
        if code == SCHEMA:
            i, (name, _, _) = _schema(f)
            schemas_[i] = name
        elif code == CHANNEL:
            i, (schema, topic) = _channel(f)
            names[i] = (topic, schemas_.get(schema))
        elif code == MESSAGE:
            channel, _, time = f.number("H"), f.number("I"), f.number("Q")
            if channel in names:
                yield *names[channel], time, place, content[22:]


def _from_front(stream) -> Iterator[tuple[int, bytes]]:
    """All records of a file in order, those of chunks in their place."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a container")
    for code, content in records(stream):
        if code == CHUNK:
            yield from _chunk_records(content)
        elif code in (DATA_END, FOOTER):
            return
        else:
            yield code, content


def _dealt(wanted: DataFrame, task_bytes: int) -> DataFrame:
    """Chunks in tasks of about so many bytes, neighbours together."""
    total = wanted.agg(F.sum("length")).first()[0] or 0
    return wanted.repartitionByRange(max(1, -(-total // task_bytes)), "file_seq", "chunk").sortWithinPartitions("file_seq", "chunk")


def _read_chunks(wanted: DataFrame, topics: set[str] | None, low: int | None, high: int | None, open_file: Opener, every: int = 1, ordinals: bool = False) -> DataFrame:
    """The messages of chunks; with ``ordinals`` (first ordinal by topic, and the last one wanted, in the column of that name) only each ``every``-th of a topic."""
    extra = ["ordinals"] if ordinals else []

    def fetch(batches):
        stream, opened = None, None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if opened != row["path"]:
                        if stream:
                            stream.close()
                        stream, opened = open_file(row["path"]), row["path"]
                    first = {x["topic"]: [x["first"], x["limit"]] for x in row.get("ordinals") or ()}
                    if row["offset"] is None:
                        stream.seek(0)
                        found = _messages(_from_front(stream), {}, {})
                    else:
                        stream.seek(row["offset"])
                        content = stream.read(row["length"])[9:]
                        names = {c["id"]: (c["topic"], c["schema_name"]) for c in row["channels"]}
                        found = _messages(_chunk_records(content), names, {})
                    rows, size = [], 0
                    if ordinals:  # by time, as they are counted
                        found = sorted(found, key=lambda m: (m[2], m[3]))
                    for topic, schema, time, place, data in found:
                        if (topics is not None and topic not in topics) or (low is not None and time < low) or (high is not None and time > high):
                            continue
                        if ordinals:
                            if topic not in first:
                                continue
                            at = first[topic][0]
                            first[topic][0] += 1
                            if at % every or (first[topic][1] is not None and at >= first[topic][1]):
                                continue
                        rows.append((topic, schema, time, row["file_seq"], (row["chunk"] << 32) + place, data))
                        size += len(data)
                        if size > 8_000_000:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)
        finally:
            if stream:
                stream.close()

    return wanted.select("path", "file_seq", "chunk", "offset", "length", "channels", *extra).mapInArrow(fetch, messages.SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["topic", "schema_name", "log_time_ns", "file_seq", "msg_seq", "data"])


def _wanted(index: DataFrame, topics: list[str] | None, low: int | None, high: int | None) -> DataFrame:
    keep = F.lit(True)
    if topics is not None:
        keep &= F.exists("channels", lambda c: c["topic"].isin(topics))
    if low is not None:
        keep &= F.col("end_ns") >= low
    if high is not None:
        keep &= F.col("start_ns") <= high
    return index.where(F.col("offset").isNull() | keep)


def read(spark: SparkSession, path: str, topics: list[str] | None = None, low_ns: int | None = None, high_ns: int | None = None, task_bytes: int = TASK_BYTES, open_file: Opener = _open) -> DataFrame:
    """The messages of a file or a folder (``messages.SCHEMA``), of these topics and times; chunks without any are not read. ``msg_seq`` follows the place in the file."""
    index = _wanted(chunks(spark, path, open_file=open_file), topics, low_ns, high_ns)
    return _read_chunks(_dealt(index, task_bytes), None if topics is None else set(topics), low_ns, high_ns, open_file)


def read_sampled(spark: SparkSession, path: str, topics: list[str], every: int = 1, limit: int | None = None, task_bytes: int = TASK_BYTES, open_file: Opener = _open) -> DataFrame:
    """Of each topic every ``every``-th message, ``limit`` of them at most, counted over all files in order of file and time; only chunks that hold one are read."""
    index = _wanted(chunks(spark, path, True, open_file), topics, None, None)
    # per topic and chunk: the ordinal of the first message, by sums over files, then over the chunks of each
    each = index.select("file_seq", "chunk", "start_ns", "end_ns", F.explode("channels").alias("c")).where(F.col("c.topic").isin(topics))
    each = each.groupBy("file_seq", "chunk", "start_ns", "end_ns", F.col("c.topic").alias("topic")).agg(F.sum("c.count").alias("n"))
    in_file = Window.partitionBy("file_seq", "topic").orderBy("start_ns", "chunk")
    before = F.max("end_ns").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumns({"upto": F.sum("n").over(in_file) - F.col("n"), "overlaps": F.coalesce(F.col("start_ns") < before, F.lit(False)) | F.col("n").isNull()})
    files = each.groupBy("topic", "file_seq").agg(F.sum("n").alias("n"), F.max("overlaps").alias("overlaps"))
    if index.where("offset IS NULL").limit(1).count() or files.where("overlaps").limit(1).count():
        # counts can't tell: the topics' messages are numbered as they are
        w = Window.partitionBy("topic").orderBy(*messages.ORDER)
        rows = read(spark, path, topics, task_bytes=task_bytes, open_file=open_file).withColumn("at", F.row_number().over(w) - 1)
        return rows.where((F.col("at") % every == 0) & (F.lit(True) if limit is None else F.col("at") < limit * every)).drop("at")
    in_topic = Window.partitionBy("topic").orderBy("file_seq")
    files = files.select("topic", "file_seq", (F.sum("n").over(in_topic) - F.col("n")).alias("base"))
    first = each.join(files, ["topic", "file_seq"]).withColumn("first", F.col("base") + F.col("upto"))
    next_ = F.ceil(F.col("first") / every) * every
    wanted = (next_ < F.col("first") + F.col("n")) & (F.lit(True) if limit is None else next_ < limit * every)
    last = F.lit(None).cast("long") if limit is None else F.lit(limit * every).cast("long")
    told = first.where(wanted).groupBy("file_seq", "chunk").agg(F.collect_list(F.struct("topic", "first", last.alias("limit"))).alias("ordinals"))
    holds = index.join(told, ["file_seq", "chunk"])
    return _read_chunks(_dealt(holds, task_bytes), None, None, None, open_file, every, True)


# ---- writing ---------------------------------------------------------------------------


def _record(code: int, content: bytes) -> bytes:
    return struct.pack("<BQ", code, len(content)) + content


def _string(text: str | bytes) -> bytes:
    raw = text.encode() if isinstance(text, str) else text
    return struct.pack("<I", len(raw)) + raw


def _map(key: str, value: str, items: dict) -> bytes:
    return _string(b"".join(struct.pack("<" + key + value, k, v) for k, v in items.items()))


class ContainerFile:
    """Writes one container: messages in the order given, in chunks with an index, and the summary."""

    def __init__(self, stream, definitions: dict[str, str], compression: str, chunk_bytes: int):
        if compression not in ("", "zstd"):
            raise ValueError(f"chunks of compression {compression} can't be written")
        self.stream, self.definitions, self.compression, self.chunk_bytes = stream, definitions, compression, chunk_bytes
        self.at, self.schemas, self.channels, self.index = 0, {}, {}, []
        self.counts: dict[int, int] = {}
        self.start, self.end = None, None
        self._new()
        self._put(MAGIC + _record(HEADER, _string("ros2") + _string("roadglass")))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _new(self) -> None:
        self.body, self.marks, self.times = bytearray(), {}, []

    def add(self, topic: str, schema_name: str, time: int, data: bytes) -> None:
        if schema_name not in self.schemas:
            self.schemas[schema_name] = (i := len(self.schemas) + 1, record := _record(SCHEMA, struct.pack("<H", i) + _string(schema_name) + _string("ros2msg") + _string(self.definitions.get(schema_name, ""))))
            self.body += record
        if (topic, schema_name) not in self.channels:
            i = len(self.channels)
            self.channels[topic, schema_name] = (i, record := _record(CHANNEL, struct.pack("<HH", i, self.schemas[schema_name][0]) + _string(topic) + _string("cdr") + _string(b"")))
            self.body += record
        channel = self.channels[topic, schema_name][0]
        n = self.counts.get(channel, 0)
        self.marks.setdefault(channel, []).append((time, len(self.body)))
        self.counts[channel] = n + 1
        self.times.append(time)
        self.body += _record(MESSAGE, struct.pack("<HIQQ", channel, n & 0xFFFFFFFF, time, time) + data)
        if len(self.body) >= self.chunk_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.times:
            return
        raw, packed = bytes(self.body), bytes(self.body)
        if self.compression:
            import zstandard

            packed = zstandard.ZstdCompressor().compress(raw)
        low, high, begin = min(self.times), max(self.times), self.at
        self._put(_record(CHUNK, struct.pack("<QQQI", low, high, len(raw), zlib.crc32(raw)) + _string(self.compression) + struct.pack("<Q", len(packed)) + packed))
        length, offsets, size = self.at - begin, {}, self.at
        for channel, marks in self.marks.items():
            offsets[channel] = self.at
            self._put(_record(MESSAGE_INDEX, struct.pack("<H", channel) + _string(b"".join(struct.pack("<QQ", *m) for m in sorted(marks)))))
        self.index.append(_record(CHUNK_INDEX, struct.pack("<QQQQ", low, high, begin, length) + _map("H", "Q", offsets) + struct.pack("<Q", self.at - size) + _string(self.compression) + struct.pack("<QQ", len(packed), len(raw))))
        self.start = low if self.start is None else min(self.start, low)
        self.end = high if self.end is None else max(self.end, high)
        self._new()

    def close(self) -> None:
        self.flush()
        self._put(_record(DATA_END, struct.pack("<I", 0)))
        begin = self.at
        for _, record in (*self.schemas.values(), *self.channels.values()):
            self._put(record)
        facts = struct.pack("<QHIIIIQQ", sum(self.counts.values()), len(self.schemas), len(self.channels), 0, 0, len(self.index), self.start or 0, self.end or 0)
        self._put(_record(STATISTICS, facts + _map("H", "Q", self.counts)))
        for record in self.index:
            self._put(record)
        self._put(_record(FOOTER, struct.pack("<QQI", begin, 0, 0)) + MAGIC)


class _Part(WriterCommitMessage):
    def __init__(self, number: int, name: str | None, rows: int):
        self.number, self.name, self.rows = number, name, rows


class SinkWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.name = options["path"], options.get("name", "bag")
        self.compression, self.chunk_bytes = options.get("compression", ""), int(options.get("chunkbytes", CHUNK_BYTES))
        self.definitions = {k.removeprefix("definition."): v for k, v in options.items() if k.startswith("definition.")}
        self.overwrite = overwrite
        if os.path.exists(self.path) and not overwrite and (not os.path.isdir(self.path) or os.listdir(self.path)):
            raise FileExistsError(f"{self.path} exists; the mode overwrite replaces it")
        # beside the result, so that moving a part is a rename
        self.hidden = f"{self.path.rstrip('/')}.{uuid.uuid4().hex}.parts"

    def write(self, iterator) -> _Part:
        from pyspark import TaskContext

        context = TaskContext.get()
        os.makedirs(self.hidden, exist_ok=True)
        name = f"{self.hidden}/{context.partitionId():06d}-{context.taskAttemptId()}.mcap"
        rows, lower = 0, {k.lower(): v for k, v in self.definitions.items()}
        with open(name, "wb") as stream:
            out = ContainerFile(stream, {}, self.compression, self.chunk_bytes)
            for batch in iterator:
                columns = [batch.column(c).to_pylist() for c in ("topic", "schema_name", "log_time_ns", "data")]
                for topic, schema, time, data in zip(*columns):
                    if topic is None or schema is None or time is None or data is None:
                        raise ValueError("a message needs a topic, a schema, a time and data")
                    if schema not in out.definitions:
                        out.definitions[schema] = lower.get(schema.lower(), "")
                    out.add(topic, schema, time, data)
                    rows += 1
            out.close()
        if not rows and context.partitionId():  # the first part stays, so that an empty log is a container too
            os.remove(name)
            return _Part(context.partitionId(), None, 0)
        return _Part(context.partitionId(), name, rows)

    def commit(self, messages_: list[_Part | None]) -> None:
        """Moves the parts of the attempts that count into place, in order; an older result goes only now."""
        parts = sorted((m for m in messages_ if m is not None and m.name), key=lambda m: m.number)
        full = [m for m in parts if m.rows] or parts[:1]
        if self.overwrite and os.path.exists(self.path):
            (shutil.rmtree if os.path.isdir(self.path) else os.remove)(self.path)
        os.makedirs(self.path, exist_ok=True)
        for i, m in enumerate(full):
            os.rename(m.name, f"{self.path}/{self.name}_{i:06d}.mcap")
        shutil.rmtree(self.hidden, ignore_errors=True)

    def abort(self, messages_: list[_Part | None]) -> None:
        shutil.rmtree(self.hidden, ignore_errors=True)


class Sink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "container"

    def schema(self) -> str:
        return messages.SCHEMA

    def writer(self, schema, overwrite: bool) -> SinkWriter:
        return SinkWriter(dict(self.options), overwrite)


def write(log: DataFrame, path: str, definitions: dict[str, str] | None = None, name: str = "bag", compression: str = "", force: bool = False, parts: int | None = None, chunk_bytes: int = CHUNK_BYTES) -> None:
    """A log as a folder of containers (a split recording), in log order: ranges of it in one task each.

    ``definitions``: schema name to its text. An existing result is replaced only with ``force``.
    """
    spark = log.sparkSession
    spark.dataSource.register(Sink)
    rows = log.select("topic", "schema_name", "log_time_ns", "file_seq", "msg_seq", "data")
    rows = rows.repartitionByRange(parts, *messages.ORDER) if parts else rows.repartitionByRange(*messages.ORDER)
    writer = rows.sortWithinPartitions(*messages.ORDER).write.format("container").option("name", name).option("compression", compression).option("chunkBytes", chunk_bytes)
    for schema, text in (definitions or {}).items():
        writer = writer.option(f"definition.{schema}", text)
    writer.mode("overwrite" if force else "append").save(path)
