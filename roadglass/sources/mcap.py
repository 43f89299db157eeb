"""Optional Python data source ``mcap``: one partition a file, filters on topic and time.

The container's reader is the public ``mcap`` package; without it the source
can't be registered and logs come in by the messages contract. Another module
with the same ``make_reader`` can stand in for it. Topics are found from the
files' summaries, without a message being read.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThanOrEqual, In, InputPartition, LessThanOrEqual

from . import messages

MODULE = "mcap.reader"
SUMMARY = "path string, topic string, schema_name string, messages long, start_ns long, end_ns long"


class File(InputPartition):
    def __init__(self, path: str, number: int):
        self.path, self.number = path, number


class Reader(DataSourceReader):
    def __init__(self, path: str, module: str = MODULE):
        self.path, self.module, self.topics, self.low, self.high = path, module, None, None, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("topic",):
                self.topics = {f.value} if self.topics is None else self.topics & {f.value}
            elif isinstance(f, In) and f.attribute == ("topic",):
                self.topics = set(f.value) if self.topics is None else self.topics & set(f.value)
            elif isinstance(f, GreaterThanOrEqual) and f.attribute == ("log_time_ns",):
                self.low = f.value if self.low is None else max(self.low, f.value)
            elif isinstance(f, LessThanOrEqual) and f.attribute == ("log_time_ns",):
                self.high = f.value if self.high is None else min(self.high, f.value)
            else:
                yield f

    def partitions(self):
        return [File(p, i) for i, p in enumerate(messages.bag_files(self.path))]

    def read(self, partition):
        with open(partition.path, "rb") as stream:
            found = importlib.import_module(self.module).make_reader(stream).iter_messages(topics=sorted(self.topics) if self.topics is not None else None, start_time=self.low, end_time=None if self.high is None else self.high + 1)
            for n, (schema, channel, message) in enumerate(found):
                yield channel.topic, schema.name if schema else None, message.log_time, partition.number, n, message.data


class McapSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mcap"

    def schema(self) -> str:
        return messages.SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("readermodule", MODULE))


def register(spark: SparkSession, module: str = MODULE) -> None:
    try:
        importlib.import_module(module)
    except ImportError as e:
        raise ImportError(f"{module} is needed to read .mcap files; other logs can be read by roadglass.sources.messages.read") from e
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(McapSource)


def read(spark: SparkSession, path: str, module: str = MODULE) -> DataFrame:
    """The messages of a file or of all files of a folder."""
    register(spark, module)
    return spark.read.format("mcap").option("readerModule", module).load(path)


def summaries(spark: SparkSession, path: str, module: str = MODULE) -> DataFrame:
    """(path, topic, schema_name, messages, start_ns, end_ns) of each file's topics, by its summary alone; times are the file's.

    Files without a summary are passed over; without statistics counts and times are null.
    """
    files = spark.createDataFrame([(p,) for p in messages.bag_files(path)], "path string")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_reader = importlib.import_module(module).make_reader
        for batch in batches:
            rows = []
            for name in batch["path"].to_pylist():
                with open(name, "rb") as stream:
                    told = make_reader(stream).get_summary()
                if told is None:  # files without a summary are passed over
                    continue
                facts = told.statistics
                for key, channel in sorted(told.channels.items()):
                    schema = told.schemas.get(channel.schema_id)
                    numbers = (facts.channel_message_counts.get(key, 0), facts.message_start_time, facts.message_end_time) if facts else (None,) * 3
                    rows.append((name, channel.topic, schema.name if schema else None, *numbers))
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["path", "topic", "schema_name", "messages", "start_ns", "end_ns"])

    return files.repartition(max(1, min(files.count(), 10_000)), "path").mapInArrow(look, SUMMARY)


def topics_by_schema(spark: SparkSession, path: str, schema_name: str, module: str = MODULE) -> DataFrame:
    """The topics of a schema in any file, in order of name, but for those of which statistics say that they have no messages."""
    return summaries(spark, path, module).where((F.col("schema_name") == schema_name) & (F.coalesce("messages", F.lit(1)) > 0)).select("topic").distinct().orderBy("topic")
