"""A stand-in for a bag reader: JSON lines as a bag, and a note of what was asked of it."""

import json
from types import SimpleNamespace


class Reader:
    def __init__(self, stream):
        self.path = stream.name
        self.rows = [json.loads(line) for line in stream]

    def _note(self, **asked):
        with open(self.path + ".asked", "a") as f:
            f.write(json.dumps(asked) + "\n")

    def iter_messages(self, topics=None, start_time=None, end_time=None):
        self._note(topics=topics, start=start_time, end=end_time)
        for r in self.rows:
            if (topics is None or r["topic"] in topics) and (start_time is None or r["t"] >= start_time) and (end_time is None or r["t"] < end_time):
                yield SimpleNamespace(name=r["schema"]), SimpleNamespace(topic=r["topic"]), SimpleNamespace(log_time=r["t"], data=r["data"].encode())

    def get_summary(self):
        self._note(summary=True)
        if "nosummary" in self.path:
            return None
        names = sorted({(r["topic"], r["schema"]) for r in self.rows})
        channels = {i: SimpleNamespace(topic=t, schema_id=i) for i, (t, _) in enumerate(names)}
        schemas = {i: SimpleNamespace(name=s) for i, (_, s) in enumerate(names)}
        counts = {i: sum((r["topic"], r["schema"]) == n for r in self.rows) for i, n in enumerate(names)}
        times = [r["t"] for r in self.rows] or [0]
        facts = SimpleNamespace(channel_message_counts=counts, message_start_time=min(times), message_end_time=max(times))
        return SimpleNamespace(channels=channels, schemas=schemas, statistics=None if "nostatistics" in self.path else facts)


def make_reader(stream):
    return Reader(stream)
