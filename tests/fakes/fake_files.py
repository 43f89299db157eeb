"""A file that notes how many bytes were read of it."""

import io
import os


class Counted(io.BytesIO):
    def __init__(self, path, to):
        with open(path, "rb") as f:
            super().__init__(f.read())
        self.to = to

    def read(self, n=-1):
        data = super().read(n)
        with open(self.to, "a") as f:
            f.write(f"{len(data)}\n")
        return data


def counting(to):
    return lambda path: Counted(path, to)


def read_bytes(to):
    """All that was read since the last call."""
    n = sum(map(int, open(to))) if os.path.exists(to) else 0
    if os.path.exists(to):
        os.remove(to)
    return n
