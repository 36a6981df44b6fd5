"""Files that tasks write themselves, under the shared folder."""

from __future__ import annotations

import numpy as np
from pyarrow import fs
from pyspark import TaskContext


def located(address: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of an address; Hadoop writes local ones with a single slash."""
    if address.startswith("file:/") and not address.startswith("file://"):
        address = address.removeprefix("file:")
    return fs.FileSystem.from_uri(address)


class Output:
    """A file that appears under its name only when it is complete."""

    def __init__(self, address: str):
        self.system, self.path = located(address)
        context = TaskContext.get()
        self.draft = f"{self.path}.{context.taskAttemptId() if context else 0}.part"
        self.system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.system.open_output_stream(self.draft, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.draft, self.path)


def mapped_words(address: str) -> np.ndarray:
    """A file of 64-bit words: mapped into memory where the file system is mounted, else read."""
    system, path = located(address)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, "<u8", "r")
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), "<u8")
