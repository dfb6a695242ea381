"""Binary files in shared storage, written and read by tasks.

A path is a URI that ``pyarrow.fs`` knows (a plain absolute path is local).
A task writes files with names of its own attempt and reports them in its
result rows; the stored report lists the files of finished attempts only, so
what a lost or speculative task leaves behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def create(folder: str, suffix: str):
    """(path, stream) of a new file of this task's attempt."""
    at = TaskContext.get()
    name = f"part-{at.partitionId():06d}-{at.taskAttemptId()}-{uuid.uuid4().hex[:8]}{suffix}"
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return f"{folder}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def open_input(path: str):
    system, path = fs.FileSystem.from_uri(path)
    return system.open_input_file(path)
