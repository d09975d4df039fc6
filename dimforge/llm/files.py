"""Files that tasks write to and read from the shared folder.

Spark's own writers have no format for raw bytes, so tasks use pyarrow's
file systems by URI (file, hdfs, s3, gs).  A task writes to a name of its own
and returns it in a row; only names in the committed rows count, so a task
that ran twice or was lost leaves at most a file that nothing reads.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def own_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    system, path = locate(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def open_input(uri: str):
    system, path = locate(uri)
    return system.open_input_file(path)


def put(uri: str, data: bytes) -> None:
    with open_output(uri) as out:
        out.write(data)


def get(uri: str) -> bytes:
    with open_input(uri) as f:
        return f.read()
