"""Binary files on the file system that Spark's paths name (any scheme that
pyarrow opens: a shared mount, hdfs, s3, gs)."""

from __future__ import annotations

import json

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def child(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """(path with scheme, size) of the files below ``path``, by name; names that
    begin with ``_`` or ``.`` are unfinished or private and left out."""
    where, root = locate(path)
    info = where.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    head = path[: len(path) - len(root)] if path.endswith(root) else ""
    found = where.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted(
        (head + f.path, f.size)
        for f in found
        if f.type == fs.FileType.File and f.path.endswith(suffix) and f.base_name[0] not in "_."
    )


def delete(paths: list[str]) -> None:
    for p in paths:
        where, name = locate(p)
        if where.get_file_info(name).type == fs.FileType.File:
            where.delete_file(name)


def write_json(path: str, value) -> None:
    where, name = locate(path)
    with where.open_output_stream(name) as out:
        out.write(json.dumps(value).encode())


def read_json(path: str):
    where, name = locate(path)
    with where.open_input_stream(name) as f:
        return json.loads(f.read())


def make_dir(path: str) -> None:
    where, name = locate(path)
    where.create_dir(name, recursive=True)
