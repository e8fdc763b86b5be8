"""Lists of the files that make up a folder of tables, so that a write is seen as a whole.

A write stores its files beside those that are there, under names of its own, and
then one list ``_manifest-<number>.json`` with the names and sizes of all files that
count from now on. Readers take the list with the largest number; a folder without
one is what it holds. A list appears by one rename, so a reader sees the files of
one write and never parts of two.

Two writes that end at the same time take turns by the rename: the later one counts.
"""

from __future__ import annotations

import json
import sys
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX = "_manifest-", ".json"
Files = list[tuple[str, int]]


def _numbers(system: fs.FileSystem, folder: str) -> list[int]:
    """Numbers of all lists in a folder, ascending."""
    entries = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    names = [f.base_name for f in entries if f.type == fs.FileType.File]
    digits = [n[len(PREFIX) : -len(SUFFIX)] for n in names if n.startswith(PREFIX) and n.endswith(SUFFIX)]
    return sorted(int(d) for d in digits if d.isdigit())


def _name(folder: str, number: int) -> str:
    return f"{folder}/{PREFIX}{number:010d}{SUFFIX}"


def _load(system: fs.FileSystem, folder: str, number: int) -> Files:
    with system.open_input_stream(_name(folder, number)) as stream:
        return [(name, size) for name, size in json.loads(stream.read())]


def current_files(system: fs.FileSystem, folder: str) -> Files | None:
    """(name below the folder, size) of the files that count; None without a list.

    A list that a write has removed meanwhile is looked up again.
    """
    for _ in range(10):
        numbers = _numbers(system, folder)
        if not numbers:
            return None
        try:
            return _load(system, folder, numbers[-1])
        except FileNotFoundError:
            continue
    raise FileNotFoundError(f"lists of {folder} go faster than they can be read")


def publish(system: fs.FileSystem, folder: str, files: Files) -> int:
    """Make ``files`` those that count from now on; returns the number of the list."""
    number = (_numbers(system, folder) or [0])[-1] + 1
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(json.dumps(files).encode())
    system.move(draft, _name(folder, number))
    return number


def withdraw(system: fs.FileSystem, folder: str, number: int) -> None:
    """Remove a list, if it is the only one; the folder is what it holds again."""
    if _numbers(system, folder) == [number]:
        remove(system, [_name(folder, number)])


def remove(system: fs.FileSystem, paths: list[str]) -> None:
    """Remove files, many at a time; those that are gone already do not matter."""

    def one(path: str) -> None:
        try:
            system.delete_file(path)
        except FileNotFoundError:
            pass

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(one, paths))


def remove_before(system: fs.FileSystem, folder: str, number: int) -> None:
    """Remove the lists before ``number``, and the files that no list from there on names."""
    numbers = _numbers(system, folder)
    old = [n for n in numbers if n < number]
    named = {name for n in numbers if n >= number for name, _ in _load(system, folder, n)}
    unnamed = {name for n in old for name, _ in _load(system, folder, n)} - named
    remove(system, [_name(folder, n) for n in old])
    remove(system, [f"{folder}/{name}" for name in sorted(unnamed)])
