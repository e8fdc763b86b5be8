"""File layout of DBF tables: header, field descriptors, listing and byte ranges.

Everything here handles a few hundred header bytes or a list of files; records
are handled by :mod:`ledgerleaf.sources.dbf`.
"""

from __future__ import annotations

import datetime
import struct
import sys
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle

from ledgerleaf.sources.manifest import current_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sizes and marks of the format.
HEADER_SIZE = 32
DESCRIPTOR_SIZE = 32
TERMINATOR = 0x0D
END_OF_FILE = b"\x1a"
VERSION = 0x03
LIVE_FLAG = b" "
DELETED_FLAG = b"*"
NAME_LENGTH = 10
FIRST_YEAR = 1900

_HEADER = "<4BLHH20x"
_DESCRIPTOR = "<11sc4xBB14x"


@dataclass(frozen=True)
class DbfField:
    name: str
    type: str
    length: int
    decimals: int = 0

    def __post_init__(self) -> None:
        if not 1 <= self.length <= 255:
            raise ValueError(f"field {self.name}: length {self.length} is not within 1 to 255")


@dataclass(frozen=True)
class DbfHeader:
    version: int
    last_update: datetime.date | None
    n_records: int
    header_length: int
    record_length: int
    fields: tuple[DbfField, ...]


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path, for plain paths and URIs such as ``hdfs://``."""
    if path.startswith("s3a://"):
        path = "s3://" + path.removeprefix("s3a://")
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_dbf(path: str) -> list[tuple[str, int]]:
    """(path, size) of a DBF file, or of all below a folder; scheme left out.

    A folder that a write has listed holds the files of its list.
    """
    system, inner = open_path(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    listed = current_files(system, inner)
    if listed is not None:
        return sorted((f"{inner.rstrip('/')}/{name}", size) for name, size in listed)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(
        (f.path, f.size)
        for f in found
        if f.type == fs.FileType.File
        and f.extension.lower() == "dbf"
        and not any(part.startswith(("_", ".")) for part in f.path[len(inner) :].split("/"))
    )


def _update_date(year: int, month: int, day: int) -> datetime.date | None:
    try:
        return datetime.date(FIRST_YEAR + year, month, day)
    except ValueError:
        return None


def _field(raw: bytes) -> DbfField:
    name, kind, length, decimals = struct.unpack(_DESCRIPTOR, raw)
    text = name.split(b"\0")[0].decode("ascii").strip()
    if not text or not text.isprintable():
        raise ValueError(f"field name {name!r} cannot be read")
    return DbfField(text, kind.decode("latin-1"), length, decimals)


def read_header(stream, permissive: bool = False) -> DbfHeader:
    """Header and field descriptors, from the start of an open file.

    A descriptor that cannot be read is an error; if ``permissive``, the fields
    before it are kept.
    """
    head = stream.read(HEADER_SIZE)
    if len(head) < HEADER_SIZE:
        raise ValueError(f"header has {len(head)} bytes instead of {HEADER_SIZE}")
    version, year, month, day, n_records, header_length, record_length = struct.unpack(_HEADER, head)
    if header_length < HEADER_SIZE + 1:
        raise ValueError(f"header length {header_length} is too small")
    body = stream.read(header_length - HEADER_SIZE)
    fields: list[DbfField] = []
    for at in range(0, len(body) - DESCRIPTOR_SIZE + 1, DESCRIPTOR_SIZE):
        raw = body[at : at + DESCRIPTOR_SIZE]
        if raw[0] == TERMINATOR:
            break
        try:
            fields.append(_field(raw))
        except ValueError:
            if not permissive:
                raise
            break
    if not fields:
        raise ValueError("no field descriptors found")
    needed = 1 + sum(f.length for f in fields)
    if needed > record_length:
        raise ValueError(f"fields need {needed} bytes, records have {record_length}")
    return DbfHeader(
        version,
        _update_date(year, month, day),
        n_records,
        header_length,
        record_length,
        tuple(fields),
    )


def header_bytes(fields: list[DbfField], n_records: int, today: datetime.date) -> bytes:
    """Header of a file with these fields and number of records."""
    head = struct.pack(
        _HEADER,
        VERSION,
        today.year - FIRST_YEAR,
        today.month,
        today.day,
        n_records,
        HEADER_SIZE + DESCRIPTOR_SIZE * len(fields) + 1,
        record_length(fields),
    )
    described = [
        struct.pack(
            _DESCRIPTOR, f.name.encode("ascii"), f.type.encode("ascii"), f.length, f.decimals
        )
        for f in fields
    ]
    return head + b"".join(described) + bytes([TERMINATOR])


def record_length(fields: list[DbfField]) -> int:
    return 1 + sum(f.length for f in fields)
