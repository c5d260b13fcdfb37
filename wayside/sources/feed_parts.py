"""Feed files in parts: byte ranges that end between two entities.

A serialised feed message is a row of fields, each a key, a length and that many bytes. A
scan reads keys and lengths only and jumps over the bytes, so it is cheap; the ranges it
finds are then read and decoded by as many tasks as there is work for, whatever the size of
a file. A part is a valid message by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayside.shipping import ship_package
from wayside.storage import open_folder, qualified, settle

#: Bytes of a part, unless one entity is larger; bytes dealt to a task; bytes a scan reads at once.
PART, DEALT, BLOCK = 8 << 20, 64 << 20, 1 << 20

PARTS = "path string, start bigint, end bigint, entities bigint, header binary"

# Field numbers of a feed message, and wire types of the encoding.
HEADER, ENTITY = 1, 2
VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5


class Field(NamedTuple):
    number: int
    start: int
    body: int
    end: int


class _Bytes:
    """A file's bytes by place, a block of them in memory."""

    def __init__(self, file, size: int, block: int):
        self.file, self.size, self.block = file, size, block
        self.start, self.held = 0, b""

    def __getitem__(self, at: int) -> int:
        if at >= self.size:
            raise ValueError("the file ends inside a message")
        place = at - self.start
        if not 0 <= place < len(self.held):
            self.file.seek(at)
            self.start, self.held, place = at, self.file.read(min(self.block, self.size - at)), 0
        return self.held[place]


def _varint(data, at: int) -> tuple[int, int]:
    value = 0
    for shift in range(0, 70, 7):
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
    raise ValueError("a number of more than ten bytes")


def outer_fields(file, size: int, block: int = BLOCK) -> Iterator[Field]:
    """The fields of a message in an open file, without what is in them."""
    data, at = _Bytes(file, size, block), 0
    while at < size:
        start = at
        key, at = _varint(data, at)
        kind, body = key & 7, at
        if kind == BYTES:
            length, body = _varint(data, at)
            at = body + length
        elif kind == VARINT:
            _, at = _varint(data, at)
        elif kind in (FIXED64, FIXED32):
            at += 8 if kind == FIXED64 else 4
        else:
            raise ValueError(f"wire type {kind}")
        if at > size:
            raise ValueError("the file ends inside a message")
        yield Field(key >> 3, start, body, at)


def parts(file, size: int, most: int = PART, block: int = BLOCK) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, end, entities, header fields) of a file's parts of `most` bytes or a single field."""
    start, end, entities, header = 0, 0, 0, b""
    for field in outer_fields(file, size, block):
        if field.end - start > most and end > start:
            yield start, end, entities, header
            start, entities, header = end, 0, b""
        end = field.end
        entities += field.number == ENTITY
        if field.number == HEADER:
            file.seek(field.start)
            header += file.read(field.end - field.start)
    if end > start:
        yield start, end, entities, header


def scan(spark: SparkSession, root: str, most: int = PART) -> DataFrame:
    """One row for each part of every `.pb` file below a path, any depth of `dt=` folders.

    Only names and lengths are read by the driver's listing, and keys and lengths by the scan.
    A file without a byte holds no message and is passed over.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pb").option("recursiveFileLookup", True)
    listed = files.load(qualified(spark, root)).select("path", "length")

    def find(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size in zip(batch["path"], batch["length"], strict=True):
                with open_file(path) as file:
                    held = []
                    try:
                        for part in parts(file, size, most):
                            held.append((path, *part))
                            if len(held) == 10_000:
                                yield pd.DataFrame(held, columns=_NAMES)
                                held = []
                    except ValueError as error:
                        raise ValueError(f"{path}: {error}") from error
                if held:
                    yield pd.DataFrame(held, columns=_NAMES)

    return listed.mapInPandas(find, PARTS)


_NAMES = [part.split()[0] for part in PARTS.split(", ")]


def dealt(found: DataFrame, each: int = DEALT) -> DataFrame:
    """The parts, written once and dealt out to a task for every `each` bytes."""
    found = settle(found, "feed-parts")
    size = found.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    return found.repartition(max(1, -(-size // each)))


def open_file(path: str):
    files, name = open_folder(path)
    return files.open_input_file(name)


def read_part(path: str, start: int, end: int) -> bytes:
    with open_file(path) as file:
        file.seek(start)
        return file.read(end - start)
