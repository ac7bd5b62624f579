"""Uncompressed LAS point clouds as a batch data source whose partitions are ranges of points."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "file string, file_ord int, point_ord long, x double, y double, z double, classification short, red int, green int, blue int"
POINTS = 1_000_000
#: Fixed values of the format: place of the class byte and of the colours in each point format.
CLASS_AT = {0: 15, 1: 15, 2: 15, 3: 15, 6: 16, 7: 16, 8: 16}
COLOUR_AT = {2: 20, 3: 28, 7: 30, 8: 30}


def header(raw: bytes) -> dict:
    """Point format, record length and count, offset, scale and shift of a file's first 375 bytes."""
    if raw[:4] != b"LASF":
        raise ValueError("not a LAS file")
    minor = raw[25]
    start = struct.unpack_from("<I", raw, 96)[0]
    kind, length, count = struct.unpack_from("<BHI", raw, 104)
    if minor >= 4 and count == 0:
        count = struct.unpack_from("<Q", raw, 247)[0]
    if kind & 0x80:
        raise ValueError("compressed point clouds need a decoder that is not part of this library")
    if kind not in CLASS_AT:
        raise ValueError(f"point format {kind} is not supported")
    return {"kind": kind, "length": length, "count": count, "start": start, "scale": struct.unpack_from("<3d", raw, 131), "shift": struct.unpack_from("<3d", raw, 155)}


def decode(raw: bytes, h: dict) -> dict[str, np.ndarray]:
    """Columns of a run of point records; colours, stored in the upper byte, come back as 0 to 255."""
    rows = np.frombuffer(raw, np.uint8).reshape(-1, h["length"])
    place = rows[:, :12].copy().view("<i4")
    out = {c: place[:, k] * h["scale"][k] + h["shift"][k] for k, c in enumerate("xyz")}
    value = rows[:, CLASS_AT[h["kind"]]]
    out["classification"] = (value & 31 if h["kind"] < 6 else value).astype(np.int16)
    at = COLOUR_AT.get(h["kind"])
    if at is not None:
        rgb = rows[:, at : at + 6].copy().view("<u2") >> 8
        out |= {c: rgb[:, k].astype(np.int32) for k, c in enumerate(("red", "green", "blue"))}
    return out


class _Range(InputPartition):
    def __init__(self, file: str, file_ord: int, first: int, count: int):
        self.file, self.file_ord, self.first, self.count = file, file_ord, first, count


def _open(path: str):
    fs, name = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return fs.open_input_file(name)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = [f for f in options.get("files", options.get("path", "")).split(",") if f]
        self.points = int(options.get("points", POINTS))

    def partitions(self) -> list[_Range]:
        out = []
        for i, file in enumerate(self.files):
            with _open(file) as f:
                n = header(f.read(375))["count"]
            out += [_Range(file, i, lo, min(self.points, n - lo)) for lo in range(0, n, self.points)]
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        with _open(partition.file) as f:
            h = header(f.read(375))
            f.seek(h["start"] + partition.first * h["length"])
            cols = decode(f.read(partition.count * h["length"]), h)
        n = partition.count
        absent = pa.nulls(n, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([partition.file] * n), pa.array(np.full(n, partition.file_ord, np.int32)), pa.array(np.arange(partition.first, partition.first + n)), *[pa.array(cols[c]) for c in "xyz"],
                pa.array(cols["classification"]), *[pa.array(cols[c]) if c in cols else absent for c in ("red", "green", "blue")],
            ],
            names=["file", "file_ord", "point_ord", "x", "y", "z", "classification", "red", "green", "blue"],
        )


class LasSource(DataSource):
    """spark.dataSource.register(LasSource); spark.read.format("las").option("files", "a.las,b.las").load()"""

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


def write_las(path: str, x, y, z, classification, rgb=None, scale: float = 0.001) -> None:
    """A small version 1.4 file of point format 7, for tests and exports of single tiles."""
    n = len(x)
    rows = np.zeros((n, 36), np.uint8)
    shift = [float(np.floor(np.min(v))) if n else 0.0 for v in (x, y, z)]
    rows[:, :12] = np.stack([np.rint((np.asarray(v) - s) / scale) for v, s in zip((x, y, z), shift, strict=True)], axis=1).astype("<i4").view(np.uint8).reshape(n, 12)
    rows[:, 16] = classification
    if rgb is not None:
        rows[:, 30:36] = (np.asarray(rgb, np.uint16) << 8).astype("<u2").view(np.uint8).reshape(n, 6)
    head = bytearray(375)
    head[:4] = b"LASF"
    head[24:26] = bytes((1, 4))
    struct.pack_into("<HI", head, 94, 375, 375)
    struct.pack_into("<BHI", head, 104, 7, 36, 0)
    struct.pack_into("<3d3d", head, 131, scale, scale, scale, *shift)
    struct.pack_into("<Q", head, 247, n)
    with open(path, "wb") as f:
        f.write(bytes(head) + rows.tobytes())
