"""Polygon files (.shp, .shx, .dbf, .prj, .cpg) as a Spark data source.

Reading: a Spark job looks at the indexes and attribute headers of all files; the index gives
the byte range of every record, so a file is cut into ranges of records of about equal size that
are parsed by many tasks. Attributes are read before shapes, and `where` leaves shapes that
nobody asks for unparsed. Writing: every task writes files of
its own and the driver publishes them when all have succeeded. Files are opened through
pyarrow's file systems, so paths may be local or on shared storage.

    spark.read.format("shapefile").schema(...).load(path)
    df.write.format("shapefile").mode("overwrite").save(folder)
"""

import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

# File layout constants of the format.
FILE_CODE, VERSION, HEADER_BYTES = 9994, 1000, 100
POLYGON_TYPES = (5, 15, 25)  # plain, with z, with m: x and y lie at the same place in all three

# Coordinate systems recognised by their names.
PRJ = {
    2154: 'PROJCS["RGF93_Lambert_93",GEOGCS["GCS_RGF_1993",DATUM["D_RGF_1993",SPHEROID["GRS_1980",6378137.0,298.257222101]],'
    'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],PROJECTION["Lambert_Conformal_Conic"],'
    'PARAMETER["False_Easting",700000.0],PARAMETER["False_Northing",6600000.0],PARAMETER["Central_Meridian",3.0],'
    'PARAMETER["Standard_Parallel_1",44.0],PARAMETER["Standard_Parallel_2",49.0],'
    'PARAMETER["Latitude_Of_Origin",46.5],UNIT["Meter",1.0]]',
    4326: 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],'
    'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]',
}

RINGS_ARROW = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
RINGS_SPARK = T.ArrayType(T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in "xy"])))
ORIGIN = ["rings", "srid", "source_path", "record"]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it; plain paths are local."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return pafs.LocalFileSystem(), os.path.abspath(path)


def _side_file(path: str, suffix: str) -> str:
    return path[: path.rfind(".")] + suffix


def _read(files: pafs.FileSystem, path: str, start: int = 0, size: int | None = None) -> bytes:
    with files.open_input_file(path) as f:
        f.seek(start)
        return f.read(size)


def _read_optional(files: pafs.FileSystem, path: str) -> bytes | None:
    found = files.get_file_info(path).type == pafs.FileType.File
    return _read(files, path) if found else None


@dataclass
class Field:
    name: str
    kind: str
    width: int
    decimals: int
    offset: int

    def spark_type(self) -> T.DataType:
        if self.kind in "NF":
            return T.DoubleType() if self.decimals or self.kind == "F" else T.LongType()
        return T.StringType()


@dataclass
class AttributeTable:
    """Header of a .dbf file."""

    records: int
    start: int
    width: int
    fields: list[Field]

    @classmethod
    def of(cls, files: pafs.FileSystem, path: str) -> "AttributeTable":
        records, start, width = struct.unpack("<IHH", _read(files, path, 4, 8))
        head = _read(files, path, 32, start - 32)
        fields, offset = [], 1
        for at in range(0, len(head) - 31, 32):
            if head[at] == 0x0D:
                break
            name = head[at : at + 11].split(b"\0")[0].decode("latin-1").strip()
            fields.append(Field(name, chr(head[at + 11]), head[at + 16], head[at + 17], offset))
            offset += head[at + 16]
        return cls(records, start, width, fields)


def _srid(prj: bytes | None) -> int | None:
    text = (prj or b"").decode("utf-8", "replace").replace(" ", "_").replace("-", "_").upper()
    if "PROJCS" in text and "LAMBERT_93" in text:
        return 2154
    if text.startswith("GEOGCS") and ("WGS" in text or "RGF" in text):
        return 4326
    return None


def _shape_files(path: str) -> list[str]:
    """Every .shp file at or below a path."""
    files, inner = _open(path)
    info = files.get_file_info(inner)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = files.get_file_info(pafs.FileSelector(inner, recursive=True))
    prefix = path.rstrip("/")
    root = inner.rstrip("/")
    return sorted(
        prefix + f.path[len(root) :] for f in found if f.is_file and f.path.lower().endswith(".shp") and "/_" not in f.path[len(root) :]
    )


@dataclass
class RecordRange(InputPartition):
    path: str
    first: int
    last: int


#: Records and bytes of a range, and index entries looked at together.
TASK_RECORDS, TASK_BYTES, INDEX_ROWS = 50_000, 16 << 20, 1 << 20


def cut_records(path: str, per_task: int = TASK_RECORDS, task_bytes: int = TASK_BYTES) -> list[int]:
    """Where the ranges of a file begin, and its number of records at the end.

    By the lengths in the index: a range has at most per_task records and task_bytes bytes, or
    one record that is larger.
    """
    files, inner = _open(path)
    side = _side_file(inner, ".shx")
    records = (files.get_file_info(side).size - HEADER_BYTES) // 8
    cuts = []
    with files.open_input_file(side) as index:
        for first in range(0, records, INDEX_ROWS):
            size = min(INDEX_ROWS, records - first)
            words = np.frombuffer(index.read_at(8 * size, HEADER_BYTES + 8 * first), ">i4")
            ends = np.cumsum(words[1::2].astype(np.int64) * 2 + 8)
            at = 0
            while at < size:
                cuts.append(first + at)
                before = int(ends[at - 1]) if at else 0
                fit = int(np.searchsorted(ends, before + task_bytes, side="right"))
                at = min(max(fit, at + 1), at + per_task, size)
    return [*cuts, records]


class ShapefileReader(DataSourceReader):
    """Parses ranges of records into Arrow batches."""

    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.wanted = {name.lower() for name in schema.names}
        self.per_task = int(options.get("recordsPerPartition", TASK_RECORDS))
        self.task_bytes = int(options.get("bytesPerPartition", TASK_BYTES))
        self.cuts = options.get("cuts")
        self.where = {k: set(v) for k, v in json.loads(options.get("where") or "{}").items()}
        self.per_batch = int(options.get("recordsPerBatch", 2_000))
        self.encoding = options.get("encoding")
        self.paths = [] if self.cuts else _requested(options)

    def partitions(self) -> list[InputPartition]:
        """The ranges found by the planning job, or else by a look at each index here."""
        if self.cuts:
            found = json.loads(self.cuts)
            self.cuts = None  # of no use to the tasks
        else:
            found = {path: cut_records(path, self.per_task, self.task_bytes) for path in self.paths}
        ranges = [RecordRange(path, a, b) for path, cuts in found.items() for a, b in zip(cuts[:-1], cuts[1:])]
        return ranges or [RecordRange("", 0, 0)]

    def _asked_for(self, rows: np.ndarray, fields: dict[str, Field], encoding: str) -> np.ndarray:
        """Positions of the records that are not deleted and whose attributes `where` allows.

        A key of `where` names one column, or several with a bar between them, of which the first that the file has counts.
        """
        keep = rows[:, 0] != ord("*")
        for names, allowed in self.where.items():
            found = [fields[n] for n in names.lower().split("|") if n in fields]
            if not found:
                return np.zeros(0, np.int64)
            texts = _values(rows, found[0], encoding).cast(pa.string())
            keep = keep & np.array([t in allowed for t in texts.to_pylist()], bool)
        return np.flatnonzero(keep)

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, inner = _open(partition.path)
        table = AttributeTable.of(files, _side_file(inner, ".dbf"))
        page = (_read_optional(files, _side_file(inner, ".cpg")) or b"").decode("ascii", "replace").strip()
        encoding = self.encoding or {"": "utf-8", "1252": "cp1252", "88591": "latin-1"}.get(page, page)
        srid = _srid(_read_optional(files, _side_file(inner, ".prj")))
        with (
            files.open_input_file(inner) as shapes,
            files.open_input_file(_side_file(inner, ".shx")) as index,
            files.open_input_file(_side_file(inner, ".dbf")) as attributes,
        ):
            for first in range(partition.first, partition.last, self.per_batch):
                size = min(first + self.per_batch, partition.last) - first
                words = np.frombuffer(index.read_at(8 * size, HEADER_BYTES + 8 * first), ">i4")
                offsets, lengths = words.reshape(-1, 2).astype(np.int64).T * 2
                rows = np.frombuffer(
                    attributes.read_at(table.width * size, table.start + table.width * first), np.uint8
                ).reshape(-1, table.width)
                at = self._asked_for(rows, {f.name.lower(): f for f in table.fields}, encoding)
                if not len(at):
                    continue
                rows, offsets, lengths = rows[at], offsets[at], lengths[at]
                columns = {
                    "srid": pa.array([srid] * len(at), pa.int32()),
                    "source_path": pa.array([partition.path] * len(at)),
                    "record": pa.array(first + at),
                }
                if "rings" in self.wanted:
                    start = int(offsets.min())
                    content = shapes.read_at(int((offsets + lengths).max()) + 8 - start, start)
                    columns["rings"] = _rings(content, offsets - start + 8)
                for field in table.fields:
                    if field.name.lower() in self.wanted:
                        columns[field.name.lower()] = _values(rows, field, encoding)
                yield self._batch(columns, len(at))

    def _batch(self, columns: dict, size: int) -> pa.RecordBatch:
        """The requested columns; those a file does not have are NULL."""
        arrays = []
        for field in self.schema.fields:
            kind = RINGS_ARROW if field.name == "rings" else _arrow_type(field.dataType)
            found = columns.get(field.name.lower())
            arrays.append(pa.nulls(size, kind) if found is None else found.cast(kind))
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {
        T.StringType: pa.string(),
        T.DoubleType: pa.float64(),
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
    }[type(kind)]


def _rings(content: bytes, starts: np.ndarray) -> pa.Array:
    """Polygons of one batch as nested lists built from offsets."""
    ring_ends, point_counts, coordinates, empty = [0], [], [], []
    for at in starts:
        at = int(at)
        kind = struct.unpack_from("<i", content, at)[0]
        if kind in POLYGON_TYPES:
            parts, points = struct.unpack_from("<2i", content, at + 36)
            first = np.frombuffer(content, "<i4", parts, at + 44)
            point_counts.append(np.diff(np.append(first, points)))
            coordinates.append(np.frombuffer(content, "<f8", 2 * points, at + 44 + 4 * parts))
            ring_ends.append(ring_ends[-1] + parts)
        elif kind == 0:
            ring_ends.append(ring_ends[-1])
        else:
            raise ValueError(f"shape type {kind} is no polygon")
        empty.append(kind == 0)
    xy = np.concatenate(coordinates) if coordinates else np.empty(0)
    ends = np.concatenate([[0], np.cumsum(np.concatenate(point_counts))]) if point_counts else np.zeros(1)
    points = pa.StructArray.from_arrays([pa.array(xy[0::2].copy()), pa.array(xy[1::2].copy())], ["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), points)
    # a NULL offset marks a missing geometry
    offsets = pa.array(ring_ends, pa.int32(), mask=np.append(np.array(empty, dtype=bool), False))
    return pa.ListArray.from_arrays(offsets, rings)


def _values(rows: np.ndarray, field: Field, encoding: str) -> pa.Array:
    """One attribute column; blank and unreadable numbers are NULL."""
    cells = np.ascontiguousarray(rows[:, field.offset : field.offset + field.width]).view(f"S{field.width}").ravel()
    texts = [c.decode(encoding).strip(" \0") for c in cells.tolist()]
    if field.kind not in "NF":
        return pa.array([t or None for t in texts], pa.string())
    convert = float if isinstance(field.spark_type(), T.DoubleType) else int
    kind = pa.float64() if convert is float else pa.int64()
    try:
        return pa.array([t or None for t in texts], pa.string()).cast(kind)
    except pa.ArrowInvalid:  # some cell is no number, or not written as Arrow reads it
        return pa.array([_number(t, convert) for t in texts], kind)


def _number(text: str, convert):
    try:
        return convert(text)
    except ValueError:
        return None


# ---------------------------------------------------------------- writing


@dataclass
class WrittenFiles(WriterCommitMessage):
    folders: list[str]


class ShapefileWriter(DataSourceArrowWriter):
    """Each task writes <folder>/_staging-<id>/<part>/<layer>.*; commit publishes the parts."""

    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.schema = schema
        self.path = options["path"]
        self.layer = options.get("layer", "layer")
        self.srid = int(options.get("srid", 2154))
        self.max_bytes = int(options.get("maxFileBytes", 256 * 1024 * 1024))
        self.width = int(options.get("stringWidth", 80))
        self.overwrite = overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        files, root = _open(self.path)
        folders, part = [], _Part(self)
        for batch in iterator:
            shapes, start = _Shapes(batch.column("rings")), 0
            sizes = np.cumsum(shapes.record_bytes() + part.row_bytes)
            while start < batch.num_rows:
                before = int(sizes[start - 1]) if start else 0
                # a part is full with the record that takes it over the limit
                stop = int(np.searchsorted(sizes, before + self.max_bytes - part.bytes, side="right")) + 1
                stop = min(max(stop, start + 1), batch.num_rows)
                part.add(shapes, batch, start, stop)
                start = stop
                if part.bytes > self.max_bytes:
                    folders.append(part.save(files, root))
                    part = _Part(self)
        if part.records:
            folders.append(part.save(files, root))
        return WrittenFiles(folders)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        files, root = _open(self.path)
        files.create_dir(root, recursive=True)
        old = []
        if self.overwrite:
            found = files.get_file_info(pafs.FileSelector(root))
            old = [i.path for i in found if i.type == pafs.FileType.Directory and i.base_name.startswith("part-")]
        for message in messages:
            for folder in message.folders if message else []:
                files.move(f"{root}/{self.staging}/{folder}", f"{root}/{folder}")
        for path in old:  # only now that what replaces it is in place
            files.delete_dir(path)
        self._drop_staging(files, root)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        self._drop_staging(*_open(self.path))

    def _drop_staging(self, files: pafs.FileSystem, root: str) -> None:
        staging = f"{root}/{self.staging}"
        if files.get_file_info(staging).type == pafs.FileType.Directory:
            files.delete_dir(staging)


def _runs(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers first[i] ... first[i] + n[i] - 1 in turn, and the place of each in its run."""
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(first, n) + within, within


class _Shapes:
    """The outlines of a batch as records, put together for many features at a time."""

    def __init__(self, rings: pa.ListArray):
        lists = rings.values
        points = lists.values
        self.xy = np.column_stack([points.field(c).to_numpy(zero_copy_only=False) for c in "xy"]).astype("<f8").reshape(-1, 2)
        ring_at, self.point_at = rings.offsets.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
        self.ring, last = ring_at[:-1], ring_at[1:]
        self.points = self.point_at[last] - self.point_at[self.ring]
        drawn = (self.points > 0) & ~rings.is_null().to_numpy(zero_copy_only=False)
        self.rings, self.points = np.where(drawn, last - self.ring, 0), np.where(drawn, self.points, 0)

    def _content(self) -> np.ndarray:
        """Numbers of four bytes in each record behind its header: 11, the rings, the points; 1 without a shape."""
        return np.where(self.rings > 0, 11 + self.rings + 4 * self.points, 1)

    def record_bytes(self) -> np.ndarray:
        return 4 * (2 + self._content())

    def records(self, start: int, stop: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows start to stop as words of four bytes, the words behind each header, and corners of the shapes' boxes (n x 4)."""
        content = self._content()[start:stop]
        base = np.cumsum(content + 2) - content - 2
        out = np.zeros(int((content + 2).sum()), "<u4")
        out[base] = np.arange(number, number + stop - start, dtype=">u4").view("<u4")
        out[base + 1] = (2 * content).astype(">u4").view("<u4")
        full = np.flatnonzero(self.rings[start:stop])
        if not len(full):
            return out, content, np.zeros((0, 4))
        at, rings, points, ring = base[full], *(a[start:stop][full] for a in (self.rings, self.points, self.ring))
        first = self.point_at[ring]
        which, place = _runs(first, points)
        xy, heads = self.xy[which], np.cumsum(points) - points
        boxes = np.hstack([np.minimum.reduceat(xy, heads), np.maximum.reduceat(xy, heads)])
        out[at + 2], out[at + 11], out[at + 12] = 5, rings, points
        out[(at + 3)[:, None] + np.arange(8)] = np.ascontiguousarray(boxes).view("<u4")
        out[np.repeat(at + 13 + rings, points)[:, None] + 4 * place[:, None] + np.arange(4)] = np.ascontiguousarray(xy).view("<u4")
        which, place = _runs(ring, rings)
        out[np.repeat(at + 13, rings) + place] = self.point_at[which] - np.repeat(first, rings)
        return out, content, boxes


def short_names(names: list[str]) -> list[str]:
    """Column names cut to the ten characters the format allows, numbered where they collide."""
    taken: list[str] = []
    for name in names:
        short, n = name[:10], 1
        while short in taken:
            short, n = f"{name[: 10 - len(str(n))]}{n}", n + 1
        taken.append(short)
    return taken


class _Part:
    """One set of files, held in memory up to the size limit and written in one go."""

    def __init__(self, writer: ShapefileWriter):
        self.writer = writer
        self.columns = [f for f in writer.schema.fields if f.name not in ORIGIN]
        self.shp, self.shx, self.dbf = [], [], []
        self.row_bytes = 1 + sum(self._kind(f)[1] for f in self.columns)
        self.records = self.bytes = 0
        self.next_offset = HEADER_BYTES
        self.box = np.array([np.inf, np.inf, -np.inf, -np.inf])

    def add(self, shapes: _Shapes, batch: pa.RecordBatch, start: int, stop: int) -> None:
        words, content, boxes = shapes.records(start, stop, self.records + 1)
        offsets = self.next_offset // 2 + 2 * (np.cumsum(content + 2) - content - 2)
        cells = [self._cells(batch.column(f.name).slice(start, stop - start), f) for f in self.columns]
        rows = np.hstack([np.full((stop - start, 1), ord(" "), np.uint8), *cells])
        self.shp.append(words.tobytes())
        self.shx.append(np.column_stack([offsets, 2 * content]).astype(">i4").tobytes())
        self.dbf.append(rows.tobytes())
        if len(boxes):
            self.box = np.hstack([np.minimum(self.box[:2], boxes[:, :2].min(axis=0)), np.maximum(self.box[2:], boxes[:, 2:].max(axis=0))])
        self.records += stop - start
        self.next_offset += 4 * len(words)
        self.bytes += 4 * len(words) + rows.size

    def _kind(self, field: T.StructField) -> tuple[str, int, int]:
        if isinstance(field.dataType, T.DoubleType):
            return "F", 24, 15
        if isinstance(field.dataType, (T.IntegerType, T.LongType)):
            return "N", 20, 0
        if isinstance(field.dataType, T.StringType):
            return "C", self.writer.width, 0
        raise TypeError(f"column {field.name} of type {field.dataType.simpleString()} has no place in the format")

    def _cells(self, values: pa.Array, field: T.StructField) -> np.ndarray:
        """Cells of one column as rows of bytes: text to the left, numbers to the right, NULL blank."""
        kind, width, _ = self._kind(field)
        if kind == "C":
            longest = pc.max(pc.binary_length(values)).as_py() or 0
            if longest > width:
                raise ValueError(f"{field.name} holds {longest} bytes; raise option stringWidth (at most 254)")
            texts = [b"" if v is None else v.encode("utf-8").ljust(width) for v in values.to_pylist()]
        else:
            texts = [b"" if v is None else repr(v).rjust(width).encode("ascii") for v in values.to_pylist()]
        return np.frombuffer(b"".join(t or b" " * width for t in texts), np.uint8).reshape(len(texts), width)

    def save(self, files: pafs.FileSystem, root: str) -> str:
        """Write the files below the staging folder under a name no other attempt uses."""
        folder = f"part-{uuid.uuid4().hex}"
        target = f"{root}/{self.writer.staging}/{folder}"
        files.create_dir(target, recursive=True)
        box = self.box if self.box[0] <= self.box[2] else [0.0] * 4

        def header(size: int) -> bytes:
            return (
                struct.pack(">7i", FILE_CODE, 0, 0, 0, 0, 0, size // 2)
                + struct.pack("<2i", VERSION, 5)
                + struct.pack("<8d", *box, 0.0, 0.0, 0.0, 0.0)
            )

        fields = b""
        for name, field in zip(short_names([f.name for f in self.columns]), self.columns):
            kind, width, decimals = self._kind(field)
            fields += struct.pack("<11sc4xBB14x", name.encode("ascii"), kind.encode("ascii"), width, decimals)
        table = struct.pack("<4BIHH20x", 3, 100, 1, 1, self.records, 33 + len(fields), self.row_bytes)
        contents = {
            ".shp": [header(self.next_offset), *self.shp],
            ".shx": [header(HEADER_BYTES + 8 * self.records), *self.shx],
            ".dbf": [table, fields, b"\r", *self.dbf, b"\x1a"],
            ".prj": [PRJ[self.writer.srid].encode("ascii")],
            ".cpg": [b"UTF-8"],
        }
        for suffix, pieces in contents.items():
            with files.open_output_stream(f"{target}/{self.writer.layer}{suffix}") as out:
                for piece in pieces:  # not joined first, which would hold the part twice
                    out.write(piece)
        return folder


# ---------------------------------------------------------------- registration


def _requested(options: dict) -> list[str]:
    """Files named in option 'paths' (a JSON list), or all files below 'path'."""
    if options.get("paths"):
        return json.loads(options["paths"])
    return _shape_files(options["path"])


def file_fields(path: str) -> list[list[str]]:
    """[name, type] of the attributes of a file, in their order."""
    files, inner = _open(path)
    return [[f.name, f.spark_type().simpleString()] for f in AttributeTable.of(files, _side_file(inner, ".dbf")).fields]


class ShapefileDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> T.StructType:
        """Attributes of all files, in the order they are met, then rings, srid, source_path and record.

        Names are compared without case. A column that files type differently is text if one of
        them says so, else a double.
        """
        names: dict[str, str] = {}
        types: dict[str, T.DataType] = {}
        kinds = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType()}
        told = self.options.get("fields")
        for name, kind in json.loads(told) if told else [f for path in _requested(self.options) for f in file_fields(path)]:
            low, kind = name.lower(), kinds[kind]
            names.setdefault(low, name)
            if types.setdefault(low, kind) != kind:
                both = (types[low], kind)
                types[low] = T.StringType() if T.StringType() in both else T.DoubleType()
        return T.StructType(
            [T.StructField(names[low], types[low]) for low in names]
            + [
                T.StructField("rings", RINGS_SPARK),
                T.StructField("srid", T.IntegerType()),
                T.StructField("source_path", T.StringType()),
                T.StructField("record", T.LongType()),
            ]
        )

    def reader(self, schema: T.StructType) -> ShapefileReader:
        return ShapefileReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> ShapefileWriter:
        return ShapefileWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make format('shapefile') known to the session."""
    spark.dataSource.register(ShapefileDataSource)


def _planned(per_task: int, task_bytes: int):
    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = batch["path"].tolist()
            cuts = [cut_records(p, per_task, task_bytes) for p in paths]
            yield pd.DataFrame({"path": paths, "cuts": cuts, "fields": [json.dumps(file_fields(p)) for p in paths]})

    return plan


def list_shapefiles(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """Column `path`: every .shp file at or below a path, or the listed ones. Only listings are used."""
    if not isinstance(source, str):
        return spark.createDataFrame([(p,) for p in source], "path string")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[sS][hH][pP]")
    return listing.load(source).select("path")


def read_shapefiles(
    spark: SparkSession, source: str | list[str], kind: str | None = None, where: dict[str, list[str]] | None = None, **options
) -> DataFrame:
    """Polygon features below a folder, or of the listed files.

    kind 'pg', 'ia', 'commune' or 'department' gives the columns the pipeline expects, filled
    with NULL where a file lacks one; without it the columns of all files are taken. `where`
    keeps the features whose attribute is one of a list, such as {"code_insee|insee_dep": ["75"]};
    other shapes are not even parsed. A Spark job reads the indexes and headers of all files;
    the driver holds the cut points, about one for each 16 MB of shapes (option bytesPerPartition).
    """
    from cropmosaic.schemas import FILE_SCHEMAS

    register(spark)
    per_task, task_bytes = int(options.get("recordsPerPartition", TASK_RECORDS)), int(options.get("bytesPerPartition", TASK_BYTES))
    paths = list_shapefiles(spark, source)
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = paths.repartition(tasks, "path").mapInPandas(_planned(per_task, task_bytes), "path string, cuts array<bigint>, fields string")
    found = sorted(files.collect(), key=lambda r: r["path"])
    reader = spark.read.format("shapefile").options(**options)
    reader = reader.option("cuts", json.dumps({r["path"]: r["cuts"] for r in found})).option("where", json.dumps(where or {}))
    if kind is not None:
        return reader.schema(FILE_SCHEMAS[kind]).load()
    layouts = dict.fromkeys(r["fields"] for r in found)
    return reader.option("fields", json.dumps([f for text in layouts for f in json.loads(text)])).load()
