"""Archives (npz) as a data source: one file for each unit, arrays by frame.

Reading takes the columns of the schema it is given, and no other member of an archive is loaded:
``spark.read.format("archive").schema("unit string, frame int, pose array<float>").load(path)``.
``unit`` is the file's name, ``frame`` the row's number; every other column is an array of the archive, by
frame where it has as many rows as there are frames, else the same for all of them. A member that
an archive lacks is null.

Writing needs each unit's rows together and in order (``write_archives`` deals them out so). Files get their
names when all tasks have ended: a job that is lost, or a task that runs twice, leaves none.

Paths are those that Arrow's file systems open: folders that all executors share, or object stores.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Frames in a batch; bytes of archives in a partition, about.
FRAMES, PARTITION = 4096, 64 << 20
#: Members whose rows are the frames, the first that is there; without any the longest member's.
LEADING = ("poses", "pose", "trans")


def _open(path: str) -> tuple[pf.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    fs, inner = pf.FileSystem.from_uri(path)
    return fs, inner.rstrip("/")


@dataclass
class Files(InputPartition):
    names: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


def member(d: np.lib.npyio.NpzFile, name: str, frames: int, kind: pa.DataType) -> pa.Array:
    """An archive's array as a column of all its frames."""
    if name not in d.files:
        return pa.nulls(frames, kind)
    x = d[name]
    by_frame = x.ndim > 0 and len(x) == frames
    if not pa.types.is_list(kind):
        values = x.reshape(frames, -1)[:, 0] if by_frame else np.repeat(x.reshape(-1)[:1], frames)
        return pa.array(values.tolist() if values.dtype.kind in "US" else values).cast(kind)
    rows = x.reshape(frames, -1) if by_frame else np.tile(x.reshape(1, -1), (frames, 1))
    flat = pa.array(np.ascontiguousarray(rows).ravel()).cast(kind.value_type)
    return pa.ListArray.from_arrays(pa.array(np.arange(frames + 1, dtype=np.int32) * rows.shape[1]), flat)


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def partitions(self) -> list[InputPartition]:
        fs, folder = _open(self.path)
        infos = [i for i in fs.get_file_info(pf.FileSelector(folder, recursive=True)) if i.type == pf.FileType.File and i.path.endswith(".npz") and "/_" not in i.path[len(folder) :]]
        parts, size = [[]], 0
        for i in sorted(infos, key=lambda i: i.path):
            if parts[-1] and size + (i.size or 0) > PARTITION:
                parts.append([])
                size = 0
            parts[-1].append(i.path)
            size += i.size or 0
        return [Files(tuple(p)) for p in parts]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        kinds = to_arrow_schema(self.schema)
        for path in partition.names:
            with fs.open_input_file(path) as f, np.load(f, allow_pickle=False) as d:
                leads = [m for m in LEADING if m in d.files][:1] or d.files
                frames = max(map(_rows_of(d), leads), default=0)
                name = path.rsplit("/", 1)[-1].removesuffix(".npz")
                columns = [pa.array([name] * frames, c.type) if c.name == "unit" else pa.array(np.arange(frames)).cast(c.type) if c.name == "frame" else member(d, c.name, frames, c.type) for c in kinds]
                table = pa.RecordBatch.from_arrays(columns, schema=kinds)
                for lo in range(0, frames, FRAMES):
                    yield table.slice(lo, FRAMES)


def _rows_of(d: np.lib.npyio.NpzFile):
    """Rows of a member, from its header alone."""

    def rows(name: str) -> int:
        with d.zip.open(f"{name}.npy") as f:
            version = np.lib.format.read_magic(f)
            read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
            shape = read(f)[0]
            return shape[0] if shape else 0

    return rows


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.names, self.overwrite, self.job = path, schema.names, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _open(self.path)
        fs.create_dir(f"{folder}/_{self.job}", recursive=True)
        task, files, unit, held = uuid.uuid4().hex, [], None, []

        def out() -> None:
            if not held:
                return
            rows = pa.Table.from_batches(held)
            path = f"{folder}/_{self.job}/{task}-{len(files)}"
            with fs.open_output_stream(path) as f, zipfile.ZipFile(_Stream(f), "w", zipfile.ZIP_DEFLATED) as z:
                for name in self.names:
                    if name in ("unit", "frame"):
                        continue
                    column = rows.column(name).combine_chunks()
                    if column.null_count == len(column):
                        continue  # never there
                    values = np.array(column.to_pylist()) if not pa.types.is_list(column.type) else column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
                    raw = io.BytesIO()
                    np.lib.format.write_array(raw, values, allow_pickle=False)
                    z.writestr(f"{name}.npy", raw.getvalue())
            files.append(f"{path}\n{unit}")

        for batch in iterator:
            units = batch.column(batch.schema.get_field_index("unit")).to_pylist()
            lo = 0
            for k in range(1, len(units) + 1):
                if k == len(units) or units[k] != units[lo]:
                    if held and units[lo] != unit:
                        out()
                        held = []
                    unit = units[lo]
                    held.append(batch.slice(lo, k - lo))
                    lo = k
        out()
        return Written(tuple(files))

    def commit(self, messages: list[Written]) -> None:
        fs, folder = _open(self.path)
        files = [f.split("\n", 1) for m in messages if m is not None for f in m.files]
        if len({unit for _, unit in files}) < len(files):
            self.abort(messages)
            raise ValueError("a unit's rows lie in more than one stretch: use write_archives")
        if self.overwrite:
            for i in fs.get_file_info(pf.FileSelector(folder)):
                if i.path.endswith(".npz"):
                    fs.delete_file(i.path)
        for path, unit in files:
            fs.move(path, f"{folder}/{unit}.npz")
        fs.delete_dir(f"{folder}/_{self.job}")

    def abort(self, messages: list[Written]) -> None:
        fs, folder = _open(self.path)
        if fs.get_file_info(f"{folder}/_{self.job}").type == pf.FileType.Directory:
            fs.delete_dir(f"{folder}/_{self.job}")


class _Stream(io.RawIOBase):
    """An output stream that isn't sought in, for zip files."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return "unit string, frame int, fps double, pose array<float>, trans array<float>"

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], schema, overwrite)


def read_archives(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of ``schema`` of all archives at a path."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archive").schema(schema).load(path)


def write_archives(frames: DataFrame, path: str) -> None:
    """(unit, frame, arrays) as an archive for each unit; a unit whose frames are no array's null has no such member."""
    frames.sparkSession.dataSource.register(ArchiveSource)
    frames.repartition("unit").sortWithinPartitions("unit", "frame").write.format("archive").mode("append").save(path)
