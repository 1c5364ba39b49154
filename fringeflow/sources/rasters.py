"""A Python data source for stacks of complex rasters, read and written.

Format ``complex_raster`` has ``t, r, c, re, im``: date number, row, column and sample. A stack is a list of files, one
raster a date (option ``paths``, a JSON list), a single file (``path``), or a folder that the writer made
(``stack``), where a raster is kept in tiles of whole rows. Samples are 32-bit floats (``fcomplex``) or 16-bit integers
(``scomplex``) in pairs, big or little endian.

An input partition is one date and one range of rows. Predicates on dates, rows and columns are pushed
down: what they rule out is not planned, and only the bytes between the first and the last wanted
column are read, many rows at a time. All rasters of the wanted dates must have the size that width, length
and sample format ask for.

The writer takes samples in any order, one tile a time in a task, and moves the tiles into the folder once all tasks are
through; cells without a sample are zeros, which the selections take as no sample.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

ROWS_A_PARTITION = 256
READ_BYTES = 8 << 20
MANIFEST = "stack.json"
# Sample formats.
KINDS = {"fcomplex": ("f4", 8), "scomplex": ("i2", 4)}
ORDERS = {"big": ">", "little": "<"}


def raster_kind(size: int, width: int, length: int, named: str | None = None) -> str:
    """The sample format, by name or else by the file's size, which must fit."""
    for kind, (_, each) in KINDS.items():
        if (named or kind).lower() == kind and size == width * length * each:
            return kind
    raise ValueError(f"{size} bytes do not hold {length} x {width} samples of {named or 'any known format'}")


@dataclass
class RowRange(InputPartition):
    """Rows ``first`` to ``stop`` of date ``t``, in a file whose first row is ``top``; no file is a tile of zeros."""

    t: int
    first: int
    stop: int
    top: int
    path: str | None
    kind: str


class ComplexRaster(DataSource):
    @classmethod
    def name(cls) -> str:
        return "complex_raster"

    def schema(self) -> str:
        return "t int, r int, c int, re float, im float"

    def reader(self, schema: StructType) -> "RasterReader":
        return RasterReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> "RasterWriter":
        return RasterWriter(self.options)


class RasterReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        options = dict(options)
        self.folder = options.get("stack")
        if self.folder:
            fs, root = pyarrow.fs.FileSystem.from_uri(self.folder)
            with fs.open_input_file(f"{root}/{MANIFEST}") as f:
                held = json.loads(f.read())
            options = held["options"] | options
            self.files = {int(t): [(top, rows, f"{self.folder}/{name}") for top, rows, name in tiles] for t, tiles in held["tiles"].items()}
        self.width, self.length = int(options["width"]), int(options["length"])
        if not self.folder:
            paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
            self.files = {t: [(0, self.length, path)] for t, path in enumerate(paths)}
        self.kind, self.order = options.get("kind"), options.get("order", "big")
        self.step = int(options.get("rows_a_partition", ROWS_A_PARTITION))
        self.dates = set(json.loads(options["dates"])) & set(self.files) if "dates" in options else set(self.files)
        self.low = {"r": int(options.get("row0", 0)), "c": int(options.get("col0", 0)), "t": 0}
        self.high = {"r": self.low["r"] + int(options.get("rows", self.length - self.low["r"])) - 1, "c": self.low["c"] + int(options.get("cols", self.width - self.low["c"])) - 1, "t": max(self.files, default=0)}
        if min(self.low.values()) < 0 or self.high["r"] >= self.length or self.high["c"] >= self.width or self.high["r"] < self.low["r"] or self.high["c"] < self.low["c"]:
            raise ValueError("the window leaves the raster")

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "t" and isinstance(f, In):
                self.dates &= set(f.value)
                continue
            if name not in self.low or not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
                continue
            if not isinstance(f, (LessThan, LessThanOrEqual)):
                self.low[name] = max(self.low[name], f.value + isinstance(f, GreaterThan))
            if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.high[name] = min(self.high[name], f.value - isinstance(f, LessThan))

    def partitions(self) -> list[RowRange]:
        out = []
        for t in sorted(d for d in self.dates if self.low["t"] <= d <= self.high["t"]):
            for top, rows, path in self.files[t]:
                first, stop = max(top, self.low["r"]), min(top + rows, self.high["r"] + 1)
                if first >= stop or self.low["c"] > self.high["c"]:
                    continue
                kind = self._checked(path, rows) if path else "fcomplex"
                out += [RowRange(t, a, min(a + self.step, stop), top, path, kind) for a in range(first, stop, self.step)]
        return out or [RowRange(0, 0, 0, 0, None, "fcomplex")]

    def _checked(self, path: str, rows: int) -> str:
        fs, own = pyarrow.fs.FileSystem.from_uri(path)
        info = fs.get_file_info(own)
        if not info.is_file:
            raise FileNotFoundError(path)
        try:
            kind = raster_kind(info.size, self.width, rows, self.kind)
        except ValueError as e:
            raise ValueError(f"{path}: {e}") from None
        self.kind = self.kind or kind  # the first raster decides for all
        return kind

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        p, first = partition, self.low["c"]
        n = self.high["c"] - first + 1
        if p.path is None or n <= 0 or p.first >= p.stop:
            return
        code, each = KINDS[p.kind]
        fs, path = pyarrow.fs.FileSystem.from_uri(p.path)
        block = max(1, READ_BYTES // (self.width * each)) if 8 * n >= self.width else 1  # of a narrow window one row at a time
        cols = np.arange(first, first + n, dtype=np.int32)
        with fs.open_input_file(path) as f:
            for row in range(p.first, p.stop, block):
                rows = min(block, p.stop - row)
                f.seek(((row - p.top) * self.width + first) * each)
                raw = np.frombuffer(f.read(((rows - 1) * self.width + n) * each), ORDERS[self.order] + code).reshape(-1, 2)
                x = np.concatenate([raw[k * self.width : k * self.width + n] for k in range(rows)]).astype(np.float32)
                place = np.arange(row, row + rows, dtype=np.int32)
                yield pa.record_batch([np.full(rows * n, p.t, np.int32), np.repeat(place, n), np.tile(cols, rows), x[:, 0].copy(), x[:, 1].copy()], ["t", "r", "c", "re", "im"])


@dataclass
class TilesWritten(WriterCommitMessage):
    tiles: list[tuple[int, int, int, str]]


class RasterWriter(DataSourceArrowWriter):
    """Tiles of rows of each date; a task gets whole tiles, in order of date and row (``write_stack`` sees to it)."""

    def __init__(self, options: dict) -> None:
        self.folder, self.width, self.length = options["stack"], int(options["width"]), int(options["length"])
        self.tile = int(options.get("rows_a_tile", ROWS_A_PARTITION))
        self.kind, self.order = options.get("kind", "fcomplex"), options.get("order", "big")

    def write(self, batches: Iterator[pa.RecordBatch]) -> TilesWritten:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        done: list[tuple[int, int, int, str]] = []
        open_: tuple[int, int] | None = None
        samples = filled = None
        for batch in batches:
            t, r, c, re, im = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            if len(t) and (r.min() < 0 or c.min() < 0 or r.max() >= self.length or c.max() >= self.width):
                raise ValueError("a sample lies outside the raster")
            for edge in np.split(np.arange(len(t)), np.flatnonzero((np.diff(t) != 0) | (np.diff(r // self.tile) != 0)) + 1):
                if not len(edge):
                    continue
                own = (int(t[edge[0]]), int(r[edge[0]] // self.tile))
                if own != open_:
                    if open_ is not None:
                        done.append(self._put(fs, root, open_, samples))
                    rows = min(self.tile, self.length - own[1] * self.tile)
                    open_, samples, filled = own, np.zeros((rows * self.width, 2), np.float32), np.zeros(rows * self.width, bool)
                cell = (r[edge] - own[1] * self.tile).astype(np.int64) * self.width + c[edge]
                if filled[cell].any() or len(np.unique(cell)) < len(cell):
                    raise ValueError(f"a cell of date {own[0]} is written twice")
                filled[cell] = True
                samples[cell, 0], samples[cell, 1] = re[edge], im[edge]
        if open_ is not None:
            done.append(self._put(fs, root, open_, samples))
        return TilesWritten(done)

    def _put(self, fs: pyarrow.fs.FileSystem, root: str, own: tuple[int, int], samples: np.ndarray) -> tuple[int, int, int, str]:
        code = KINDS[self.kind][0]
        if self.kind == "scomplex":
            samples = np.rint(samples)
            if np.abs(samples).max(initial=0) > 32767:
                raise ValueError("a sample does not fit 16 bits")
        name = f"_written/{uuid.uuid4().hex}"  # a task that is run again leaves its first file behind, not in the stack
        fs.create_dir(f"{root}/_written", recursive=True)
        with fs.open_output_stream(f"{root}/{name}") as f:
            f.write(samples.astype(ORDERS[self.order] + code).tobytes())
        return own[0], own[1] * self.tile, len(samples) // self.width, name

    def commit(self, messages: list[TilesWritten | None]) -> None:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        tiles: dict[int, list] = {}
        seen: set[tuple[int, int]] = set()
        for t, top, rows, name in sorted(x for m in messages if m for x in m.tiles):
            if (t, top) in seen:
                raise ValueError(f"rows from {top} of date {t} come from two tasks")
            seen.add((t, top))
            fs.create_dir(f"{root}/t={t}", recursive=True)
            fs.move(f"{root}/{name}", f"{root}/t={t}/{top:09d}.slc")
            tiles.setdefault(t, []).append([top, rows, f"t={t}/{top:09d}.slc"])
        if tiles:
            fs.delete_dir(f"{root}/_written")
        fs.create_dir(root, recursive=True)
        options = {"width": self.width, "length": self.length, "kind": self.kind, "order": self.order}
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps({"options": options, "tiles": tiles}).encode())

    def abort(self, messages: list[TilesWritten | None]) -> None:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        if fs.get_file_info(f"{root}/_written").type == pyarrow.fs.FileType.Directory:
            fs.delete_dir(f"{root}/_written")


def _source(spark: SparkSession, options: dict) -> DataFrame:
    """Turns on filter push-down of Python sources for the session, without which predicates would be applied after the read."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ComplexRaster)
    return spark.read.format("complex_raster").options(**options).load()


def read_raster(spark: SparkSession, path: str, width: int, length: int, **options: object) -> DataFrame:
    """``r, c, re, im`` of one raster."""
    return _source(spark, {"path": path, "width": width, "length": length} | options).drop("t")


def read_stack(spark: SparkSession, paths: list[str], width: int, length: int, dates: list[int] | None = None, **options: object) -> DataFrame:
    """``t, r, c, re, im`` of a stack of equal rasters, a date each; ``dates`` chooses some, as a predicate on t does."""
    if dates is not None:
        if not set(dates) & set(range(len(paths))):
            raise ValueError("no date is chosen")
        options["dates"] = json.dumps(list(dates))
    return _source(spark, {"paths": json.dumps(paths), "width": width, "length": length} | options)


def read_written_stack(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """``t, r, c, re, im`` of a stack that ``write_stack`` made; a tile without any sample has no rows."""
    return _source(spark, {"stack": folder} | options)


def write_stack(samples: DataFrame, folder: str, width: int, length: int, rows_a_tile: int = ROWS_A_PARTITION, kind: str = "fcomplex", order: str = "big") -> None:
    """Writes ``samples(t, r, c, re, im)`` as rasters. With ``rows_a_tile`` of ``length`` each date is one plain raster file.

    A task holds one tile: ``rows_a_tile * width`` samples. A cell that is given twice or lies outside is an error.
    """
    samples.sparkSession.dataSource.register(ComplexRaster)
    typed = samples.select(F.col("t").cast("int").alias("t"), F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("re").cast("float").alias("re"), F.col("im").cast("float").alias("im"))
    dealt = typed.repartition("t", F.floor(F.col("r") / rows_a_tile)).sortWithinPartitions("t", "r", "c")
    options = {"stack": folder, "width": width, "length": length, "rows_a_tile": rows_a_tile, "kind": kind, "order": order}
    dealt.write.format("complex_raster").options(**options).mode("append").save()
