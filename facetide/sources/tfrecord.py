"""TFRecord files as a Spark source and sink.

    spark.read.format("tfrecord").option("binary_features", "image_raw").load(dir)
    df.write.format("tfrecord").mode("overwrite").option("split", "train").save(dir)

Read options: ``recordType`` ``example`` (typed columns, default) or ``bytes`` (one ``value`` column);
``binary_features`` names that stay bytes; ``mode`` ``FAILFAST`` (a missing feature is an error, default) or
``PERMISSIVE`` (null); ``optional`` names that may be missing in either mode; ``verifyData`` ``true`` (default) checks
the data checksums, those of the lengths are always checked; ``splitBytes`` cuts larger files into several tasks,
0 keeps files whole. A schema given by the caller limits reading to its fields. ``fileColumns`` ``true`` adds ``file``,
``split`` and ``shard``, from the file's name; filters on them choose the files that are opened at all.

A task that begins within a file finds its first frame by the index that the sink writes beside larger files
(``_<name>.index``), or, where there is none, by walking over the lengths from the file's begin. Nothing is guessed
from the bytes, so records that hold frames themselves are read alike however files are cut. ``index_records`` makes the
index of files from elsewhere. With ``readStream`` files are read as they arrive, see ``arrivals``.

Write options: ``split`` file name prefix; ``shardColumn`` an integer column naming each row's file (default: the task's
partition number); ``single`` writes ``<split>.tfrecords``, for one-partition frames; ``maxBytes`` refuses to let one file
grow beyond it.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegerType, IntegralType, LongType, StringType,
    StructField, StructType,
)

from facetide.session import ship
from facetide.sources.files import qualified

SUFFIX = ".tfrecords"
# Fixed frame layout: length, its masked checksum, data, its masked checksum.
HEADER, FOOTER = 12, 4
MAX_LENGTH = 1 << 40
SPLIT_BYTES = 256 << 20
BLOCK_BYTES = 16 << 20
WRITE_BYTES = 16 << 20
BATCH_ROWS = 10_000
FILE_BYTES = 256 << 20
#: Files of at least so many bytes get an index, with a frame for each such stretch.
INDEX_BYTES = 4 << 20
#: Columns that say where a record is from; their values are known from the listing.
FILE_COLUMNS = {"file": StringType(), "split": StringType(), "shard": IntegerType()}


class TFRecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> StructType:
        if self.options.get("recordType", "example") == "bytes":
            found = StructType([StructField("value", BinaryType())])
        else:
            found = _inferred(self.options)
        if _with_files(_plain(self.options)):
            found = StructType([f for f in found if f.name not in FILE_COLUMNS] + [
                StructField(n, t) for n, t in FILE_COLUMNS.items()])
        return found

    def reader(self, schema: StructType) -> "TFRecordReader":
        options = _plain(self.options)
        return (PrunedReader if _with_files(options) else TFRecordReader)(schema, options)

    def streamReader(self, schema: StructType):
        from facetide.sources.arrivals import ArrivalReader

        return ArrivalReader(schema, _plain(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> "TFRecordWriter":
        return TFRecordWriter(schema, overwrite, dict(_plain(self.options)))


def _plain(options) -> dict[str, str]:
    return {k.lower(): v for k, v in options.items()}


def _with_files(options: dict[str, str]) -> bool:
    return options.get("filecolumns", "false").lower() == "true"


def _names(text: str | None) -> set[str]:
    return {n.strip() for n in (text or "").split(",") if n.strip()}


def _record_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the file, or of the visible files directly inside the directory, by name."""
    from pyarrow import fs

    from facetide.sources.files import resolve

    system, root = resolve(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    children = system.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=False))
    scheme = path.rstrip("/")
    return sorted(
        (f"{scheme}/{c.base_name}", c.size)
        for c in children
        if c.type == fs.FileType.File and not c.base_name.startswith(("_", "."))
    )


# --- reading ----------------------------------------------------------------------------------------------------


def _inferred(options) -> StructType:
    """Column types from the first record, by feature name."""
    from facetide.sources.example import decode

    binary = _names(options.get("binary_features"))
    for path, size in _record_files(options["path"]):
        if size == 0:
            continue
        data = next(iter(_Frames(path, size).records(0, 1, verify=True)))[0]
        fields = []
        for name, (kind, values) in sorted(decode(data).items()):
            kind_type: DataType = {"int": LongType(), "float": FloatType()}.get(
                kind, BinaryType() if name in binary else StringType()
            )
            fields.append(StructField(name, ArrayType(kind_type) if len(values) > 1 else kind_type))
        return StructType(fields)
    raise ValueError(f"no records in {options['path']} to take the columns from; give a schema")


def index_path(path: str) -> str:
    folder, _, name = path.rpartition("/")
    return f"{folder}/_{name}.index" if folder else f"_{name}.index"


def frame_starts(path: str, size: int) -> list[int] | None:
    """Starts of frames by the index beside a file of this size, if it has one."""
    from facetide.sources.files import read_bytes

    held = read_bytes(index_path(path))
    found = json.loads(held) if held else {}
    return found["starts"] if found.get("size") == size else None


class Marks:
    """What the index of a file says: its size, its records, and a frame's start for each stretch of the file."""

    def __init__(self):
        self.size = self.records = 0
        self.starts: list[int] = []

    def add(self, lengths) -> None:
        """Take frames, by the lengths of their data, that follow those before."""
        import numpy as np

        whole = np.asarray(lengths, np.int64) + HEADER + FOOTER
        ends = self.size + np.cumsum(whole)
        begins = ends - whole
        stretch = begins // INDEX_BYTES
        last = self.starts[-1] // INDEX_BYTES if self.starts else -1
        new = stretch > np.append(last, stretch[:-1])
        self.starts += begins[new].tolist()
        self.records += len(whole)
        self.size = int(ends[-1]) if len(ends) else self.size

    def text(self) -> bytes:
        return json.dumps({"size": self.size, "records": self.records, "starts": self.starts}).encode()


class _Frames:
    """Frames of one file."""

    def __init__(self, path: str, size: int):
        from facetide.sources.files import resolve

        self.path, self.size = path, size
        system, inner = resolve(path)
        self.file = system.open_input_file(inner)

    @classmethod
    def of(cls, data) -> "_Frames":
        """Frames of bytes in memory."""
        import pyarrow as pa

        self = cls.__new__(cls)
        self.path, self.size, self.file = "bytes", data.size, pa.BufferReader(data)
        return self

    def records(self, start: int, end: int, verify: bool) -> Iterator[list]:
        """Lists of record data, about a block each, of the frames that start in ``[start, end)``."""
        for block, begins, ends in self.blocks(start, end, verify):
            yield [block[a:b] for a, b in zip(begins, ends)]

    def blocks(self, start: int, end: int, verify: bool) -> Iterator[tuple[memoryview, list[int], list[int]]]:
        """(bytes, begins, ends) of record data, about a block each, of the frames that start in ``[start, end)``."""
        import numpy as np

        from facetide.sources import crc32c

        at = start and self.first(start)
        while at < min(end, self.size):
            want = BLOCK_BYTES
            while True:
                block = memoryview(self.file.read_at(min(want, self.size - at), at))
                begins, ends, here, need = self._heads(block, at, end)
                if begins:
                    break
                # Not one whole frame: either it is longer than the block, or the file ends within it.
                if at + need > self.size:
                    raise ValueError(f"truncated or corrupted record in {self.path} at byte {at}")
                want = need
            if verify:
                found = crc32c.mask(crc32c.crc32c([block[a:b] for a, b in zip(begins, ends)]))
                stored = np.array([struct.unpack_from("<I", block, b)[0] for b in ends], np.uint32)
                if not np.array_equal(found, stored):
                    raise ValueError(f"corrupted record data in {self.path} after byte {at}")
            at += here
            yield block, begins, ends

    def _heads(self, block: memoryview, at: int, end: int) -> tuple[list[int], list[int], int, int]:
        """Begins and ends of the data of whole frames in a block read at ``at``, of those that start before ``end``; where the
        next frame begins, and up to where the last one that was seen goes. Lengths are checked."""
        import numpy as np

        from facetide.sources import crc32c

        begins, ends, lengths, sums, here, need = [], [], [], [], 0, HEADER
        size = len(block)
        while at + here < end and here + HEADER <= size:
            length, length_sum = struct.unpack_from("<QI", block, here)
            if length >= MAX_LENGTH:
                # Whole frames before it are given first.
                if not begins:
                    raise ValueError(f"truncated or corrupted record in {self.path} at byte {at}")
                break
            lengths.append(length)
            sums.append(length_sum)
            need = here + HEADER + length + FOOTER
            if need > size:
                break
            begins.append(here + HEADER)
            ends.append(need - FOOTER)
            here = need
        words = np.array(lengths, dtype=np.uint64)
        if lengths and not np.array_equal(crc32c.masked_of_words(words), np.array(sums, np.uint32)):
            raise ValueError(f"corrupted record length in {self.path} after byte {at}")
        return begins, ends, here, need

    def first(self, start: int) -> int:
        """Where the first frame at or after ``start`` begins."""
        import bisect

        known = frame_starts(self.path, self.size) or [0]
        at = known[max(0, bisect.bisect_right(known, start) - 1)]
        for at, _ in self.walk(at, start):
            pass
        return at

    def walk(self, at: int, upto: int) -> Iterator[tuple[int, list[int]]]:
        """Go from frame to frame by the lengths alone, until one begins at or after ``upto``: (where it begins, lengths of the
        data of the frames before it)."""
        want = 1 << 12
        while at < min(upto, self.size):
            block = memoryview(self.file.read_at(min(want, self.size - at), at))
            begins, ends, here, need = self._heads(block, at, upto)
            lengths = [b - a for a, b in zip(begins, ends)]
            if at + here < upto and need > here:
                # The frame that goes beyond the block is not read, only passed.
                if at + need > self.size:
                    raise ValueError(f"truncated or corrupted record in {self.path} at byte {at + here}")
                if need >= here + HEADER + FOOTER and here + HEADER <= len(block):
                    lengths.append(need - here - HEADER - FOOTER)
                    here = need
            if not lengths:
                raise ValueError(f"truncated or corrupted record in {self.path} at byte {at}")
            # Large records: heads alone are read. Small ones: many at once.
            want = 1 << 22 if len(lengths) > 16 else 1 << 12
            at += here
            yield at, lengths


@dataclass
class Split(InputPartition):
    path: str
    size: int
    start: int
    end: int


def cut(path: str, size: int, start: int, end: int, options: dict[str, str]) -> list[Split]:
    """The part of a file from ``start`` to ``end`` in splits of ``splitBytes`` at most."""
    limit = int(options.get("splitbytes", SPLIT_BYTES))
    n = max(1, -(-(end - start) // limit)) if limit else 1
    bounds = [start + (end - start) * i // n for i in range(n + 1)]
    return [Split(path, size, a, b) for a, b in zip(bounds, bounds[1:]) if a < b]


class TFRecordReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, options

    def partitions(self) -> list[Split]:
        splits = [s for path, size in self.files() for s in cut(path, size, 0, size, self.options)]
        return splits or [Split(self.options["path"], 0, 0, 0)]

    def files(self) -> list[tuple[str, int]]:
        return _record_files(self.options["path"])

    def read(self, partition: Split):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.size == 0:
            return
        verify = self.options.get("verifydata", "true").lower() == "true"
        arrow = to_arrow_schema(self.schema)
        as_bytes = self.options.get("recordtype", "example") == "bytes"
        strict = self.options.get("mode", "FAILFAST").upper() == "FAILFAST"
        optional = _names(self.options.get("optional"))
        from_file = FILE_COLUMNS.keys() if _with_files(self.options) else ()
        origin = dict(zip(FILE_COLUMNS, _origin(partition.path)))
        fields = [(f.name, f.dataType, strict and f.name not in optional) for f in self.schema.fields if f.name not in from_file]
        kinds = [field.type for field in arrow if field.name not in from_file]
        for block, begins, ends in _Frames(partition.path, partition.size).blocks(partition.start, partition.end, verify):
            for at in range(0, len(begins), BATCH_ROWS):
                part = begins[at:at + BATCH_ROWS], ends[at:at + BATCH_ROWS]
                if as_bytes:
                    made = [pa.array([bytes(block[a:b]) for a, b in zip(*part)], kind) for kind in kinds]
                else:
                    made = decoded(block, *part, fields, kinds)
                held = iter(made)
                n = len(part[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([origin[f.name]] * n, f.type) if f.name in from_file else next(held) for f in arrow], schema=arrow)


def _origin(path: str) -> tuple[str, str | None, int | None]:
    """(file, split, shard) by the path of a file; names of other forms have no split or shard."""
    name = path.rpartition("/")[2]
    found = re.fullmatch(r"(.+)-([0-9]+)" + re.escape(SUFFIX), name)
    if found:
        return name, found[1], int(found[2])
    return name, name.removesuffix(SUFFIX) if name.endswith(SUFFIX) else None, None


def _holds(given: Filter, values: dict) -> bool | None:
    """Whether a filter on columns of known values is true, false or null; a KeyError if it is about something else."""
    if isinstance(given, Not):
        found = _holds(given.child, values)
        return None if found is None else not found
    (name,) = given.attribute
    value = values[name]
    if isinstance(given, IsNull):
        return value is None
    if isinstance(given, IsNotNull):
        return value is not None
    if isinstance(given, EqualNullSafe):
        return value == given.value
    compare = {
        EqualTo: lambda x: value == x, In: lambda x: value in x, GreaterThan: lambda x: value > x,
        GreaterThanOrEqual: lambda x: value >= x, LessThan: lambda x: value < x, LessThanOrEqual: lambda x: value <= x,
        StringStartsWith: lambda x: value.startswith(x), StringEndsWith: lambda x: value.endswith(x),
        StringContains: lambda x: x in value,
    }[type(given)]
    return None if value is None or given.value is None else compare(given.value)


class PrunedReader(TFRecordReader):
    """Filters on the file columns choose the files; they are evaluated before any task starts, so Spark need not repeat them."""

    def pushFilters(self, filters: list[Filter]):
        self.chosen = []
        for given in filters:
            try:
                _holds(given, {"file": "", "split": "", "shard": 0})
            except (KeyError, ValueError, TypeError):
                yield given
            else:
                self.chosen.append(given)

    def files(self) -> list[tuple[str, int]]:
        found = super().files()
        return [(path, size) for path, size in found
                if all(_holds(f, dict(zip(FILE_COLUMNS, _origin(path)))) for f in getattr(self, "chosen", ()))]


def decoded(block, begins: list[int], ends: list[int], fields: list[tuple[str, DataType, bool]], kinds: list) -> list:
    """Messages of a block as Arrow arrays of these kinds."""
    import numpy as np
    import pyarrow as pa

    from facetide.sources.columns import Messages, columns
    from facetide.sources.example import decode

    wanted = [(name, _kind(kind), isinstance(kind, ArrayType), required) for name, kind, required in fields]
    base = begins[0]
    plain, arrays = columns(
        Messages(block[base:ends[-1]], np.array(begins, np.int64) - base, np.array(ends, np.int64) - base), wanted)
    arrays = [a.cast(k) for a, k in zip(arrays, kinds)]
    odd = np.flatnonzero(~plain)
    if not len(odd):
        return arrays
    names = {name for name, _, _ in fields}
    rows = [decode(block[begins[i]:ends[i]], names) for i in odd.tolist()]
    others = [_column(pa, [_cell(row.get(name), name, kind, required) for row in rows], k)
              for (name, kind, required), k in zip(fields, kinds)]
    order = pa.array(np.argsort(np.concatenate([np.flatnonzero(plain), odd]), kind="stable"))
    return [pa.concat_arrays([a, b]).take(order) for a, b in zip(arrays, others)]


def _kind(kind: DataType) -> str:
    if isinstance(kind, ArrayType):
        kind = kind.elementType
    if isinstance(kind, (IntegralType, BooleanType)):
        return "int"
    if isinstance(kind, (FloatType, DoubleType)):
        return "float"
    if isinstance(kind, (StringType, BinaryType)):
        return "bytes"
    raise ValueError(f"records cannot hold {kind.simpleString()}")


def _cell(feature, name: str, kind: DataType, required: bool):
    found, values = feature or (None, [])
    if found is None:
        if required:
            raise ValueError(f"record lacks the feature {name}")
        return None
    if found != _kind(kind):
        raise ValueError(f"feature {name} holds {found} values, not {kind.simpleString()}")
    if isinstance(kind, ArrayType):
        return values
    if len(values) != 1:
        if not values and not required:
            return None
        raise ValueError(f"feature {name} holds {len(values)} values, not one")
    return values[0]


def _column(pa, values: list, kind):
    """Arrow column; text arrives as bytes and is checked to be UTF-8 by the cast."""
    if pa.types.is_string(kind):
        return pa.array(values, pa.binary()).cast(pa.string())
    if pa.types.is_list(kind) and pa.types.is_string(kind.value_type):
        return pa.array(values, pa.list_(pa.binary())).cast(kind)
    return pa.array(values, kind)


# --- writing ----------------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: dict[str, tuple[str, int]]  # final name -> (temporary path, rows)
    indexes: dict[str, str]  # the same for indexes, final name -> temporary path


class TFRecordWriter(DataSourceArrowWriter):
    """Tasks write under a temporary folder; files get their names only when the whole job has succeeded."""

    def __init__(self, schema: StructType, overwrite: bool, options: dict[str, str]):
        self.schema, self.overwrite, self.options = schema, overwrite, options
        self.path = options["path"].rstrip("/")
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def _file(self, shard: int) -> str:
        split = self.options.get("split", "part")
        if self.options.get("single", "false").lower() == "true":
            return split + SUFFIX
        return "%s-%03d%s" % (split, shard, SUFFIX)

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        from facetide.sources.files import resolve

        context = TaskContext.get()
        system, folder = resolve(f"{self.temporary}/{context.taskAttemptId()}")
        system.create_dir(folder, recursive=True)
        shard_column = self.options.get("shardcolumn")
        kinds = {f.name: (_kind(f.dataType), isinstance(f.dataType, ArrayType)) for f in self.schema.fields
                 if f.name != shard_column}
        streams, marks, indexes = {}, {}, {}

        def append(name: str, rows) -> None:
            if name not in streams:
                streams[name], marks[name] = system.open_output_stream(f"{folder}/{name}"), Marks()
            if rows is None or not rows.num_rows:
                return
            # Wide rows are turned into frames a few at a time.
            step = max(1, WRITE_BYTES * rows.num_rows // max(rows.nbytes, 1))
            for at in range(0, rows.num_rows, step):
                frames, lengths = _framed(rows.slice(at, step), kinds)
                streams[name].write(frames)
                marks[name].add(lengths)

        try:
            for batch in iterator:
                if shard_column is None:
                    append(self._file(context.partitionId()), batch)
                    continue
                shards = batch.column(batch.schema.get_field_index(shard_column))
                for shard in shards.unique().to_pylist():
                    append(self._file(shard), batch.filter(_equal(shards, shard)))
            if shard_column is None and not streams:
                append(self._file(context.partitionId()), None)
        finally:
            for stream in streams.values():
                stream.close()
        for name, found in marks.items():
            if found.size >= INDEX_BYTES:
                indexes[index_path(name)] = f"{folder}/{index_path(name)}"
                with system.open_output_stream(indexes[index_path(name)]) as stream:
                    stream.write(found.text())
        return Written({name: (f"{folder}/{name}", marks[name].records) for name in streams}, indexes)

    def commit(self, messages) -> None:
        from pyarrow import fs

        from facetide.sources.files import resolve

        system, root = resolve(self.path)
        moves: dict[str, str] = {}
        indexes = {n: p for m in messages if m for n, p in m.indexes.items()}
        for message in messages:
            for name, (source, _) in (message.files if message else {}).items():
                if name in moves:
                    self.abort(messages)
                    raise ValueError(f"two tasks wrote {name}; partition the rows by shard first")
                moves[name] = source
        present = {
            info.base_name: info.path
            for info in system.get_file_info(fs.FileSelector(root, recursive=False))
            if info.type == fs.FileType.File and info.base_name.endswith(SUFFIX)
        }
        if not self.overwrite and present.keys() & moves.keys():
            self.abort(messages)
            raise FileExistsError(f"{root} already has {sorted(present.keys() & moves.keys())[0]}")
        stale = {
            info.path for info in system.get_file_info(fs.FileSelector(root, recursive=False))
            if info.type == fs.FileType.File and info.base_name in {
                index_path(n) for n in (present.keys() if self.overwrite else moves.keys())}
        }
        with ThreadPoolExecutor(16) as pool:
            # An index never stands beside a file that it is not of.
            list(pool.map(system.delete_file, stale))
            # New files first: a failure in between leaves a full set, old or new, under every name.
            list(pool.map(lambda item: system.move(item[1], f"{root}/{item[0]}"), moves.items()))
            if self.overwrite:
                list(pool.map(system.delete_file, (p for n, p in present.items() if n not in moves)))
            list(pool.map(lambda item: system.move(item[1], f"{root}/{item[0]}"), indexes.items()))
        self.abort(messages)

    def abort(self, messages) -> None:
        """Drop this job's temporary folder, with whatever failed attempts left in it."""
        from facetide.sources.files import resolve

        system, folder = resolve(self.temporary)
        try:
            system.delete_dir(folder)
        except FileNotFoundError:
            pass


def _equal(column, value):
    import pyarrow.compute as pc

    return pc.fill_null(pc.equal(column, value), False) if value is not None else pc.is_null(column)


def _framed(batch, kinds: dict[str, tuple[str, bool]]):
    """The rows of an Arrow batch as record frames, and the lengths of their data. A null is a feature left out."""
    import numpy as np

    from facetide.sources import crc32c
    from facetide.sources.example import encode

    columns = []
    for name, (kind, is_list) in kinds.items():
        values = batch.column(batch.schema.get_field_index(name)).to_pylist()
        if kind == "bytes":
            values = [_as_bytes(v, is_list) for v in values]
        elif not is_list:
            values = [None if v is None else [v] for v in values]
        columns.append((name, kind, values))
    messages = [
        encode([(name, kind, values[i]) for name, kind, values in columns if values[i] is not None])
        for i in range(batch.num_rows)
    ]
    lengths = np.array([len(m) for m in messages], dtype=np.uint64)
    frames = []
    for message, length, length_sum, data_sum in zip(
        messages, lengths.tolist(), crc32c.masked_of_words(lengths).tolist(),
        crc32c.mask(crc32c.crc32c(messages)).tolist(),
    ):
        frames += (struct.pack("<QI", length, length_sum), message, struct.pack("<I", data_sum))
    return b"".join(frames), lengths


def _as_bytes(value, is_list: bool):
    if value is None:
        return None
    return [v.encode() if isinstance(v, str) else v for v in (value if is_list else [value])]


# --- the user's calls -------------------------------------------------------------------------------------------


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(TFRecordSource)


def read_records(spark: SparkSession, path: str, binary_features: str = "image_raw", schema=None,
                 columns: list[str] | None = None, file_columns: bool = False, **options) -> DataFrame:
    """Records of a file or directory as typed columns, one task per file or part of a large file.

    A later ``select`` does not reach this source: name the ``columns``, or give a schema, to decode no more than those.
    With ``file_columns`` there are also ``file``, ``split`` and ``shard``, and files that a filter on them leaves out are not
    opened (this turns on ``spark.sql.python.filterPushdown.enabled`` for the session).
    """
    register(spark)
    if schema is None and columns is not None:
        known = infer_record_schema(spark, path, binary_features)
        schema = StructType([known[c] for c in columns])
    reader = spark.read.format("tfrecord").option("binary_features", binary_features).options(**options)
    if file_columns:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        reader = reader.option("fileColumns", "true")
        if schema is not None:
            given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
            schema = StructType([f for f in given if f.name not in FILE_COLUMNS] + [
                StructField(n, t) for n, t in FILE_COLUMNS.items()])
    return (reader.schema(schema) if schema is not None else reader).load(qualified(spark, path))


def read_record_stream(spark: SparkSession, path: str, state: str, schema, max_bytes: int | None = None,
                       max_files: int | None = None, **options) -> DataFrame:
    """Records as their files arrive in a folder, in steps of at most ``max_bytes`` or ``max_files``; ``state`` is a folder that
    the stream keeps its list of arrivals in, as durable as the query's checkpoint."""
    register(spark)
    bounds = {"maxBytes": max_bytes, "maxFiles": max_files}
    reader = spark.readStream.format("tfrecord").schema(schema).option("state", qualified(spark, state)).options(**options)
    return reader.options(**{k: str(v) for k, v in bounds.items() if v is not None}).load(qualified(spark, path))


def index_records(spark: SparkSession, path: str) -> DataFrame:
    """Write the index of every file from ``INDEX_BYTES`` on that has none, a task for each file; a row for each file:
    ``file``, ``bytes``, ``records``."""
    import pyarrow as pa

    register(spark)
    folder = qualified(spark, path)
    files = spark.createDataFrame(_record_files(folder), "path string, bytes long")

    def run(batches):
        from facetide.sources.files import read_bytes, resolve

        for batch in batches:
            names, records = batch.column("path").to_pylist(), []
            for name, size in zip(names, batch.column("bytes").to_pylist()):
                held = read_bytes(index_path(name))
                found = json.loads(held) if held else {}
                if found.get("size") != size:
                    marks = Marks()
                    for _, lengths in _Frames(name, size).walk(0, size):
                        marks.add(lengths)
                    found = json.loads(marks.text())
                    if size >= INDEX_BYTES:
                        system, place = resolve(f"{index_path(name)}-{uuid.uuid4().hex}")
                        with system.open_output_stream(place) as stream:
                            stream.write(marks.text())
                        system.move(place, resolve(index_path(name))[1])
                records.append(found["records"])
            yield pa.RecordBatch.from_pydict({
                "file": [n.rpartition("/")[2] for n in names], "bytes": batch.column("bytes"), "records": pa.array(records, pa.int64())})

    return files.repartition(max(1, files.count()), "path").mapInArrow(run, "file string, bytes long, records long")


def read_raw_records(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records as undecoded bytes in one column, ``value``."""
    register(spark)
    return spark.read.format("tfrecord").option("recordType", "bytes").options(**options).load(qualified(spark, path))


def decode_records(rows: DataFrame, schema, value: str = "value", permissive: bool = False, optional: str = "") -> DataFrame:
    """Replace a column of raw records by the fields of ``schema``; other columns stay. A null record has null fields."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(rows.sparkSession)
    given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = {f.name.lower() for f in given}
    kept = [f for f in rows.schema if f.name != value and f.name.lower() not in names]
    out, free = StructType(kept + list(given)), _names(optional)

    def run(batches):
        arrow = to_arrow_schema(out)
        fields = [(f.name, f.dataType, not permissive and f.name not in free) for f in given]
        kinds = [arrow.field(f.name).type for f in given]
        for batch in batches:
            held = batch.column(value).cast(pa.large_binary())
            valid = held.is_valid()
            data = held.drop_null()
            made = [pa.nulls(0, k) for k in kinds]
            if len(data):
                _, offsets, buffer = data.buffers()
                ends = memoryview(offsets).cast("q")[data.offset:data.offset + len(data) + 1].tolist()
                made = decoded(memoryview(buffer), ends[:-1], ends[1:], fields, kinds)
            place = pa.array([None if not v else n for v, n in zip(valid.to_pylist(), _counted(valid.to_pylist()))], pa.int64())
            fields_of = dict(zip((f.name for f in given), (m.take(place) for m in made)))
            yield pa.RecordBatch.from_arrays(
                [fields_of[f.name] if f.name in fields_of else batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return rows.select(*(f.name for f in kept), value).mapInArrow(run, out)


def _counted(flags: list[bool]) -> list[int]:
    """How many flags are set before each."""
    out, n = [], 0
    for f in flags:
        out.append(n)
        n += f
    return out


def unnest_records(rows: DataFrame, column: str, value: str = "value") -> DataFrame:
    """A row per record of the record files whose bytes ``column`` holds, raw in ``value``; other columns are repeated."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(rows.sparkSession)
    kept = [f for f in rows.schema if f.name != column and f.name.lower() != value.lower()]
    out = StructType([*kept, StructField(value, BinaryType())])

    def run(batches):
        arrow = to_arrow_schema(out)
        for batch in batches:
            for i, data in enumerate(batch.column(column)):
                if not data.is_valid:
                    continue
                whole = batch.slice(i, 1)
                for block, begins, ends in _Frames.of(data.as_buffer()).blocks(0, len(data.as_buffer()), True):
                    records = pa.array([bytes(block[a:b]) for a, b in zip(begins, ends)], pa.binary())
                    again = pa.array(np.zeros(len(records), np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [*(whole.column(f.name).take(again).cast(arrow.field(f.name).type) for f in kept), records], schema=arrow)

    return rows.select(*(f.name for f in kept), column).mapInArrow(run, out)


def infer_record_schema(spark: SparkSession, path: str, binary_features: str = "image_raw") -> StructType:
    """Column types from the first record."""
    return read_records(spark, path, binary_features).schema


def write_shards(df: DataFrame, base: str, split: str, n_shards: int, shard: str = "shard",
                 partitioned: bool = False) -> None:
    """Write ``<base>/<split>/<split>-000.tfrecords`` and so on, one file per value of the ``shard`` column.

    Rows go straight to the task of their shard. Pass ``partitioned=True`` if they are there already, so that
    image bytes attached since then are not shuffled.
    """
    register(df.sparkSession)
    if not partitioned:
        df = df.repartitionById(n_shards, F.col(shard).cast("int"))
    (
        df.write.format("tfrecord").mode("overwrite")
        .option("split", split).option("shardColumn", shard)
        .save(qualified(df.sparkSession, f"{base.rstrip('/')}/{split}"))
    )


def write_single(df: DataFrame, directory: str, name: str, file_bytes: int = FILE_BYTES) -> None:
    """Write ``<name>.tfrecords``, or ``<name>-000.tfrecords`` and so on if the values come to more than ``file_bytes``:
    a file is the work of one task."""
    register(df.sparkSession)
    sizes = (F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, (StringType, BinaryType)) else F.lit(8)
             for f in df.schema.fields)
    total = df.agg(F.sum(sum(sizes, F.lit(0)).cast("long")).alias("n")).first()["n"] or 0
    files = max(1, -(-total // file_bytes))
    (
        df.repartition(files).write.format("tfrecord").mode("append")
        .option("split", name).option("single", str(files == 1).lower()).save(qualified(df.sparkSession, directory))
    )
