"""Record files as a stream: what arrives in a folder is read once, in bounded steps, also over restarts.

    spark.readStream.format("tfrecord").schema(...).option("state", dir).option("maxBytes", "1g").load(folder)

Files that are new in the folder get the next place in a list of arrivals, which is kept under ``state`` in parts that are
never changed. The offset of the stream is one number: bytes of this list. So it can end within a file, and what lies
between two offsets is the same whenever it is asked for: frames belong to the step in which their first byte lies.

``maxBytes`` and ``maxFiles`` bound a step (bytes may cut a file, files may not; the smaller bound counts; a step is never
empty). Spark's trigger ``availableNow`` asks for the latest offset once, so with a bound it makes one step; other triggers
go on until nothing is left. Files are taken as complete when they have their name, as the sink writes them; hidden ones
(``_``, ``.``) are not read. A file that is replaced or deleted after it was listed is an error. ``state`` belongs to one query.
"""

from __future__ import annotations

import bisect
import json
import uuid

from pyspark.sql.datasource import DataSourceStreamReader
from pyspark.sql.types import StructType

#: Each such part of the list holds all arrivals up to it, so that a restart reads few parts.
WHOLE_EVERY = 64


class Arrivals:
    """The durable list of arrivals: (path, size), and the offset that was given out last."""

    def __init__(self, state: str):
        from facetide.sources.files import resolve

        self.system, self.folder = resolve(state.rstrip("/"))
        self.system.create_dir(self.folder, recursive=True)
        self.files: list[tuple[str, int]] = []
        self.ends: list[int] = []
        self.parts = 0
        self._load()

    def _load(self) -> None:
        from pyarrow import fs

        listed = self.system.get_file_info(fs.FileSelector(self.folder, recursive=False))
        numbers = sorted(int(i.base_name[5:]) for i in listed if i.base_name.startswith("part-"))
        self.parts = numbers[-1] + 1 if numbers else 0
        begin = (self.parts - 1) // WHOLE_EVERY * WHOLE_EVERY
        for n in range(max(0, begin), self.parts):
            self._take(json.loads(self._read(f"part-{n}")))
        self.seen = {p for p, _ in self.files}

    def _take(self, files: list) -> None:
        for path, size in files:
            self.files.append((path, size))
            self.ends.append((self.ends[-1] if self.ends else 0) + size)

    def _read(self, name: str) -> bytes:
        with self.system.open_input_stream(f"{self.folder}/{name}") as stream:
            return stream.read()

    def _write(self, name: str, held: bytes) -> None:
        """Whole or not at all."""
        aside = f"{self.folder}/.{name}-{uuid.uuid4().hex}"
        with self.system.open_output_stream(aside) as stream:
            stream.write(held)
        self.system.move(aside, f"{self.folder}/{name}")

    @property
    def total(self) -> int:
        return self.ends[-1] if self.ends else 0

    def add(self, listed: list[tuple[str, int]]) -> None:
        from pyarrow import fs

        new = [f for f in listed if f[0] not in self.seen and f[1]]
        if not new:
            return
        if self.system.get_file_info(f"{self.folder}/part-{self.parts}").type != fs.FileType.NotFound:
            raise RuntimeError(f"{self.folder} is used by another query")
        before = self.files if self.parts % WHOLE_EVERY == 0 else []
        self._write(f"part-{self.parts}", json.dumps([*before, *new]).encode())
        self._take(new)
        self.seen.update(p for p, _ in new)
        self.parts += 1

    def given(self) -> int:
        from pyarrow import fs

        found = self.system.get_file_info(f"{self.folder}/given").type != fs.FileType.NotFound
        return int(self._read("given")) if found else 0

    def give(self, offset: int) -> None:
        self._write("given", str(offset).encode())

    def between(self, start: int, end: int) -> list[tuple[str, int, int, int]]:
        """(path, size, begin, end) of the parts of files between two offsets."""
        out = []
        for i in range(bisect.bisect_right(self.ends, start), len(self.files)):
            path, size = self.files[i]
            first = self.ends[i] - size
            low, high = max(0, start - first), min(size, end - first)
            if low >= high:
                break
            out.append((path, size, low, high))
        return out

    def step(self, start: int, most_bytes: int | None, most_files: int | None) -> int:
        """The offset after the next step."""
        end = self.total
        if most_bytes is not None:
            end = min(end, start + max(1, most_bytes))
        if most_files is not None:
            last = bisect.bisect_right(self.ends, start) + max(1, most_files) - 1
            end = min(end, self.ends[last]) if last < len(self.ends) else end
        return max(start, end)


class ArrivalReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        if not options.get("state"):
            raise ValueError("a stream of records needs the option state, a folder of its own")
        self.schema, self.options = schema, options
        self._list: Arrivals | None = None

    def __getstate__(self) -> dict:
        return {"schema": self.schema, "options": self.options, "_list": None}

    def _arrivals(self) -> Arrivals:
        if self._list is None:
            self._list = Arrivals(self.options["state"])
        return self._list

    def initialOffset(self) -> dict:
        return {"bytes": 0}

    def latestOffset(self) -> dict:
        from facetide.sources.tfrecord import _record_files

        held = self._arrivals()
        held.add(_record_files(self.options["path"]))
        bounds = [int(self.options[n]) if self.options.get(n) else None for n in ("maxbytes", "maxfiles")]
        before = held.given()
        # What was given out may not have been taken before a failure. Then this step is larger by it, never smaller.
        offset = held.step(before, *bounds)
        if offset != before:
            held.give(offset)
        return {"bytes": offset}

    def partitions(self, start: dict, end: dict) -> list:
        from facetide.sources.tfrecord import cut

        return [s for path, size, a, b in self._arrivals().between(start["bytes"], end["bytes"])
                for s in cut(path, size, a, b, self.options)]

    def read(self, partition):
        from facetide.sources.tfrecord import TFRecordReader

        return TFRecordReader(self.schema, self.options).read(partition)
