"""Records to Arrow columns, a block at a time.

All messages of a block are read in step, in numpy: the n-th feature of every message has its tags and lengths read at once,
its name compared with the names that are wanted, and only the place of its values kept. What is not of the plain shape
(a repeated name, an unknown tag, a missing feature that must be there, several values where one belongs, lists of byte
strings) is left to the parser of single messages, which also words the errors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from facetide.sources.example import LEN1, LEN2, LEN3

_TAGS = {"bytes": LEN1, "float": LEN2, "int": LEN3}
_PAD = 16


class Messages:
    """Messages at ``start`` to ``end`` of a buffer."""

    def __init__(self, buffer, start: np.ndarray, end: np.ndarray):
        # Reads of a tag and a length at the very end stay within the array.
        self.bytes = np.concatenate([np.frombuffer(buffer, np.uint8), np.zeros(_PAD, np.uint8)])
        self.view = memoryview(buffer)
        self.start, self.end = start, end
        self.plain = np.ones(len(start), bool)

    def varints(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, place after it) of the integers at some places; an overlong one ends far behind."""
        first = self.bytes[at]
        value, after = (first & 0x7F).astype(np.uint64), at + 1
        open_at = np.flatnonzero(first > 0x7F)
        for k in range(1, 10):
            if not len(open_at):
                return value, after
            b = self.bytes[np.minimum(at[open_at] + k, len(self.bytes) - 1)]
            value[open_at] |= (b & 0x7F).astype(np.uint64) << np.uint64(7 * k)
            after[open_at] += 1
            open_at = open_at[b > 0x7F]
        after[open_at] = 1 << 60
        return value, after

    def inside(self, at: np.ndarray, end: np.ndarray, tag) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether a field with this tag and a length begins at a place and ends by ``end``, its begin, its end)."""
        ok = at < end
        at = np.where(ok, at, 0)
        size, begin = self.varints(at + 1)
        ok &= (self.bytes[at] == tag) & (size < 1 << 40)
        last = begin + np.where(ok, size, 0).astype(np.int64)
        ok &= last <= end
        return ok, np.where(ok, begin, 0), np.where(ok, last, 0)

    def find(self, names: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each name: which messages have the feature, its kind's tag, and begin and end of its values."""
        n = len(self.start)
        raw = {name: np.frombuffer(name.encode(), np.uint8) for name in names}
        found = {name: (np.zeros(n, bool), np.zeros(n, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)) for name in names}
        ok, at, upto = self.inside(self.start, self.end, LEN1)
        empty = self.start == self.end
        self.plain &= empty | ok & (upto == self.end)
        rows = np.flatnonzero(self.plain & ~empty)
        at, upto = at[rows], upto[rows]
        while True:
            more = at < upto
            rows, at, upto = rows[more], at[more], upto[more]
            if not len(rows):
                return found
            ok, entry, entry_end = self.inside(at, upto, LEN1)
            good, key, key_end = self.inside(entry, entry_end, LEN1)
            ok &= good
            good, value, value_end = self.inside(key_end, entry_end, LEN2)
            ok &= good & (value_end == entry_end)
            tag = self.bytes[value]
            good, content, content_end = self.inside(value, value_end, tag)
            ok &= good & (content_end == value_end)
            self.plain[rows[~ok]] = False
            rows, key, size, tag, content, content_end, at, upto = (
                x[ok] for x in (rows, key, key_end - key, tag, content, content_end, entry_end, upto))
            for name, wanted in raw.items():
                same = np.flatnonzero(size == len(wanted))
                if not len(same):
                    continue
                same = same[(self.bytes[key[same][:, None] + np.arange(len(wanted))] == wanted).all(axis=1)]
                has, kind, begin, end = found[name]
                self.plain[rows[same][has[rows[same]]]] = False
                has[rows[same]] = True
                kind[rows[same]], begin[rows[same]], end[rows[same]] = tag[same], content[same], content_end[same]

    def single(self, kind: str, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, object]:
        """(whether it is one value, values) of a feature of each message."""
        ok, first, last = self.inside(begin, end, LEN1)
        ok &= last == end
        if kind == "bytes":
            return ok, (first, last)
        if kind == "float":
            ok &= last - first == 4
            return ok, self.bytes[np.where(ok, first, 0)[:, None] + np.arange(4)].view("<f4").ravel()
        value, after = self.varints(first)
        return ok & (first < last) & (after == last), value.view(np.int64)

    def many(self, kind: str, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether the numbers are packed, how many, all of them one after the other) of a feature of each message."""
        none = begin == end
        ok, first, last = self.inside(begin, end, LEN1)
        ok &= (last == end) & ((kind == "int") | ((last - first) % 4 == 0))
        size = np.where(ok, last - first, 0)
        ends = np.cumsum(size)
        held = self.bytes[np.repeat(np.where(ok, first, 0) - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        if kind == "float":
            return ok | none, size // 4, held.view("<f4")
        closes = held < 0x80
        ok &= (size == 0) | closes[np.maximum(ends - 1, 0)] if len(held) else ok
        last_of = np.flatnonzero(closes)
        first_of = np.append(0, last_of[:-1] + 1)[:len(last_of)]
        place = np.arange(len(held)) - np.repeat(first_of, last_of - first_of + 1) if len(last_of) and last_of[-1] == len(held) - 1 else None
        if place is None or (place > 9).any():
            return none, np.zeros(len(begin), np.int64), np.zeros(0, np.int64)
        parts = (held & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
        values = np.add.reduceat(parts, first_of) if len(parts) else parts
        before = np.append(0, np.cumsum(closes))
        return ok | none, before[ends] - before[ends - size], values.view(np.int64)


def _validity(has: np.ndarray):
    return None if has.all() else pa.py_buffer(np.packbits(has, bitorder="little"))


def columns(messages: Messages, fields: list[tuple[str, str, bool, bool]]) -> tuple[np.ndarray, list]:
    """(which messages are plain, a function for each field that makes its Arrow array for them).

    ``fields``: name, kind of values, whether it holds a list, and whether it must be there.
    """
    found = messages.find([f[0] for f in fields])
    held = []
    for name, kind, is_list, required in fields:
        has, tag, begin, end = found[name]
        here = has & messages.plain
        messages.plain &= (has | (not required)) & (~has | (tag == _TAGS[kind]))
        here &= messages.plain
        begin, end = np.where(here, begin, 0), np.where(here, end, 0)
        if is_list and kind == "bytes":
            messages.plain &= ~here
            values = None
        elif is_list:
            ok, *values = messages.many(kind, begin, end)
            messages.plain &= ~here | ok
        else:
            ok, values = messages.single(kind, begin, end)
            messages.plain &= ~here | ok
        held.append((kind, is_list, has, values))
    rows = np.flatnonzero(messages.plain)
    return messages.plain, [_array(messages, rows, *h) for h in held]


def _array(messages: Messages, rows: np.ndarray, kind: str, is_list: bool, has: np.ndarray, values) -> pa.Array:
    has = has[rows]
    if is_list and values is None:
        return pa.nulls(len(rows), pa.list_(pa.binary()))
    if is_list:
        many, flat = values
        ends = np.cumsum(many)
        keep = np.where(has, many[rows], 0)
        begin = (ends - many)[rows]
        last = np.cumsum(keep)
        flat = flat[np.repeat(begin - last + keep, keep) + np.arange(last[-1] if len(last) else 0)]
        offsets = pa.array(np.append(0, last), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array(~has))
    if kind == "bytes":
        first, last = (v[rows] for v in values)
        first, last = np.where(has, first, 0), np.where(has, last, 0)
        view = messages.view
        data = b"".join([view[a:b] for a, b in zip(first.tolist(), last.tolist())])
        offsets = np.append(0, np.cumsum(last - first)).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [_validity(has), pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.array(values[rows], mask=~has)
