"""The small protocol message held by each record: feature name to a list of integers, floats or byte strings."""

from __future__ import annotations

import struct

# Fixed values of the wire format: key bytes of "field 1..3, length-delimited", and the value kinds by field number.
LEN1, LEN2, LEN3 = 0x0A, 0x12, 0x1A
KINDS = {1: "bytes", 2: "float", 3: "int"}


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _wrap(key: int, parts: list[bytes], size: int) -> int:
    """Put the key and length of a message of ``size`` bytes in front of its parts; returns the new size."""
    head = bytes((key,)) + _varint(size)
    parts.insert(0, head)
    return size + len(head)


def encode(features: list[tuple[str, str, list]]) -> bytes:
    """Serialize ``(name, kind, values)`` features. Parts are joined once, so large values are copied once."""
    out: list[bytes] = []
    total = 0
    for name, kind, values in features:
        if kind == "bytes":
            parts = [p for v in values for p in (bytes((LEN1,)) + _varint(len(v)), v)]
            size = _wrap(LEN1, parts, sum(map(len, parts)))
        else:
            if kind == "float":
                packed = struct.pack(f"<{len(values)}f", *values)
            else:
                packed = b"".join(_varint(v & 0xFFFFFFFFFFFFFFFF) for v in values)
            parts = [packed]
            size = _wrap(LEN1, parts, len(packed))
            size = _wrap(LEN2 if kind == "float" else LEN3, parts, size)
        size = _wrap(LEN2, parts, size)
        text = name.encode()
        parts.insert(0, bytes((LEN1,)) + _varint(len(text)) + text)
        total += _wrap(LEN1, parts, size + len(parts[0]))
        out += parts
    _wrap(LEN1, out, total)
    return b"".join(out)


def _read_varint(buf, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        byte = buf[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(buf, at: int, end: int) -> list[tuple]:
    """(field number, wire type, start, end) of each field; a plain integer has its value for a start."""
    out = []
    while at < end:
        key = buf[at]
        at += 1
        if key > 0x7F:
            key, at = _read_varint(buf, at - 1)
        wire = key & 7
        if wire == 2:
            size = buf[at]
            at += 1
            if size > 0x7F:
                size, at = _read_varint(buf, at - 1)
            if at + size > end:
                raise ValueError("truncated message")
            out.append((key >> 3, wire, at, at + size))
            at += size
        elif wire == 0:
            value, at = _read_varint(buf, at)
            out.append((key >> 3, wire, value, None))
        elif wire in (1, 5):
            width = 8 if wire == 1 else 4
            out.append((key >> 3, wire, at, at + width))
            at += width
        else:
            raise ValueError(f"unsupported wire type {wire}")
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _values(buf, kind: str, start: int, end: int) -> list:
    out: list = []
    for number, wire, a, b in _fields(buf, start, end):
        if number != 1:
            continue
        if kind == "bytes":
            out.append(bytes(buf[a:b]))
        elif kind == "float":
            out.extend(struct.unpack(f"<{(b - a) // 4}f", buf[a:b]))
        elif wire == 0:
            out.append(_signed(a))
        else:
            while a < b:
                value, a = _read_varint(buf, a)
                out.append(_signed(value))
    return out


def decode(buf, wanted: set[str] | None = None) -> dict[str, tuple[str | None, list]]:
    """Feature name to (kind, values). Only ``wanted`` features are read, if given."""
    features: dict[str, tuple[str | None, list]] = {}
    for number, _, start, end in _fields(buf, 0, len(buf)):
        if number != 1:
            continue
        for number, _, a, b in _fields(buf, start, end):
            if number != 1:
                continue
            name, c, d = "", 0, 0
            for number, _, e, f in _fields(buf, a, b):
                if number == 1:
                    name = str(buf[e:f], "utf-8")
                elif number == 2:
                    c, d = e, f
            if wanted is None or name in wanted:
                kind, values = None, []
                for number, _, e, f in _fields(buf, c, d):
                    if number in KINDS:
                        kind, values = KINDS[number], _values(buf, KINDS[number], e, f)
                features[name] = (kind, values)
    return features
