"""CRC-32C of many byte strings at once, as the record format needs it, in numpy."""

from __future__ import annotations

import numpy as np

# The reflected Castagnoli polynomial, and the mask of the record format.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

LANE = 512  # bytes per lane; all lanes of all records advance together, eight bytes a step


def _tables() -> np.ndarray:
    """``tables[k][v]``: effect on the register of 16-bit value ``v`` followed by ``2 * k`` zero bytes."""
    reg = np.arange(65536, dtype=np.uint32)
    tables = []
    for _ in range(4):
        for _ in range(16):
            reg = (reg >> 1) ^ (np.uint32(POLYNOMIAL) * (reg & 1))
        tables.append(reg)
    return np.stack(tables)


_T = _tables()


def _advance(tables: np.ndarray, reg: np.ndarray) -> np.ndarray:
    return tables[0][reg & 0xFFFF] ^ tables[1][reg >> 16]


def _zeros(n_bytes: int) -> np.ndarray:
    """Two tables that advance a register, by its low and high half, over ``n_bytes`` (a power of two) zero bytes."""
    halves = np.stack([np.arange(65536, dtype=np.uint32), np.arange(65536, dtype=np.uint32) << np.uint32(16)])
    tables = _T[0][halves & 0xFFFF] ^ (halves >> 16)
    for _ in range(n_bytes.bit_length() - 2):
        tables = _advance(tables, tables)
    return tables


_LANE_SHIFT = _zeros(LANE)


def _register(words: np.ndarray) -> np.ndarray:
    """Registers, from zero, over the 16-bit words of each row; the row length is a multiple of four words."""
    columns = np.ascontiguousarray(words.T)
    reg = np.zeros(words.shape[0], dtype="<u4")
    for at in range(0, len(columns), 4):
        halves = reg.view("<u2").reshape(-1, 2)
        low, high = columns[at] ^ halves[:, 0], columns[at + 1] ^ halves[:, 1]
        reg = _T[3].take(low)
        reg ^= _T[2].take(high)
        reg ^= _T[1].take(columns[at + 2])
        reg ^= _T[0].take(columns[at + 3])
    return reg


def _equal_width(rows: list, width: int) -> np.ndarray:
    """CRCs of strings of 4 to ``width`` bytes. Zeros in front do not change a register that starts at zero."""
    grid = np.zeros((len(rows), width), dtype=np.uint8)
    for i, row in enumerate(rows):
        data = np.frombuffer(row, dtype=np.uint8)
        grid[i, width - len(data):] = data
        # Starting from all ones is the same as flipping the first four bytes.
        grid[i, width - len(data): width - len(data) + 4] ^= 0xFF
    if width <= LANE:
        return ~_register(grid.view("<u2"))
    lanes = _register(grid.reshape(-1, LANE).view("<u2")).reshape(len(rows), -1)
    reg = lanes[:, 0]
    for lane in range(1, lanes.shape[1]):
        reg = _advance(_LANE_SHIFT, reg) ^ lanes[:, lane]
    return ~reg


def _short(data: bytes) -> int:
    reg = 0xFFFFFFFF
    for byte in bytes(data):
        reg ^= byte
        for _ in range(8):
            reg = (reg >> 1) ^ (POLYNOMIAL if reg & 1 else 0)
    return reg ^ 0xFFFFFFFF


def crc32c(rows: list) -> np.ndarray:
    """CRC-32C of each bytes-like item."""
    out = np.empty(len(rows), dtype=np.uint32)
    groups: dict[int, list[int]] = {}
    for i, row in enumerate(rows):
        n = len(row)
        if n < 4:
            out[i] = _short(row)
        else:
            step = 8 if n <= LANE else LANE
            groups.setdefault(-(-n // step) * step, []).append(i)
    for width, members in groups.items():
        # Work on a few megabytes at a time, which stay in cache.
        chunk = max(1, (4 << 20) // width)
        for at in range(0, len(members), chunk):
            part = members[at:at + chunk]
            out[part] = _equal_width([rows[i] for i in part], width)
    return out


def mask(crc: np.ndarray) -> np.ndarray:
    crc = np.asarray(crc, dtype=np.uint32)
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK_DELTA)


def masked_of_words(values: np.ndarray) -> np.ndarray:
    """Masked CRCs of 64-bit little-endian integers, as the frame lengths need them."""
    words = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).copy()
    words[:, :4] ^= 0xFF
    return mask(~_register(words.view("<u2")))
