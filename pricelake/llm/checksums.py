"""CRC-32C of many byte strings at once, with numpy.

A checksum is linear over bits: the checksum of a string is the exclusive-or
of its blocks' checksums, each moved on by the zeros that follow the block. So
all blocks of all strings run through the byte table side by side, and each
block's result is then moved to the end of its string by binary steps.
"""

from __future__ import annotations

import numpy as np

#: CRC-32C's polynomial, bits reversed (fixed value).
POLYNOMIAL = 0x82F63B78
#: Bytes that one lane runs through the table.
BLOCK = 32
#: Offset added by the masking of stored checksums (fixed value of the record format).
MASK_DELTA = 0xA282EAD8


def _byte_table() -> np.ndarray:
    """What a byte does to the checksum."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _move(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map, given by one table a byte, applied to each checksum."""
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


_TABLE = _byte_table()


def _one_zero() -> np.ndarray:
    """Tables of the map "one zero byte follows"."""
    values = np.arange(256, dtype=np.uint32)
    return np.stack([_TABLE[(v := values << np.uint32(8 * k)) & 255] ^ (v >> 8) for k in range(4)])


def _doubled(tables: np.ndarray) -> np.ndarray:
    """Tables of a map done twice."""
    return np.stack([_move(tables, t) for t in tables])


#: Zero bytes by powers of two, up to 2**39 of them.
_ZEROS = [_one_zero()]
for _ in range(39):
    _ZEROS.append(_doubled(_ZEROS[-1]))


def _followed_by(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each checksum moved on by its own number of zero bytes."""
    out, power = crc.copy(), 0
    while (zeros >> power).any():
        at = np.flatnonzero((zeros >> power) & 1)
        out[at] = _move(_ZEROS[power], out[at])
        power += 1
    return out


def crc32c(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32C of each ``data[begin:begin + size]`` (``data`` uint8; strings may be empty or overlap)."""
    size = np.asarray(size, np.int64)
    begin = np.asarray(begin, np.int64)
    lanes = -(-size // BLOCK)
    owner = np.repeat(np.arange(len(size)), lanes)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    # A string's first lane is the short one: zeros before the first byte leave a raw checksum as it is.
    stop = begin[owner] + size[owner] - (lanes[owner] - 1 - nth) * BLOCK
    crc = np.zeros(len(owner), np.uint32)
    first = np.flatnonzero(nth == 0)
    short = stop[first] - begin[owner[first]]
    for back in range(BLOCK, 0, -1):
        place = stop - back
        place[first[short < back]] = 0
        byte = data[place].astype(np.uint32) if len(place) else np.zeros(0, np.uint32)
        byte[first[short < back]] = 0
        crc = _TABLE[(crc ^ byte) & 255] ^ (crc >> np.uint32(8))
    crc = _followed_by(crc, (lanes[owner] - 1 - nth) * BLOCK)
    out = np.zeros(len(size), np.uint32)
    some = np.flatnonzero(lanes)
    if len(some):
        out[some] = np.bitwise_xor.reduceat(crc, (np.cumsum(lanes) - lanes)[some])
    return ~(out ^ _followed_by(np.full(len(size), 0xFFFFFFFF, np.uint32), size))


def masked(crc: np.ndarray) -> np.ndarray:
    """The form in which records store a checksum: turned right by 15 bits, plus a constant."""
    crc = np.atleast_1d(np.asarray(crc, np.uint32))
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
