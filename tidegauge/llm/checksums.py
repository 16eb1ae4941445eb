"""CRC-32C of many byte strings at once, in numpy, and the masking that record files use."""

from __future__ import annotations

import functools

import numpy as np

# The reversed Castagnoli polynomial and the masking constant of record files.
_POLYNOMIAL = 0x82F63B78
_MASK = 0xA282EAD8

_BLOCK = 512
_ALL_ONES = np.uint32(0xFFFFFFFF)


@functools.cache
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


@functools.cache
def _position_tables() -> np.ndarray:
    """Row j: what a byte adds to the register when j zero bytes follow it."""
    table = _byte_table()
    rows = [table]
    for _ in range(_BLOCK - 1):
        last = rows[-1]
        rows.append(table[last & 255] ^ (last >> 8))
    return np.stack(rows)


@functools.cache
def _shift_tables(power: int) -> np.ndarray:
    """Four tables that move a register over 2**power zero bytes."""
    if power == 0:
        table = _byte_table()
        values = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
        return (table[values & 255] ^ (values >> 8)).astype(np.uint32)
    half = _shift_tables(power - 1)
    return _shifted(half, half)




def _shifted(register: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return (
        tables[0][register & 255]
        ^ tables[1][(register >> 8) & 255]
        ^ tables[2][(register >> 16) & 255]
        ^ tables[3][register >> 24]
    )


def crc32c(strings: list[bytes]) -> np.ndarray:
    """The checksum of each string."""
    lengths = np.array([len(s) for s in strings], np.int64)
    blocks = -(-lengths // _BLOCK)
    register = np.zeros(len(strings), np.uint32)
    if blocks.sum():
        # Zero bytes in front change nothing, so every string is filled up to whole blocks there.
        filled = []
        for string, fill in zip(strings, (blocks * _BLOCK - lengths).tolist()):
            filled += (bytes(fill), string)
        parts = _block_registers(np.frombuffer(b"".join(filled), np.uint8).reshape(-1, _BLOCK))
        shift = _shift_tables(_BLOCK.bit_length() - 1)
        offset = np.cumsum(blocks) - blocks
        for step in range(int(blocks.max())):
            active = np.flatnonzero(blocks > step)
            register[active] = _shifted(register[active], shift) ^ parts[offset[active] + step]
    initial = np.full(len(strings), _ALL_ONES)
    for power in range(int(lengths.max(initial=0)).bit_length()):
        moved = np.flatnonzero((lengths >> power) & 1)
        initial[moved] = _shifted(initial[moved], _shift_tables(power))
    return register ^ initial ^ _ALL_ONES


def _block_registers(rows: np.ndarray, at_once: int = 8192) -> np.ndarray:
    tables = _position_tables()
    found = np.zeros(len(rows), np.uint32)
    for start in range(0, len(rows), at_once):
        columns = np.ascontiguousarray(rows[start : start + at_once].T)
        part = found[start : start + at_once]
        for step in range(_BLOCK):
            part ^= tables[_BLOCK - 1 - step].take(columns[step])
    return found


def masked(checksum: np.ndarray) -> np.ndarray:
    checksum = checksum.astype(np.uint32)
    return ((checksum >> 15) | (checksum << 17)) + np.uint32(_MASK)
