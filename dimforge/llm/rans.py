"""Static range asymmetric numeral system (rANS) over token ids.

One frequency table, scaled to a power of two, serves every block.  A block
is coded by itself: its ids are dealt to ``lanes`` interleaved coders (id i to
lane i modulo lanes), each a 64-bit state that gives off 32-bit words, so one
numpy step codes an id of every lane.  A block holds its states, its words
and the CRC-32 of its ids, and can be decoded without any other block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 4096
LOW = 1 << 31
_HEAD = struct.Struct("<IIII")  # ids, lanes, words, crc32 of the ids as 32-bit integers


def scaled_frequencies(counts: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Counts scaled to sum to 2**bits; every id that occurs keeps at least 1.

    Without any count, every id gets the same share.  ``bits`` defaults to
    enough for 16 slots an id.
    """
    counts = np.asarray(counts, dtype=np.int64)
    bits = bits or max(12, int(len(counts)).bit_length() + 4)
    if bits > 30 or len(counts) > 1 << bits:
        raise ValueError(f"{len(counts)} ids don't fit {bits} bits")
    if not counts.any():
        counts = np.ones(len(counts), dtype=np.int64)
    size = 1 << bits
    freq = np.maximum((counts * (size / counts.sum())).astype(np.int64), (counts > 0).astype(np.int64))
    over = int(freq.sum()) - size
    if over < 0:
        freq[np.argmax(freq)] -= over
    while over > 0:  # the smallest were raised to 1: take it from the largest, in proportion
        spare = np.where(freq > 1, freq - 1, 0)
        cut = np.minimum(spare, -(-spare * over // spare.sum()))
        done = np.cumsum(cut)
        cut[done > over] = 0
        if not cut.any():
            cut[np.argmax(spare)] = min(over, int(spare.max()))
        freq -= cut
        over -= int(cut.sum())
    return freq.astype(np.uint32)


class Table:
    """Frequencies with their running sums and the slot-to-id table."""

    def __init__(self, freq: np.ndarray):
        self.bits = int(freq.sum(dtype=np.int64)).bit_length() - 1
        if int(freq.sum(dtype=np.int64)) != 1 << self.bits:
            raise ValueError("frequencies must sum to a power of two")
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.most = self.freq << np.uint64(63 - self.bits)
        self.ids = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def encode(ids: np.ndarray, table: Table) -> bytes:
    """One block."""
    n, lanes = len(ids), min(LANES, max(1, len(ids)))
    freq, start, most = table.freq[ids], table.start[ids], table.most[ids]
    if n and not freq.all():
        raise ValueError("an id has no frequency")
    state, bits, words = np.full(lanes, LOW, dtype=np.uint64), np.uint64(table.bits), []
    for at in range((n - 1) // lanes * lanes, -1, -lanes) if n else ():
        f = freq[at:at + lanes]
        x = state[:len(f)]
        full = x >= most[at:at + lanes]
        if full.any():
            words.append(x[full].astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[:len(f)] = (q << bits) + (x - q * f) + start[at:at + lanes]
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, dtype="<u4")
    return _HEAD.pack(n, lanes, len(stream), checksum(ids)) + state.astype("<u8").tobytes() + stream.tobytes()


def decode(block: bytes, table: Table) -> np.ndarray:
    """The ids of one block; raises if their checksum doesn't fit."""
    n, lanes, words, crc = _HEAD.unpack_from(block)
    state = np.frombuffer(block, dtype="<u8", count=lanes, offset=_HEAD.size).astype(np.uint64)
    stream = np.frombuffer(block, dtype="<u4", count=words, offset=_HEAD.size + 8 * lanes).astype(np.uint64)
    out, at, bits = np.empty(n, dtype=np.uint32), 0, np.uint64(table.bits)
    low, slots = np.uint64(LOW), np.uint64((1 << table.bits) - 1)
    for i in range(0, n, lanes):
        x = state[:min(lanes, n - i)]
        slot = x & slots
        ids = table.ids[slot]
        out[i:i + lanes] = ids
        x = table.freq[ids] * (x >> bits) + slot - table.start[ids]
        short = np.flatnonzero(x < low)
        if len(short):
            x[short] = (x[short] << np.uint64(32)) | stream[at:at + len(short)]
            at += len(short)
        state[:len(x)] = x
    if checksum(out) != crc or at != words:
        raise ValueError("a block of token ids is damaged")
    return out
