"""CRC-32 of very many spans of one byte buffer, without a loop over bytes.

CRC-32 is linear: what a byte adds to the checksum depends only on the byte and on
its distance from the end of the span. A table of these contributions turns the
checksums of all spans into one look-up and one ``bitwise_xor.reduceat``; what the
initial value adds depends only on the length. A span longer than the table is
cut into blocks from its end, and blocks are folded in pairs.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 64
CHUNK_BYTES = 1 << 20
# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)


def _one_byte() -> np.ndarray:
    """What a byte adds when it is the last one."""
    states = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        odd = (states & np.uint32(1)).astype(bool)
        states = np.where(odd, (states >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), states >> np.uint32(1))
    return states


class SpanCrc:
    """Tables for spans up to ``block`` bytes, and operators that pass over more bytes."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        last = _one_byte()
        rows = [last]
        state, lengths = np.full(1, ONES), []
        for _ in range(block):
            lengths.append(state[0] ^ ONES)
            state = last[state & np.uint32(255)] ^ (state >> np.uint32(8))
            rows.append(last[rows[-1] & np.uint32(255)] ^ (rows[-1] >> np.uint32(8)))
        # Row d of the table: a byte with d bytes behind it.
        self.table = np.concatenate(rows[:block])
        self.lengths = np.array(lengths, dtype=np.uint32)
        # A state passed over ``block`` zero bytes: its bytes are as a block's first four.
        self.passes = [[rows[block - 1 - j] for j in range(4)]]

    def _pass_over(self, states: np.ndarray, power: int) -> np.ndarray:
        """States after ``block * 2**power`` zero bytes."""
        while len(self.passes) <= power:
            half = len(self.passes) - 1
            self.passes.append([self._pass_over(row, half) for row in self.passes[half]])
        tables = self.passes[power]
        result = tables[0][states & np.uint32(255)]
        for j in (1, 2, 3):
            result = result ^ tables[j][(states >> np.uint32(8 * j)) & np.uint32(255)]
        return result

    def _of_lengths(self, sizes: np.ndarray) -> np.ndarray:
        """CRC-32 of so many zero bytes."""
        blocks = sizes // self.block
        result = self.lengths[sizes % self.block]
        power = 0
        while (blocks >> power).any():
            there = np.flatnonzero((blocks >> power) & 1)
            result[there] = self._pass_over(result[there] ^ ONES, power) ^ ONES
            power += 1
        return result

    def _fold(self, parts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One state for each span from the states of its blocks, first block first."""
        firsts = np.cumsum(counts) - counts
        result = parts[firsts]
        levels = np.ceil(np.log2(counts)).astype(np.int64)
        for level in np.unique(levels[counts > 1]):
            spans = np.flatnonzero((levels == level) & (counts > 1))
            width = 1 << int(level)
            # Zero blocks in front change nothing.
            folded = np.zeros((len(spans), width), dtype=np.uint32)
            for row, span in enumerate(spans):
                n = counts[span]
                folded[row, width - n :] = parts[firsts[span] : firsts[span] + n]
            for power in range(int(level)):
                folded = self._pass_over(folded[:, ::2], power) ^ folded[:, 1::2]
            result[spans] = folded[:, 0]
        return result

    def _some(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        base = starts[0]
        piece = np.append(data[base : ends[-1]], np.uint8(0))
        starts, ends = starts - base, ends - base
        sizes = ends - starts
        # Spans and the gaps between them, in turn.
        edges = np.empty(2 * len(starts) + 1, dtype=np.int64)
        edges[:-1:2], edges[1:-1:2], edges[-1] = starts, ends, len(piece)
        behind = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(piece)) - 1
        added = self.table[(behind % self.block) * 256 + piece]
        counts = -(-sizes // self.block)
        if counts.max() == 1:
            # The last edge is the end of the buffer, where nothing begins.
            states = np.bitwise_xor.reduceat(added, edges[:-1])[::2]
        else:
            number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            left = np.repeat(counts, counts) - number
            cuts = np.maximum(np.repeat(starts, counts), np.repeat(ends, counts) - left * self.block)
            bounds = np.concatenate([cuts, ends])
            inside = np.concatenate([np.ones(len(cuts), bool), np.zeros(len(ends), bool)])
            order = np.lexsort((inside, bounds))
            bounds, inside = bounds[order], inside[order]
            # Where a span begins at the end of another, the gap is empty.
            kept = np.append(bounds[1:] != bounds[:-1], True)
            parts = np.bitwise_xor.reduceat(added, bounds[kept])[inside[kept]]
            states = self._fold(parts, counts)
        return states ^ self._of_lengths(sizes)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of ``data[start:end]`` for spans in order that are not empty and don't overlap."""
        result = np.empty(len(starts), dtype=np.uint32)
        done = 0
        while done < len(starts):
            upto = max(done + 1, int(np.searchsorted(ends, starts[done] + CHUNK_BYTES)))
            result[done:upto] = self._some(data, starts[done:upto], ends[done:upto])
            done = upto
        return result
