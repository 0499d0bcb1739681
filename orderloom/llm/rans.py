"""A static range asymmetric numeral system over token ids, in numpy.

Ids are written in blocks of ``LANES`` interleaved streams: lane l codes ids l, l + LANES, … of its block, and all lanes
of a block share one run of 32-bit words. Every ``ROWS_PER_CHECKPOINT`` rows the block notes its word position and
lane states, so that decoding can start there. Many blocks are coded side by side, one row of each at a time.

States stay in [2^31, 2^63). A symbol with frequency f of 2^bits turns state x into (x // f << bits) + x % f + cum.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANES = 16
ROWS = 1024
ROWS_PER_CHECKPOINT = 256
BLOCK_IDS = LANES * ROWS
LOW = np.uint64(1 << 31)


@dataclass(frozen=True)
class Frequencies:
    """The shared table: for every id its share of 2^bits; ids that never occur have 0 and can't be coded."""

    share: np.ndarray
    bits: int

    @property
    def before(self) -> np.ndarray:
        return (np.cumsum(self.share) - self.share).astype(np.uint64)

    @property
    def id_at(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.share), dtype=np.int32), self.share)


def frequencies(counts: np.ndarray) -> Frequencies:
    """Shares in proportion to the counts, at least 1 for every id that occurs; the largest ones take up the rounding."""
    present = int((counts > 0).sum())
    bits = min(24, max(12, present.bit_length() + 2))
    share = np.zeros(len(counts), np.int64)
    if not present:
        return Frequencies(share, bits)
    total = float(counts.sum())
    share[counts > 0] = np.maximum(1, np.floor(counts[counts > 0] / total * (1 << bits))).astype(np.int64)
    short = (1 << bits) - int(share.sum())
    if short >= 0:
        share[int(counts.argmax())] += short
    for at in np.argsort(-share, kind="stable") if short < 0 else ():
        cut = min(int(share[at]) - 1, -short)
        share[at] -= cut
        short += cut
        if short == 0:
            break
    return Frequencies(share, bits)


@dataclass(frozen=True)
class Block:
    """One coded block. ``words`` as the decoder takes them, ``marks`` word positions and ``states`` at the checkpoints."""

    n: int
    words: np.ndarray
    marks: np.ndarray
    states: np.ndarray


def encode_blocks(ids: np.ndarray, table: Frequencies) -> list[Block]:
    """Blocks of ``BLOCK_IDS`` ids, the last one shorter. All full blocks are coded side by side."""
    full = len(ids) // BLOCK_IDS
    out = _encode(ids[: full * BLOCK_IDS].reshape(full, ROWS, LANES), table, BLOCK_IDS) if full else []
    rest = ids[full * BLOCK_IDS :]
    if len(rest):
        rows = -(-len(rest) // LANES)
        padded = np.full(rows * LANES, rest[0], ids.dtype)
        padded[: len(rest)] = rest
        out += _encode(padded.reshape(1, rows, LANES), table, len(rest))
    return out


def _encode(ids: np.ndarray, table: Frequencies, n: int) -> list[Block]:
    blocks, rows, lanes = ids.shape
    bits = np.uint64(table.bits)
    by_row = np.ascontiguousarray(ids.transpose(1, 0, 2))
    before, share = table.before, table.share.astype(np.uint64)
    state = np.full((blocks, lanes), LOW, np.uint64)
    words, owners = [], []
    checkpoints = -(-rows // ROWS_PER_CHECKPOINT)
    states = np.empty((blocks, checkpoints, lanes), np.uint64)
    left = np.zeros((blocks, checkpoints), np.int64)  # words that were given out before the checkpoint was reached
    given = np.zeros(blocks, np.int64)
    for row in range(rows - 1, -1, -1):
        f = share[by_row[row]]
        over = state >= f << (np.uint64(63) - bits)
        if over.any():
            block, lane = np.nonzero(over)
            words.append((state[block, lane] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            owners.append(block)
            state[block, lane] >>= np.uint64(32)
            given += over.sum(axis=1)
        quotient = state // f
        state = (quotient << bits) + (state - quotient * f) + before[by_row[row]]
        if row % ROWS_PER_CHECKPOINT == 0:
            states[:, row // ROWS_PER_CHECKPOINT] = state
            left[:, row // ROWS_PER_CHECKPOINT] = given
    flat = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    owner = np.concatenate(owners[::-1]) if owners else np.empty(0, np.int64)
    flat = flat[np.argsort(owner, kind="stable")]
    ends = np.cumsum(given)
    return [Block(n, flat[e - g : e], given[b] - left[b], states[b]) for b, (e, g) in enumerate(zip(ends, given, strict=True))]


def decode_blocks(blocks: list[Block], table: Frequencies) -> list[np.ndarray]:
    """The ids of each block. All stretches between checkpoints, of all blocks, are decoded side by side."""
    if not blocks:
        return []
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    id_at, share, before = table.id_at, table.share.astype(np.uint64), table.before
    words = np.concatenate([*(b.words for b in blocks), np.zeros(1, np.uint32)]).astype(np.uint64)
    base = np.cumsum([0, *(len(b.words) for b in blocks)])[:-1]
    at = np.concatenate([b.marks + o for b, o in zip(blocks, base, strict=True)])
    state = np.concatenate([b.states for b in blocks])
    rows = np.concatenate([_stretches(b.n) for b in blocks])
    order = np.argsort(-rows, kind="stable")
    at, state, rows = at[order], state[order], rows[order]
    out = np.zeros((len(rows), ROWS_PER_CHECKPOINT, LANES), np.int32)
    for row in range(int(rows.max())):
        live = int(np.searchsorted(-rows, -row, "left"))  # stretches with more than ``row`` rows
        x = state[:live]
        slot = x & mask
        found = id_at[slot.astype(np.int64)]
        out[:live, row] = found
        x = share[found] * (x >> bits) + slot - before[found]
        need = x < LOW
        place = at[:live, None] + np.cumsum(need, axis=1) - 1
        x[need] = (x[need] << np.uint64(32)) | words[place[need]]
        at[:live] += need.sum(axis=1)
        state[:live] = x
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    result, first = [], 0
    for b in blocks:
        count = len(b.marks)
        result.append(out[back[first : first + count]].reshape(-1)[: b.n])
        first += count
    return result


def _stretches(n: int) -> np.ndarray:
    """Rows in each stretch of a block of ``n`` ids."""
    rows = -(-n // LANES)
    return np.minimum(ROWS_PER_CHECKPOINT, rows - np.arange(0, rows, ROWS_PER_CHECKPOINT))
