"""Canonical length-limited Huffman codes over ids, with numpy.

Bits are written from the highest bit of each byte on.  A block has a bit
offset for every ``CHECKPOINT`` ids, so that all stretches between checkpoints
are decoded side by side, one table look-up per id."""

from __future__ import annotations

import numpy as np

CHECKPOINT = 128
LEAST_LIMIT = 18


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Code length per symbol (0 where the count is 0), by package-merge: the
    least total size of any prefix code without a length above the limit."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    limit = max(LEAST_LIMIT, int(n - 1).bit_length() + 2)
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    # Each level merges the leaves with the pairs of the level before; only which items are leaves is kept.
    is_leaf, items = [], leaves
    is_leaf.append(np.ones(n, bool))
    for _ in range(limit - 1):
        m = len(items) // 2 * 2
        packages = items[:m:2] + items[1:m:2]
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        items = both[at]
        is_leaf.append(at < n)
    take = 2 * n - 2
    lengths = np.zeros(n, np.int64)
    for level in reversed(is_leaf):
        chosen = int(level[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    if len(used):
        used = used[np.argsort(lengths[used], kind="stable")]
        l = lengths[used].astype(np.int64)
        top = int(l[-1])
        # Left-aligned, each code is the sum of the intervals before it.
        width = np.left_shift(np.int64(1), top - l)
        start = np.concatenate([[0], np.cumsum(width)[:-1]])
        codes[used] = (start >> (top - l)).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """(table, bits): entry = symbol << 8 | length, indexed by the next ``bits`` bits."""
    used = np.flatnonzero(lengths)
    if not len(used):
        return np.ones(2, np.uint32), 1
    used = used[np.argsort(lengths[used], kind="stable")]
    l = lengths[used].astype(np.int64)
    bits = int(l[-1])
    table = np.ones(1 << bits, np.uint32)  # unused codes step over one bit
    filled = np.repeat((used.astype(np.uint32) << np.uint32(8)) | l.astype(np.uint32), np.left_shift(1, bits - l))
    table[:len(filled)] = filled
    return table, bits


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(payload, checkpoints) of the ids."""
    if not len(ids):
        return b"", b""
    l = lengths[ids].astype(np.int64)
    end = np.cumsum(l)
    start = end - l
    word = start >> 5
    # Each code in a 64-bit window that begins at its 32-bit word.
    window = codes[ids] << (64 - l - (start & 31)).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    at = word[first]
    out[at] = np.bitwise_or.reduceat(window >> np.uint64(32), first)
    out[at + 1] |= np.bitwise_or.reduceat(window & np.uint64(0xFFFFFFFF), first)
    payload = out.astype(">u4").tobytes()[:(int(end[-1]) + 7) // 8]
    return payload, start[::CHECKPOINT].astype("<u4").tobytes()


def decode_blocks(blocks: list[tuple[bytes, bytes, int]], table: np.ndarray, bits: int) -> list[np.ndarray]:
    """Ids of the blocks (payload, checkpoints, number of ids), decoded together."""
    pad = b"\0" * 8
    joined = np.frombuffer(b"".join([*(p + pad for p, _, _ in blocks), b"\0" * (CHECKPOINT * 4)]), np.uint8)
    view = ((joined[:-3].astype(np.uint32) << 24) | (joined[1:-2].astype(np.uint32) << 16)
            | (joined[2:-1].astype(np.uint32) << 8) | joined[3:])
    base = np.cumsum([0, *(len(p) + 8 for p, _, _ in blocks)])[:-1] * 8
    starts = [np.frombuffer(c, "<u4").astype(np.int64) + b for (_, c, _), b in zip(blocks, base, strict=True)]
    at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    out = np.empty((CHECKPOINT, len(at)), np.uint32)
    last, mask, keep = (len(view) - 1) * 8, np.uint32((1 << bits) - 1), 32 - bits
    for row in out:
        entry = table[(view[at >> 3] >> (keep - (at & 7)).astype(np.uint32)) & mask]
        row[:] = entry >> 8
        at = np.minimum(at + (entry & 0xFF), last)  # a block's last stretch may be shorter
    flat = out.T.reshape(-1)
    first = np.cumsum([0, *(len(s) for s in starts)]) * CHECKPOINT
    return [flat[i:i + n] for i, (_, _, n) in zip(first, blocks)]
