"""Canonical Huffman codes of limited length, and vectorised packing and decoding of ids."""

import numpy as np

#: Longest code in bits: the decoding table has ``2 ** LIMIT`` entries.
LIMIT = 18
#: Ids between two checkpoints.
STEP = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    levels = [np.ones(len(leaves), dtype=bool)]  # which entries of a level's list are leaves
    merged = leaves
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(leaves))
        merged = both[order]
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[used[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sizes = lengths[order].astype(np.int64)
    code, last = 0, 0
    # One step for each length, not for each id.
    for size in np.unique(sizes):
        ids = order[sizes == size]
        code <<= int(size) - last
        codes[ids] = code + np.arange(len(ids), dtype=np.uint64)
        code, last = code + len(ids), int(size)
    return codes


def decoding_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """The id and the code length for each value of the next ``limit`` bits."""
    codes = canonical_codes(lengths)
    ids = np.zeros(1 << limit, dtype=np.uint32)
    sizes = np.zeros(1 << limit, dtype=np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    # Canonical codes in this order fill the table from its start without gaps.
    spans = np.left_shift(1, limit - lengths[order].astype(np.int64))
    filled = int(spans.sum())
    assert not len(order) or int(codes[order[0]]) == 0
    ids[:filled] = np.repeat(order, spans)
    sizes[:filled] = np.repeat(lengths[order], spans)
    return ids, sizes


def bit_sizes(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bits of each run of ids that begins at ``starts``; no run is empty."""
    return np.add.reduceat(lengths[ids].astype(np.int64), starts)


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes one after the other, and the bit at which each begins."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    words = (total + 31) // 32 + 1
    # A code lies in one or two words of 32 bits. Sums of disjoint bits stay
    # below 2 ** 32, which doubles hold exactly.
    placed = codes[ids] << (64 - sizes - (begins & 31)).astype(np.uint64)
    word = begins >> 5
    high = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), words)
    low = np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), words + 1)
    packed = (high + low[:words]).astype(">u4").tobytes()
    return packed[: (total + 7) // 8], begins


def unpack(
    data: np.ndarray, begins: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray], limit: int = LIMIT
) -> np.ndarray:
    """Ids of independent runs: run i has ``counts[i]`` ids from bit ``begins[i]``.

    All runs advance together by one id a step, so a step is one look-up for
    many runs. The longest runs come first and the finished ones fall away.
    """
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    windows = np.ndarray((len(padded) - 3,), dtype=">u4", buffer=padded, strides=(1,))
    ids, sizes = table
    order = np.argsort(-counts, kind="stable")
    left = counts[order]
    at = begins[order].astype(np.int64)
    first = (np.cumsum(counts) - counts)[order]
    out = np.empty(int(counts.sum()), dtype=np.uint32)
    shift = np.int64(32 - limit)
    for step in range(int(left[0]) if len(left) else 0):
        alive = int(np.searchsorted(-left, -step, side="left"))
        at, first = at[:alive], first[:alive]
        key = (windows[at >> 3].astype(np.int64) << (at & 7) & 0xFFFFFFFF) >> shift
        out[first + step] = ids[key]
        at += sizes[key]
    return out
