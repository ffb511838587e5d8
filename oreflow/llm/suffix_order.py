"""Deep-shallow order of fixed-length suffixes inside one task.

Multikey quicksort orders the suffixes by words of eight bytes to a shallow depth, and further where
very many are still equal; all segments are split at once. What is left goes to blind tries, one a
group: binary tries that keep the place of the first different bit alone. A suffix is led down by its
bits to a leaf, compared with that leaf's text once, and put in where they part. All groups take their
next member at the same time.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a word.
WORD = 8
#: Depth in bytes that quicksort goes to.
SHALLOW = 64
#: Most suffixes of a blind trie, whose depth can grow with their number; more are split further before.
BLIND = 48


def words_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, the first highest; zeros follow the end."""
    out = np.zeros(len(data) + WORD, np.uint64)
    out[: len(data)] = data
    for step in (1, 2, 4):
        out[:-step] = out[:-step] << np.uint64(8 * step) | out[step:]
        out[-step:] <<= np.uint64(8 * step)
    return out


def _quicksorted(words: np.ndarray, starts: np.ndarray, shallow: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order as far as they were compared, for each place the first of its group, and whether that is wholly equal."""
    order = np.arange(len(starts))
    done = np.empty(len(starts), np.int64)
    equal = np.zeros(len(starts), bool)
    places = np.arange(len(starts))  # places of the suffixes still to be split
    segment = np.zeros(len(starts), np.int64)  # first place of the segment of each
    level = np.zeros(len(starts), np.int64)  # bytes known to be equal in it
    while len(places):
        word = words[starts[order[places]] + np.minimum(level, length - WORD)]
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        size = np.diff(np.append(first, len(places)))
        pivot = np.repeat(word[first + size // 2], size)
        kind = (word >= pivot).astype(np.int8) + (word > pivot)
        # Stable three-way split of every segment: where each of the three parts starts, then a running count.
        before = [np.concatenate([[0], np.cumsum(kind == k)]) for k in range(3)]
        counts = [b[first + size] - b[first] for b in before]
        at = np.zeros(len(places), np.int64)
        offset = segment[first].copy()
        starts_of, sizes_of = np.empty(len(places), np.int64), np.empty(len(places), np.int64)
        for k in range(3):
            own = kind == k
            base = np.repeat(offset, size)
            at[own] = (base + before[k][:-1] - np.repeat(before[k][first], size))[own]
            starts_of[own], sizes_of[own] = base[own], np.repeat(counts[k], size)[own]
            offset += counts[k]
        deeper = level + WORD * (kind == 1)
        moved = order[places]
        order[at] = moved
        whole = deeper >= length
        ready = (sizes_of == 1) | whole | ((deeper >= shallow) & (sizes_of <= BLIND))
        done[at[ready]] = starts_of[ready]
        equal[at[ready]] = whole[ready]
        rest = np.argsort(at[~ready])
        places, segment, level = at[~ready][rest], starts_of[~ready][rest], deeper[~ready][rest]
    return order, done, equal


def _common_bits(words: np.ndarray, a: np.ndarray, b: np.ndarray, since: int, until: int) -> np.ndarray:
    """Equal leading bits of two suffixes each, which are known to agree up to byte `since`; at most 8 * until."""
    out = np.full(len(a), 8 * until, np.int64)
    open_ = np.arange(len(a))
    for depth in range(since, until, WORD):
        # The last word may reach back over bytes that are known to be equal.
        depth = min(depth, until - WORD)
        differs = words[a[open_] + depth] ^ words[b[open_] + depth]
        here = differs != 0
        if here.any():
            high = differs[here]
            # Exact position of the highest bit: halves first, since a double holds 53 bits.
            top = high >> np.uint64(32)
            upper = top != 0
            bits = np.frexp(np.where(upper, top, high).astype(np.float64))[1] + 32 * upper
            out[open_[here]] = 8 * depth + 64 - bits
            open_ = open_[~here]
        if not len(open_):
            break
    return out


def _bit(words: np.ndarray, starts: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (words[starts + (bit >> 6 << 3)] >> (63 - (bit & 63)).astype(np.uint64) & np.uint64(1)).astype(np.int64)


def _tried(words: np.ndarray, starts: np.ndarray, first: np.ndarray, size: np.ndarray, since: int, until: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank inside its group of each suffix, and the index of the equal suffix that came first (or itself).

    `starts` holds the groups one after the other. Nodes of a trie have negative numbers, leaves are
    the index of their suffix. An inner node knows its bit, its two children and how many suffixes it holds.
    """
    n = len(starts)
    same = np.arange(n)
    held = np.ones(n, np.int64)  # suffixes at a leaf
    bit, count = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    child = np.zeros((n + 1, 2), np.int64)
    root = first.copy()
    nodes = 1  # node k is written as -k
    by_size = np.argsort(-size, kind="stable")
    largest = int(size.max(initial=0))
    sizes_down = -size[by_size]
    for member in range(1, largest):
        groups = by_size[: np.searchsorted(sizes_down, -member, side="left")]
        new = first[groups] + member
        at = root[groups].copy()
        inner = np.flatnonzero(at < 0)
        while len(inner):
            k = -at[inner]
            at[inner] = child[k, _bit(words, starts[new[inner]], bit[k])]
            inner = inner[at[inner] < 0]
        common = _common_bits(words, starts[new], starts[at], since, until)
        equal = common >= 8 * until
        # Down again to the edge that the new suffix parts from; nodes on the way hold one more.
        node, above, side = root[groups].copy(), np.zeros(len(groups), np.int64), np.zeros(len(groups), np.int64)
        open_ = np.flatnonzero(node < 0)
        while len(open_):
            k = -node[open_]
            go = bit[k] < common[open_]
            open_, k = open_[go], k[go]
            count[k] += 1
            turn = _bit(words, starts[new[open_]], bit[k])
            above[open_], side[open_] = k, turn
            node[open_] = child[k, turn]
            open_ = open_[node[open_] < 0]
        leaf = at[equal]
        same[new[equal]] = leaf
        held[leaf] += 1
        part = np.flatnonzero(~equal)
        if len(part):
            made = nodes + np.arange(len(part))
            nodes += len(part)
            under, own = node[part], new[part]
            turn = _bit(words, starts[own], common[part])
            bit[made] = common[part]
            child[made, turn], child[made, 1 - turn] = own, under
            count[made] = 1 + np.where(under < 0, count[np.maximum(-under, 0)], held[np.maximum(under, 0)])
            top = above[part] == 0
            root[groups[part[top]]] = -made[top]
            low = ~top
            child[above[part[low]], side[part[low]]] = -made[low]
    rank = np.zeros(n, np.int64)
    node, base = root.copy(), np.zeros(len(root), np.int64)
    while len(node):
        leaves = node >= 0
        rank[node[leaves]] = base[leaves]
        k, base = -node[~leaves], base[~leaves]
        left, right = child[k, 0], child[k, 1]
        under = np.where(left < 0, count[np.maximum(-left, 0)], held[np.maximum(left, 0)])
        node, base = np.concatenate([left, right]), np.concatenate([base, base + under])
    # Equal suffixes follow their leaf in the order they came.
    later = np.flatnonzero(same != np.arange(n))
    if len(later):
        by_leaf = later[np.argsort(same[later], kind="stable")]
        leaf = same[by_leaf]
        begins = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
        nth = np.arange(len(leaf)) - np.repeat(begins, np.diff(np.append(begins, len(leaf))))
        rank[by_leaf] = rank[leaf] + 1 + nth
    return rank, same


def ordered(data: np.ndarray, starts: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at `starts` in order of their first `length` bytes, and for each place whether it equals the one before.

    `length` bytes must follow every start, and `length` be at least `shallow` and eight.
    """
    words = words_of(data)
    shallow = min(shallow, length) // WORD * WORD
    order, group, whole = _quicksorted(words, starts, shallow, length)
    if not len(starts):
        return order, whole
    inside = np.append(False, group[1:] == group[:-1])
    equal = whole & inside
    first = np.flatnonzero(~inside)
    size = np.diff(np.append(first, len(group)))
    deep = (size > 1) & ~whole[first]
    if deep.any():
        first, size = first[deep], size[deep]
        places = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        own = order[places]
        begins = np.cumsum(size) - size
        rank, same = _tried(words, starts[own], begins, size, shallow, length)
        to = np.repeat(first, size) + rank
        order[to] = own
        equal[to] = same != np.arange(len(own))
    return order, equal
