"""Deep-shallow sorting of many strings of one width, and the common prefixes of neighbours.

Multikey quicksort, three ways by eight bytes at a time, goes to the shallow depth. Strings that still agree there go
into a blind trie: its nodes hold only the place of a difference, so a string is let down unread to some leaf, one
comparison with that leaf gives their common prefix, and the string is put in at that depth.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 8  # words of eight bytes
FEW = 8


def _blind_trie(numbers: list[int], values: dict[int, int], width: int) -> list[int]:
    """Order of strings given as big-endian numbers of ``width`` bytes."""

    def byte(value: int, at: int) -> int:
        return value >> 8 * (width - 1 - at) & 255

    root: list | int = numbers[0]  # a leaf is a number, a node [place, {byte: node or leaf}]
    same: dict[int, list[int]] = {numbers[0]: [numbers[0]]}
    for number in numbers[1:]:
        value = values[number]
        node = root
        while isinstance(node, list):
            children = node[1]
            node = children.get(byte(value, node[0]))
            if node is None:
                node = next(iter(children.values()))
        apart = value ^ values[node]
        if not apart:
            same[node].append(number)
            continue
        place = width - 1 - (apart.bit_length() - 1) // 8
        same[number] = [number]
        above, key, node = None, 0, root
        while isinstance(node, list) and node[0] < place:
            above, key = node, byte(value, node[0])
            node = above[1].get(key)
        if isinstance(node, list) and node[0] == place:
            node[1][byte(value, place)] = number
        else:
            other = node
            while isinstance(other, list):
                other = next(iter(other[1].values()))
            fresh = [place, {byte(value, place): number, byte(values[other], place): node}]
            if above is None:
                root = fresh
            else:
                above[1][key] = fresh
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += [node[1][k] for k in sorted(node[1], reverse=True)]
        else:
            out += same[node]
    return out


def deep_shallow_order(rows: np.ndarray) -> np.ndarray:
    """The sorted order of the rows of a byte matrix; equal rows keep their order or not."""
    count, width = rows.shape
    if not count:
        return np.zeros(0, np.int64)
    words = -(-width // 8)
    padded = np.zeros((count, words * 8), np.uint8)
    padded[:, :width] = rows
    keys = padded.view(">u8").astype(np.uint64)
    raw = [r.tobytes() for r in rows]
    out: list[int] = []
    stack = [(np.arange(count), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) <= FEW:
            out += sorted(group.tolist(), key=raw.__getitem__)
        elif depth >= min(SHALLOW, words):
            own = group.tolist()
            values = {i: int.from_bytes(raw[i], "big") for i in own}
            out += _blind_trie(own, values, width)
        else:
            own = keys[group, depth]
            pivot = np.partition(own[[0, len(own) // 2, -1]], 1)[1]
            low, high = own < pivot, own > pivot
            if high.any():
                stack.append((group[high], depth))
            stack.append((group[~(low | high)], depth + 1))
            if low.any():
                stack.append((group[low], depth))
    return np.array(out, np.int64)


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        apart = rows[order[1:]] != rows[order[:-1]]
        first = apart.argmax(axis=1)
        out[1:] = np.where(apart[np.arange(len(first)), first], first, rows.shape[1])
    return out
