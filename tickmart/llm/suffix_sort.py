"""Deep-shallow sorting of strings: multikey quicksort to a shallow depth, blind tries below it."""

from __future__ import annotations

import numpy as np

#: Bytes that multikey quicksort looks at; what agrees so far goes to a blind trie.
SHALLOW = 64


def multikey_quicksort(words: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the rows of ``words`` within their segments: the order, and labels that are equal where
    segment and all words are.

    A character is one word. In each round every segment is parted around the word of its middle row;
    its middle part goes on to the next word, the outer ones stay. All segments advance together.
    """
    order = np.argsort(segment, kind="stable")
    label = segment[order]
    label = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])]) if len(label) else label
    level = np.zeros(len(order), np.int64)
    active = np.arange(len(order))
    while True:
        mine = label[active]
        begins = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]])) if len(mine) else np.zeros(0, np.int64)
        sizes = np.diff(begins, append=len(mine))
        go_on = (sizes > 1) & (level[active[begins]] < words.shape[1])
        keep = np.repeat(go_on, sizes)
        active, sizes = active[keep], sizes[go_on]
        if not len(active):
            return order, label
        begins = np.cumsum(sizes) - sizes
        value = words[order[active], level[active]]
        pivot = np.repeat(value[begins + sizes // 2], sizes)
        part = (value > pivot).astype(np.int64) - (value < pivot) + 1
        key = np.repeat(np.arange(len(sizes)), sizes) * 3 + part
        moved = np.argsort(key, kind="stable")
        order[active] = order[active[moved]]
        key = key[moved]
        level[active] += part[moved] == 1
        new = np.concatenate([[True], key[1:] != key[:-1]])
        label[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]


class BlindTrie:
    """Strings by the positions at which they part alone. A string goes down without comparing what
    lies between these positions, is compared once with the string it arrives at, and then knows
    where it parts."""

    __slots__ = ("root", "strings")

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        #: A leaf is the list of equal strings' numbers; a node is (position, {byte: below}).
        self.root: object = [0]
        for number in range(1, len(strings)):
            self.insert(number)

    def insert(self, number: int) -> None:
        string, node = self.strings[number], self.root
        while isinstance(node, tuple):
            position, below = node
            node = below.get(string[position]) or next(iter(below.values()))
        other = self.strings[node[0]]
        if other == string:
            # by way of positions where both agree, so this is where it belongs
            node.append(number)
            return
        size = len(string)
        differ = int.from_bytes(string) ^ int.from_bytes(other)
        part = size - (differ.bit_length() + 7) // 8
        above, edge, node = None, 0, self.root
        while isinstance(node, tuple) and node[0] < part:
            above, edge = node, string[node[0]]
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == part:
            node[1][string[part]] = [number]
            return
        new = (part, {other[part]: node, string[part]: [number]})
        if above is None:
            self.root = new
        else:
            above[1][edge] = new

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo.extend(node[1][byte] for byte in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def sort_strings(strings: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows (equally long strings of bytes) within their segments, and the length each
    row in order has in common with the one before it; -1 where a segment begins."""
    n, width = strings.shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth = min(SHALLOW, width // 8 * 8)
    words = np.ascontiguousarray(strings[:, :depth]).view(">u8").astype(np.uint64)
    order, label = multikey_quicksort(words, segment)
    begins = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
    sizes = np.diff(begins, append=n)
    # segments whose rows are all alike need no trie
    rest = strings[order, depth:]
    unlike = (rest != np.repeat(rest[begins], sizes, axis=0)).any(1)
    mixed = np.flatnonzero(np.add.reduceat(unlike, begins) > 0)
    for start, size in zip(begins[mixed].tolist(), sizes[mixed].tolist(), strict=True):
        trie = BlindTrie([row.tobytes() for row in rest[start : start + size]])
        order[start : start + size] = order[start : start + size][trie.order()]
    ordered = strings[order]
    common = np.full(n, -1, np.int64)
    differ = ordered[1:] != ordered[:-1]
    common[1:] = np.where(differ.any(1), differ.argmax(1), width)
    common[1:][segment[order[1:]] != segment[order[:-1]]] = -1
    return order, common
