"""Deep-shallow suffix sorting of many byte strings at once.

Shallow part: multikey quicksort on words of eight bytes, down to ``SHALLOW`` bytes: three-way partitions by
a pivot word, of which only the equal part goes a word deeper; all open groups are split in one step. Deep
part: groups that still agree share a long prefix; each gets a blind trie, which stores only branching
depths and bytes, finds a new string's place with one descent and one comparison of whole strings, and
returns the order together with the common prefixes of neighbours.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the multikey quicksort looks at; deeper ties go to blind tries.
SHALLOW = 24


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """An ordered trie of byte strings that keeps branching depths and bytes, not the strings' parts.

    A node is ``[depth, {byte: child}]``, a leaf the number of its string; equal strings share a leaf.
    The end of a string sorts before every byte (-1).
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | int | None = None
        self.same: dict[int, list[int]] = {}

    @staticmethod
    def _byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def insert(self, k: int) -> None:
        s = self.strings[k]
        if self.root is None:
            self.root = k
            return
        node, path = self.root, []
        while isinstance(node, list):  # blind: bytes between the branching depths are not looked at
            path.append(node)
            children = node[1]
            byte = self._byte(s, node[0])
            node = children.get(byte)
            if node is None:
                node = next(iter(children.values()))
        other = self.strings[node]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            self.same.setdefault(node, []).append(k)
            return
        parent = None
        at = self.root
        for step in path:
            if step[0] >= depth:
                break
            parent, at = step, step[1].get(self._byte(s, step[0]))
        if isinstance(at, list) and at[0] == depth:
            at[1][self._byte(s, depth)] = k
            return
        fork = [depth, {self._byte(other, depth): at, self._byte(s, depth): k}]
        if parent is None:
            self.root = fork
        else:
            parent[1][self._byte(s, parent[0])] = fork

    def walk(self) -> tuple[list[int], list[int]]:
        """Numbers in order, and each one's common prefix with the one before (the first: 0)."""
        order: list[int] = []
        prefixes: list[int] = []
        stack: list[tuple[list | int | None, int]] = [(self.root, 0)] if self.root is not None else []
        while stack:
            node, prefix = stack.pop()
            if isinstance(node, list):
                depth, children = node
                ordered = sorted(children, reverse=True)
                for j, byte in enumerate(ordered):
                    stack.append((children[byte], depth if j < len(ordered) - 1 else prefix))
            else:
                order.append(node)
                prefixes.append(prefix)
                for k in self.same.get(node, ()):
                    order.append(k)
                    prefixes.append(len(self.strings[node]))
        return order, prefixes


def _keys(strings: list[bytes]) -> np.ndarray:
    """``keys[d]``: every string's eight bytes from ``8 * d`` on as a big-endian word, missing bytes as zero."""
    raw = b"".join([x[:SHALLOW].ljust(SHALLOW, b"\0") for x in strings])
    return np.ascontiguousarray(np.frombuffer(raw, ">u8").reshape(len(strings), SHALLOW // 8).T).astype(np.uint64)


def multikey_quicksort(strings: list[bytes], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by label and then by their first SHALLOW bytes, and for each place where its group begins.

    A group is a run of places that agree in the label and all bytes looked at so far; each has a depth of its
    own. A step splits every open group, all in one pass over arrays, by the pivot that its middle member
    holds at the group's depth: smaller, equal and greater members become three groups, of which only the
    equal one goes eight bytes deeper. A group is done when it has one member or is SHALLOW bytes deep.
    """
    n = len(strings)
    words = _keys(strings)
    sizes = np.fromiter(map(len, strings), np.int64, n)
    order = np.argsort(label, kind="stable")
    first = np.r_[True, label[order][1:] != label[order][:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    depth = np.zeros(n, np.int64)  # by place, in words
    open_ = np.arange(n)
    while len(open_):
        count = np.bincount(start[open_], minlength=n)
        open_ = open_[(count[start[open_]] > 1) & (depth[open_] < SHALLOW // 8)]
        if not len(open_):
            break
        group, member, d = start[open_], order[open_], depth[open_]
        pivot = order[group + count[group] // 2]
        x, y = words[d, member], words[d, pivot]
        # a string that ends inside the word sorts before one that goes on with zero bytes
        left, right = np.clip(sizes[member] - 8 * d, 0, 8), np.clip(sizes[pivot] - 8 * d, 0, 8)
        side = np.where((x > y) | ((x == y) & (left > right)), 2, np.where((x == y) & (left == right), 1, 0))
        # whole groups are open or done, so a stable sort by group and side permutes places inside groups only
        moved = np.argsort(3 * group + side, kind="stable")
        order[open_] = member[moved]
        key = (3 * group + side)[moved]
        new = np.r_[True, key[1:] != key[:-1]]
        start[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        depth[open_] = d[moved] + (side[moved] == 1)
    return order, start


def deep_shallow_sort(strings: list[bytes], group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings (by group first, if given) and common prefixes of neighbours in it.

    Strings of different groups have common prefix -1. Byte order; a string sorts before its extensions.
    """
    n = len(strings)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    outer = np.zeros(n, np.int64) if group is None else np.unique(group, return_inverse=True)[1].astype(np.int64)
    order, start = multikey_quicksort(strings, outer)
    starts = np.unique(start)
    out, prefixes = order.copy(), np.zeros(n, np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
        if b - a == 2:  # a trie of two strings is their comparison
            x, y = (strings[k] for k in order[a:b])
            prefixes[a + 1] = common_prefix(x, y)
            if y < x:
                out[a], out[a + 1] = order[a + 1], order[a]
        elif b - a > 1:
            members = order[a:b]
            trie = BlindTrie([strings[k] for k in members])
            for k in range(b - a):
                trie.insert(k)
            inner, common = trie.walk()
            out[a:b] = members[inner]
            prefixes[a:b] = common
        if a:
            x, y = out[a - 1], out[a]
            prefixes[a] = -1 if outer[x] != outer[y] else common_prefix(strings[x], strings[y])
    return out, prefixes
