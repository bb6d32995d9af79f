"""Deep-shallow sorting of byte strings within groups: multikey quicksort first, blind tries for what is left.

The strings of all groups are sorted side by side. A pass of the multikey quicksort parts every open group in three
around a pivot, on the eight bytes at the group's depth; the middle part goes eight bytes deeper. A group of more
than one string at the shallow depth is left to a blind trie: strings are inserted by a descent that looks only at
branching bytes, one comparison finds the true common prefix, and a walk of the trie yields order and prefixes.
"""

import numpy as np

SHALLOW = 32
WORD = 8


def common_prefix(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
    return size - 1 - (differ.bit_length() - 1) // 8


class _Trie:
    """A blind trie. An inner node has the depth at which its children differ; the end of a string counts as -1."""

    __slots__ = ("depth", "children", "rows")

    def __init__(self, depth: int, children: dict | None, rows: list[int]):
        self.depth, self.children, self.rows = depth, children, rows


def _byte(text: bytes, at: int) -> int:
    return text[at] if at < len(text) else -1


def blind_trie_order(strings: list[bytes], rows: list[int]) -> tuple[list[int], list[int]]:
    """``rows`` in the order of their strings, and each one's common prefix with the row before it (the first: 0)."""
    root = _Trie(len(strings[rows[0]]), None, [rows[0]])
    for row in rows[1:]:
        text = strings[row]
        node = root
        while node.children is not None:
            node = node.children.get(_byte(text, node.depth)) or next(iter(node.children.values()))
        other = strings[node.rows[0]]
        if len(text) == len(other) and text == other:
            node.rows.append(row)
            continue
        depth = common_prefix(text, other)
        parent, node = None, root
        while node.children is not None and node.depth < depth:
            parent, node = node, node.children[_byte(text, node.depth)]
        leaf = _Trie(len(text), None, [row])
        if node.children is not None and node.depth == depth:
            node.children[_byte(text, depth)] = leaf
            continue
        fork = _Trie(depth, {_byte(other, depth): node, _byte(text, depth): leaf}, [])
        if parent is None:
            root = fork
        else:
            parent.children[_byte(text, parent.depth)] = fork
    order: list[int] = []
    prefixes: list[int] = []
    todo = [(root, 0)]
    while todo:
        node, before = todo.pop()
        if node.children is None:
            order += node.rows
            prefixes += [before] + [node.depth] * (len(node.rows) - 1)
            continue
        below = [node.children[b] for b in sorted(node.children)]
        todo += [(child, node.depth) for child in reversed(below[1:])]
        todo.append((below[0], before))
    return order, prefixes


def deep_shallow(strings: list[bytes], groups: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The rows in order of (group, string), and each one's common prefix with the row before it in its group.

    ``groups`` ascends. The first row of a group has prefix -1. Strings that are prefixes of others come first.
    """
    count = len(strings)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = shallow // WORD
    lengths = np.fromiter(map(len, strings), np.int64, count)
    heads = np.frombuffer(b"".join([s[:shallow].ljust(shallow, b"\0") for s in strings]), ">u8").astype(np.uint64).reshape(count, words)
    order = np.arange(count)
    cuts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    part = np.cumsum(np.r_[True, groups[1:] != groups[:-1]]) - 1  # of each place in the order
    depth = np.zeros(len(cuts), np.int64)
    sizes = np.diff(np.r_[cuts, count])
    while True:
        open_ = (sizes > 1) & (depth < words)
        if not open_.any():
            break
        places = np.flatnonzero(open_[part])
        own = part[places]
        rows = order[places]
        word = heads[rows, depth[own]]
        pivots = order[cuts + sizes // 2]
        pivot = heads[pivots, np.minimum(depth, words - 1)][own]
        side = (word > pivot).astype(np.int64) * 2 + (word == pivot)
        moved = np.lexsort((side, own))
        order[places] = rows[moved]
        label = np.zeros(count, np.int64)
        label[places] = side[moved]
        starts = np.r_[True, (part[1:] != part[:-1]) | (label[1:] != label[:-1])]
        cuts = np.flatnonzero(starts)
        depth = depth[part[cuts]] + (open_[part[cuts]] & (label[cuts] == 1))
        part = np.cumsum(starts) - 1
        sizes = np.diff(np.r_[cuts, count])
    for first, size in zip(cuts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        own = order[first : first + size].tolist()
        order[first : first + size] = blind_trie_order(strings, own)[0]
    prefix = _neighbours(strings, order, heads, lengths, shallow)
    prefix[np.r_[True, groups[order][1:] != groups[order][:-1]]] = -1
    return order, prefix


def _neighbours(strings: list[bytes], order: np.ndarray, heads: np.ndarray, lengths: np.ndarray, shallow: int) -> np.ndarray:
    """Common prefixes of neighbours: by words up to the shallow depth, by bytes beyond it."""
    out = np.zeros(len(order), np.int64)
    differ = heads[order[1:]] ^ heads[order[:-1]]
    word = (differ != 0).argmax(axis=1)
    first = differ[np.arange(len(differ)), word]
    same = ~differ.any(axis=1)
    bits = np.frombuffer(first.astype(">u8").tobytes(), np.uint8).reshape(-1, WORD)
    shared = word * WORD + (bits != 0).argmax(axis=1)
    shortest = np.minimum(lengths[order[1:]], lengths[order[:-1]])
    out[1:] = np.minimum(np.where(same, shallow, shared), shortest)
    for i in np.flatnonzero(same & (shortest > shallow)).tolist():
        out[i + 1] = common_prefix(strings[order[i]], strings[order[i + 1]])
    return out
