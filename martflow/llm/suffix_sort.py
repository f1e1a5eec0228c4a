"""Deep-shallow suffix sorting of substrings of a fixed length.

Suffixes are ordered by their first ``length`` bytes only.  A multikey
quicksort splits groups three ways about a pivot character (eight bytes at a
time, all open groups at once) until they differ or agree on ``shallow``
bytes; a group that agrees that far, with a long common prefix to come, is
ordered by a blind trie, which compares each suffix with a single other one.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def shallow_sort(data: np.ndarray, at: np.ndarray, group: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the suffixes ``at`` within their groups, by the
    first ``shallow`` bytes (a multiple of 8; ``data`` reaches that far).

    Returns the suffixes' order and, in that order, the number of the run of
    suffixes that agree on those bytes.
    """
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = np.ndarray((len(data) - WORD + 1,), dtype=">u8", buffer=data.tobytes(), strides=(1,))
    order = np.argsort(group, kind="stable")
    run = np.cumsum(np.concatenate(([0], np.diff(group[order]) != 0)))
    depth = np.zeros(len(order), dtype=np.int64)
    place = np.arange(len(order))
    while True:
        size = np.bincount(run, minlength=len(order) + 1)
        open_ = (size[run] > 1) & (depth < shallow)
        if not open_.any():
            return order, run
        mine, runs = place[open_], run[open_]
        first = np.concatenate(([True], runs[1:] != runs[:-1]))
        begin = np.flatnonzero(first)
        of = np.cumsum(first) - 1
        w = words[at[order[mine]] + depth[mine]].astype(np.uint64)
        middle = begin + np.diff(np.concatenate((begin, [len(runs)]))) // 2
        pivot = w[middle][of]
        side = 1 + (w > pivot).astype(np.int64) - (w < pivot)
        sub = of * 3 + side
        again = np.argsort(sub, kind="stable")
        order[mine] = order[mine][again]
        depth[mine] = depth[mine][again] + np.where(side[again] == 1, WORD, 0)
        split = np.zeros(len(order), dtype=bool)
        split[mine] = np.concatenate(([False], np.diff(sub[again]) != 0))
        split[mine[begin]] = True
        closed = np.concatenate(([True], run[1:] != run[:-1]))
        run = np.cumsum(split | closed) - 1


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two different strings of one length."""
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


class _Leaf:
    __slots__ = ("text", "members")

    def __init__(self, text: bytes, member: int):
        self.text, self.members = text, [member]


class _Fork:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int):
        self.depth, self.kids = depth, {}


def blind_trie(texts: list[bytes]) -> list[list[int]]:
    """The texts' indexes (all of one length) in order; equal ones in one list."""
    root: _Leaf | _Fork | None = None
    for i, s in enumerate(texts):
        if root is None:
            root = _Leaf(s, i)
            continue
        node = root
        while type(node) is _Fork:  # blind: only the branching bytes are looked at
            kids = node.kids
            node = kids.get(s[node.depth]) or next(iter(kids.values()))
        if node.text == s:
            node.members.append(i)
            continue
        t = node.text
        depth = _common(s, t)
        above, node = None, root
        while type(node) is _Fork and node.depth < depth:
            above, node = node, node.kids[s[node.depth]]
        if type(node) is _Fork and node.depth == depth:
            node.kids[s[depth]] = _Leaf(s, i)
            continue
        fork = _Fork(depth)
        fork.kids[t[depth]], fork.kids[s[depth]] = node, _Leaf(s, i)
        if above is None:
            root = fork
        else:
            above.kids[s[above.depth]] = fork
    out: list[list[int]] = []
    stack = [root] if root is not None else []
    while stack:
        node = stack.pop()
        if type(node) is _Leaf:
            out.append(node.members)
        else:
            stack += [node.kids[c] for c in sorted(node.kids, reverse=True)]
    return out


def deep_shallow(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int, shallow: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): the suffixes ``at`` by group and first ``length`` bytes,
    and, in that order, the number of the run of equal ones."""
    order, run = shallow_sort(data, at, group, shallow)
    raw = data.tobytes()
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate((starts, [len(run)])))
    split = np.zeros(len(run), dtype=bool)
    split[starts] = True
    for b, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        mine = order[b:b + n]
        classes = blind_trie([raw[p + shallow:p + length] for p in at[mine].tolist()])
        if len(classes) > 1:
            order[b:b + n] = mine[[i for c in classes for i in c]]
            k = b
            for c in classes:
                split[k] = True
                k += len(c)
    return order, np.cumsum(split) - 1
