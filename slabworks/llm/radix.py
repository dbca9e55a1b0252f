"""An adaptive radix tree over byte strings: inner nodes grow from 4 to 16, 48 and 256 slots, paths are compressed."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to 4, later 16 children beside their sorted key bytes."""

    __slots__ = ("keys", "children", "room")

    def __init__(self, room: int = 4):
        self.keys, self.children, self.room = bytearray(), [], room

    def get(self, byte: int):
        at = bisect_left(self.keys, byte)
        return self.children[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, child):
        """Sets a child; returns the layout that now holds it, a larger one if this was full."""
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.children[at] = child
        elif len(self.keys) < self.room:
            self.keys.insert(at, byte)
            self.children.insert(at, child)
        else:
            larger = Sorted(16) if self.room == 4 else Indexed()
            for b, c in self.items():
                larger.put(b, c)
            return larger.put(byte, child)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.children)


class Indexed:
    """Up to 48 children, found by an index of 256 bytes."""

    __slots__ = ("index", "children")

    def __init__(self):
        self.index, self.children = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, child):
        if at := self.index[byte]:
            self.children[at - 1] = child
        elif len(self.children) < 48:
            self.children.append(child)
            self.index[byte] = len(self.children)
        else:
            larger = Direct()
            for b, c in self.items():
                larger.put(b, c)
            return larger.put(byte, child)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.children[at - 1]) for b, at in enumerate(self.index) if at)


class Direct:
    """A slot for each of 256 bytes."""

    __slots__ = ("slots",)

    def __init__(self):
        self.slots = [None] * 256

    def get(self, byte: int):
        return self.slots[byte]

    def put(self, byte: int, child):
        self.slots[byte] = child
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, c) for b, c in enumerate(self.slots) if c is not None)


class Node:
    """``path``: the bytes between the parent's slot and this node; ``ends``: values of the keys that end here."""

    __slots__ = ("path", "layout", "ends")

    def __init__(self, path: bytes):
        self.path, self.layout, self.ends = path, None, []

    def get(self, byte: int) -> Node | None:
        return self.layout and self.layout.get(byte)

    def put(self, byte: int, child: Node) -> None:
        self.layout = (self.layout or Sorted()).put(byte, child)

    def items(self) -> Iterator[tuple[int, Node]]:
        return self.layout.items() if self.layout else iter(())


def _common(a: bytes, b: bytes) -> int:
    """The length of the longest common prefix."""
    if a == b[: len(a)]:
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


class Tree:
    """Keys may be empty, repeat and be prefixes of each other; equal keys' values stay in the order in which they came."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = Node(key)
            self.root.ends.append(value)
            return
        above, node, at = None, self.root, 0
        while True:
            m = _common(node.path, key[at : at + len(node.path)])
            if m < len(node.path):  # the paths part inside this one
                upper = Node(node.path[:m])
                byte = node.path[m]
                node.path = node.path[m + 1 :]
                upper.put(byte, node)
                if above is None:
                    self.root = upper
                else:
                    above.put(key[at - 1], upper)
                node = upper
            at += m
            if at == len(key):
                node.ends.append(value)
                return
            child = node.get(key[at])
            if child is None:
                leaf = Node(key[at + 1 :])
                leaf.ends.append(value)
                node.put(key[at], leaf)
                return
            above, node, at = node, child, at + 1

    def post_order(self) -> Iterator[tuple[Node, int, int]]:
        """(node, bytes above its path's first byte, bytes down to its end), children before their parents."""
        stack = [(self.root, 0, len(self.root.path), False)] if self.root else []
        while stack:
            node, start, end, open_ = stack.pop()
            if open_:
                yield node, start, end
                continue
            stack.append((node, start, end, True))
            for _, child in node.items():
                stack.append((child, end, end + 1 + len(child.path), False))
