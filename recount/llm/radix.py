"""An adaptive radix tree over byte strings.

Inner nodes come in four layouts and grow from one to the next: sorted lists of 4 or 16 branches, an
index of 256 bytes into 48 branches, and 256 slots. A node holds the bytes that all its keys share below its
branch (path compression), so a node is made only where keys part or one ends within others. Of a key
that others go on from, the value is kept at the inner node.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class _Listed:
    """Up to ``room`` branches: sorted bytes and the nodes below them."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int, branches: list[tuple[int, "Node"]] = ()):
        self.room = room
        self.bytes = bytearray(b for b, _ in branches)
        self.nodes = [n for _, n in branches]

    def get(self, byte: int) -> "Node | None":
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: "Node") -> "_Listed | _Indexed":
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
        elif len(self.bytes) < self.room:
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)
        else:
            branches = list(self.items())
            return (_Listed(16, branches) if self.room == 4 else _Indexed(branches)).put(byte, node)
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return zip(self.bytes, self.nodes)


class _Indexed:
    """Up to 48 branches: of each byte the place of its node, 0 for none."""

    __slots__ = ("place", "nodes")

    def __init__(self, branches: list[tuple[int, "Node"]]):
        self.place, self.nodes = bytearray(256), []
        for b, n in branches:
            self.nodes.append(n)
            self.place[b] = len(self.nodes)

    def get(self, byte: int) -> "Node | None":
        at = self.place[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node: "Node") -> "_Indexed | _Slots":
        at = self.place[byte]
        if at:
            self.nodes[at - 1] = node
        elif len(self.nodes) < 48:
            self.nodes.append(node)
            self.place[byte] = len(self.nodes)
        else:
            return _Slots(self.items()).put(byte, node)
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.place) if at)


class _Slots:
    """A slot for every byte."""

    __slots__ = ("nodes",)

    def __init__(self, branches: Iterator[tuple[int, "Node"]]):
        self.nodes: list[Node | None] = [None] * 256
        for b, n in branches:
            self.nodes[b] = n

    def get(self, byte: int) -> "Node | None":
        return self.nodes[byte]

    def put(self, byte: int, node: "Node") -> "_Slots":
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """``prefix``: the bytes shared below the branch that leads here. ``value``: that of the key ending
    here, or None. ``branches``: None as long as nothing goes on."""

    __slots__ = ("prefix", "value", "branches")

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value, self.branches = prefix, value, None

    def put(self, byte: int, node: "Node") -> None:
        self.branches = (self.branches or _Listed(4)).put(byte, node)

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return self.branches.items() if self.branches else iter(())


def shared(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] equals b[:low], a[:high] doesn't
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        """Adds a key, or replaces its value."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, above, byte, at = self.root, None, 0, 0
        while True:
            same = shared(node.prefix, key[at : at + len(node.prefix)])
            if same < len(node.prefix):  # the path parts within the prefix
                fork = Node(node.prefix[:same])
                fork.put(node.prefix[same], node)
                node.prefix = node.prefix[same + 1 :]
                if above is None:
                    self.root = fork
                else:
                    above.put(byte, fork)
                node = fork
            at += same
            if at == len(key):
                node.value = value
                return
            below = node.branches.get(key[at]) if node.branches else None
            if below is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            node, above, byte, at = below, node, key[at], at + 1

    def get(self, key: bytes):
        node, at = self.root, 0
        while node is not None:
            if key[at : at + len(node.prefix)] != node.prefix:
                return None
            at += len(node.prefix)
            if at == len(key):
                return node.value
            node, at = (node.branches.get(key[at]) if node.branches else None), at + 1
        return None
