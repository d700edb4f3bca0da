"""An adaptive radix tree over byte strings: nodes that grow with their children, compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Few:
    """Up to `most` children beside their sorted bytes: the layouts of 4 and of 16."""

    __slots__ = ("most", "bytes", "nodes")

    def __init__(self, most: int):
        self.most, self.bytes, self.nodes = most, bytearray(), []

    def find(self, byte: int) -> Node | None:
        i = bisect_left(self.bytes, byte)
        return self.nodes[i] if i < len(self.bytes) and self.bytes[i] == byte else None

    def put(self, byte: int, node: Node) -> Few | Indexed:
        """With the child in place of any it has at this byte; the layout that holds them."""
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.nodes[i] = node
            return self
        if len(self.nodes) == self.most:
            larger = Few(16) if self.most == 4 else Indexed()
            for b, n in self:
                larger.put(b, n)
            return larger.put(byte, node)
        self.bytes.insert(i, byte)
        self.nodes.insert(i, node)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes)


class Indexed:
    """Up to 48 children behind a table of their places by byte."""

    __slots__ = ("place", "nodes")

    def __init__(self):
        self.place, self.nodes = bytearray(256), []

    def find(self, byte: int) -> Node | None:
        i = self.place[byte]
        return self.nodes[i - 1] if i else None

    def put(self, byte: int, node: Node) -> Indexed | Direct:
        i = self.place[byte]
        if i:
            self.nodes[i - 1] = node
            return self
        if len(self.nodes) == 48:
            larger = Direct()
            for b, n in self:
                larger.put(b, n)
            return larger.put(byte, node)
        self.nodes.append(node)
        self.place[byte] = len(self.nodes)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[i - 1]) for b, i in enumerate(self.place) if i)


class Direct:
    """A place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes: list[Node | None] = [None] * 256

    def find(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Direct:
        self.nodes[byte] = node
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """The bytes behind the parent's branch (`path`), the value of the key that ends there, children."""

    __slots__ = ("path", "value", "children", "sums")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.children, self.sums = path, value, None, None

    def put(self, byte: int, node: Node) -> None:
        self.children = (Few(4) if self.children is None else self.children).put(byte, node)

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return iter(self.children or ())


def shared(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of `path` the key has from `at` on."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(path[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Tree:
    """Keys and their values; a key that is put twice keeps the last value."""

    def __init__(self):
        self.root = Node(b"")

    def put(self, key: bytes, value) -> None:
        node, at, above, branch = self.root, 0, None, 0
        while True:
            same = shared(node.path, key, at)
            if same < len(node.path):
                upper = Node(node.path[:same])
                upper.put(node.path[same], node)
                node.path = node.path[same + 1 :]
                above.put(branch, upper)  # the root has no path, so there is a node above
                node = upper
            at += same
            if at == len(key):
                node.value = value
                return
            below = node.children.find(key[at]) if node.children is not None else None
            if below is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            above, branch = node, key[at]
            node, at = below, at + 1
