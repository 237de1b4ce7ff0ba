"""Adaptive radix trees over byte strings.

A node keeps the bytes that all its keys share from its parent on (path compression) and its
children in the smallest of four layouts that holds them: up to 4 or up to 16 in sorted
arrays, up to 48 behind an index of 256 bytes, and a full array of 256.
"""

from bisect import bisect_left


class Sorted:
    """Up to ``room`` children, their bytes in order."""

    __slots__ = ("bytes", "nodes", "room")

    def __init__(self, room=4):
        self.bytes, self.nodes, self.room = bytearray(), [], room

    def find(self, byte):
        at = bisect_left(self.bytes, byte)
        return self.nodes[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte, node):
        """Sets a child and returns the layout to go on with."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.bytes) == self.room:
            grown = Sorted(16) if self.room == 4 else Indexed()
            for b, n in zip(self.bytes, self.nodes):
                grown = grown.put(b, n)
            return grown.put(byte, node)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def __iter__(self):
        return iter(self.nodes)


class Indexed:
    """Up to 48 children in order of arrival, found through a place per byte."""

    __slots__ = ("places", "nodes")
    ROOM, NONE = 48, 255

    def __init__(self):
        self.places, self.nodes = bytearray([self.NONE]) * 256, []

    def find(self, byte):
        at = self.places[byte]
        return None if at == self.NONE else self.nodes[at]

    def put(self, byte, node):
        at = self.places[byte]
        if at != self.NONE:
            self.nodes[at] = node
            return self
        if len(self.nodes) == self.ROOM:
            grown = Full()
            for b, p in enumerate(self.places):
                if p != self.NONE:
                    grown.put(b, self.nodes[p])
            return grown.put(byte, node)
        self.places[byte] = len(self.nodes)
        self.nodes.append(node)
        return self

    def __iter__(self):
        return (self.nodes[p] for p in self.places if p != self.NONE)


class Full:
    """A place for each of the 256 bytes."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def find(self, byte):
        return self.nodes[byte]

    def put(self, byte, node):
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return (n for n in self.nodes if n is not None)


class Node:
    """``path``: bytes from the parent on, its own edge's first. ``value``: of the key that ends here."""

    __slots__ = ("path", "value", "children")

    def __init__(self, path=b"", value=None):
        self.path, self.value, self.children = path, value, Sorted()


def common(a: bytes, b: bytes) -> int:
    """How many first bytes two strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    """A map from byte strings to values that are not None; one key may begin another."""

    def __init__(self):
        self.root = Node()

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.find(key[at])
            if child is None:
                node.children = node.children.put(key[at], Node(key[at:], value))
                return
            path = child.path
            shared = common(path, key[at : at + len(path)])
            if shared < len(path):  # the child's path forks, or ends within it
                fork = Node(path[:shared])
                child.path = path[shared:]
                fork.children = fork.children.put(child.path[0], child)
                node.children = node.children.put(path[0], fork)
                child = fork
            node, at = child, at + shared
        node.value = value

    def get(self, key: bytes):
        node, at = self.root, 0
        while at < len(key):
            node = node.children.find(key[at])
            if node is None or key[at : at + len(node.path)] != node.path:
                return None
            at += len(node.path)
        return node.value

    def upwards(self):
        """``(node, byte depth of its end, number of child nodes)``, children first and in order."""
        todo = [(self.root, len(self.root.path), False)]
        while todo:
            node, depth, seen = todo.pop()
            if seen:
                yield node, depth, sum(1 for _ in node.children)
                continue
            todo.append((node, depth, True))
            below = [(c, depth + len(c.path), False) for c in node.children]
            todo.extend(reversed(below))
