"""Aho-Corasick automata over bytes, as numpy tables."""

from __future__ import annotations

from collections import deque

import numpy as np


class ByteAutomaton:
    """go[node, byte] is total (failure links are folded in); word[node] is the key that ends exactly there or -1;
    out[node] is the nearest node on the failure path, the node itself included, where a key ends, or 0;
    link[node] is the next such node after out[node]."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        depth = [0]
        for number, key in enumerate(keys):
            node = 0
            for byte in key:
                nxt = children[node].get(byte)
                if nxt is None:
                    nxt = len(children)
                    children[node][byte] = nxt
                    children.append({})
                    ends.append(-1)
                    depth.append(depth[node] + 1)
                node = nxt
            if key:
                ends[node] = number
        n = len(children)
        self.go = np.zeros((n, 256), np.int32)
        self.word = np.array(ends, np.int32)
        self.depth = np.array(depth, np.int32)
        self.fail = np.zeros(n, np.int32)
        self.out = np.zeros(n, np.int32)
        self.link = np.zeros(n, np.int32)
        queue = deque()
        for byte, child in children[0].items():
            self.go[0, byte] = child
            queue.append(child)
        while queue:
            node = queue.popleft()
            fail = self.fail[node]
            behind = self.out[fail]
            self.out[node] = node if ends[node] >= 0 else behind
            self.link[node] = behind
            self.go[node] = self.go[fail]
            for byte, child in children[node].items():
                self.fail[child] = self.go[fail, byte]
                self.go[node, byte] = child
                queue.append(child)
