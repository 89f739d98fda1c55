"""A minimal acyclic transducer from sorted terms to their ordinals, walked by whole texts.

Built incrementally from sorted terms: what can no longer change is replaced by an equal
part that exists already. An arrow carries the number of terms that come before those
behind it, so the sum along a term's path is its place in the sorted list. The arrows are
laid out as a double array (a state is its offset; arrow ``c`` of state ``s`` lies in slot
``s + c`` and names ``s`` as its owner), and all words of a text take a step at once.
"""

from __future__ import annotations

import pickle

import numpy as np
import zstandard


def _letters() -> tuple[bytes, np.ndarray]:
    """Bytes of the term class, A-Z lower-cased; all others become a blank."""
    table = bytearray(b" " * 256)
    for b in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        table[b] = b + 32 if b < 0x5B else b
    return bytes(table), np.frombuffer(bytes(table), np.uint8) != 32


# Every character outside ASCII is a letter, so the class of a character is that of its bytes.
LOWER, LETTER = _letters()


def terms_of(data: bytes) -> list[bytes]:
    return data.translate(LOWER).split()


class Transducer:
    """``own``, ``to``, ``add`` by slot; ``final`` by state; ``code`` by byte; state 0 is nowhere."""

    def __init__(self, terms: list[bytes]):
        """``terms``: sorted, distinct, none empty."""
        self.size, self.longest = len(terms), max(map(len, terms), default=0)
        nodes, root = _minimal(terms)
        used = sorted({b for _, edges in nodes for b, _ in edges})
        self.code = np.full(256, len(used) + 1, np.int32)
        self.code[used] = np.arange(1, len(used) + 1)
        self._lay_out(nodes, root, len(used) + 2)

    def _lay_out(self, nodes, root, codes: int):
        below = [0] * len(nodes)      # terms that end in a node or behind it; nodes come after their targets
        for n, (final, edges) in enumerate(nodes):
            below[n] = final + sum(below[t] for _, t in edges)
        taken, states, free = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool), 1
        code = self.code.tolist()
        state = [0] * len(nodes)
        # the largest nodes first: each in the first room that fits, looked for in growing windows
        for n in sorted(range(len(nodes)), key=lambda n: -len(nodes[n][1])):
            places = [code[b] for b, _ in nodes[n][1]]
            first, width = places[0] if places else 0, 256
            at = max(free, first + 1)
            while True:
                while len(taken) < at + width + codes:
                    taken, states = np.r_[taken, np.zeros_like(taken)], np.r_[states, np.zeros_like(states)]
                room = ~states[at - first:at - first + width]
                for c in places:
                    room &= ~taken[at - first + c:at - first + c + width]
                s = int(room.argmax())
                if room[s]:
                    break
                at, width = at + width, 2 * width
            s += at - first
            states[s] = True
            state[n] = s
            for c in places:
                taken[s + c] = True
            while taken[free]:
                free += 1
            free = max(free, s - (1 << 14))      # far behind, the room is too broken up
        top = max(state) + codes + 1
        self.own, self.to, self.add = (np.full(top, -1, np.int32) for _ in range(3))
        self.final = np.zeros(top, bool)
        self.root = state[root]
        for n, (final, edges) in enumerate(nodes):
            before = int(final)
            for b, t in edges:
                slot = state[n] + code[b]
                self.own[slot], self.to[slot], self.add[slot] = state[n], state[t], before
                before += below[t]
            self.final[state[n]] = final

    @property
    def bytes(self) -> int:
        return 13 * len(self.own)

    def dump(self) -> bytes:
        return zstandard.compress(pickle.dumps(self.__dict__))

    @classmethod
    def load(cls, blob: bytes) -> Transducer:
        out = cls.__new__(cls)
        out.__dict__ = pickle.loads(zstandard.decompress(blob))
        return out

    def walk(self, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words at ``start``: the indexes of those that are terms, and their ordinals."""
        lane = np.flatnonzero(length <= self.longest)
        lane = lane[np.argsort(-length[lane].astype(np.int32), kind="stable")]
        at, left = start[lane], length[lane]
        state, total = np.full(len(lane), self.root, np.int32), np.zeros(len(lane), np.int32)
        # how many words have a j-th byte: lanes are sorted by length
        going = len(lane) - np.searchsorted(left[::-1], np.arange(self.longest), side="right")
        for j, m in enumerate(going.tolist()):
            if not m:
                break
            slot = state[:m] + self.code[text[at[:m] + j]]
            on = self.own[slot] == state[:m]
            total[:m] += self.add[slot]
            state[:m] = np.where(on, self.to[slot], 0)
        hit = self.final[state]
        return lane[hit], total[hit]


def _minimal(terms: list[bytes]):
    """(nodes, root): a node is (final, ((byte, node), ...)); equal nodes exist once."""
    nodes: list[tuple] = []
    known: dict[tuple, int] = {}
    path = [[False, []]]          # the nodes along the last term, still open

    def close(depth: int):
        while len(path) > depth + 1:
            final, edges = path.pop()
            key = (final, tuple(edges))
            n = known.get(key)
            if n is None:
                n = known[key] = len(nodes)
                nodes.append(key)
            label = path[-1][1][-1][0]
            path[-1][1][-1] = (label, n)

    last = b""
    for term in terms:
        same = 0
        for x, y in zip(term, last, strict=False):
            if x != y:
                break
            same += 1
        close(same)
        for b in term[same:]:
            path[-1][1].append((b, None))
            path.append([False, []])
        path[-1][0] = True
        last = term
    close(0)
    nodes.append((path[0][0], tuple(path[0][1])))
    return nodes, len(nodes) - 1
