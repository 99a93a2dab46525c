"""Vocabularies of byte-level BPE tokenizers, and their two exact encoders.

`PrefixEncoder` follows the prefix dynamic programme for BPE: every byte prefix of a piece has one
valid last token, so the encoding of a prefix is that token on top of the encoding of a shorter
prefix. Appending bytes extends the table, and a near edit re-uses it up to the edit.

`TrieCounter` counts longest-match subwords in linear time: a trie over token bytes with failure
links and, on each node, the number of tokens that following its failure link emits.
"""

from __future__ import annotations

import base64
from os.path import commonprefix


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The lines of a rank file: base64 of the token's bytes, a blank, its id."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class PrefixEncoder:
    """Encodes pieces by the valid last token of each byte prefix."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pairs: dict[int, bool] = {}
        #: The longest token that ends in these three bytes.
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            end = token[-3:]
            if len(end) == 3 and self.reach.get(end, 0) < len(token):
                self.reach[end] = len(token)

    def merged(self, data: bytes) -> list[bytes]:
        """Plain BPE by lowest rank first; only run on two joined tokens, to judge a pair."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are how their bytes are encoded."""
        a, b = self.bytes_of[left], self.bytes_of[right]
        found = self.pairs[left << 32 | right] = self.merged(a + b) == [a, b]
        return found

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fills `last`, the last token of each prefix of `data`, from where it ends."""
        get, pairs, reach = self.ranks.get, self.pairs.get, self.reach.get
        for end in range(len(last) + 1, len(data) + 1):
            for size in range(min(end, reach(data[end - 3 : end], 2) if end > 2 else 2), 0, -1):
                token = get(data[end - size : end])
                if token is None:
                    continue
                if size == end:
                    # a whole prefix is one token only if merging its bytes gives that token
                    if size == 1 or len(self.merged(data[:end])) == 1:
                        last.append(token)
                        break
                    continue
                before = last[end - size - 1]
                fits = pairs(before << 32 | token)
                if self.fits(before, token) if fits is None else fits:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")
        return last

    def unwind(self, last: list[int]) -> list[int]:
        """The tokens of the longest prefix in `last`."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[last[end - 1]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        return self.unwind(self.extend(piece, []))

    def reencode(self, old: bytes, last: list[int], new: bytes) -> list[int]:
        """The table of `new`, re-using that of `old` up to their first difference."""
        return self.extend(new, last[: len(commonprefix((old, new)))])

    def encode_all(self, pieces: list[bytes]) -> list[list[int]]:
        """The tokens of each piece. In sorted order, a piece re-uses its neighbour's table."""
        out: list[list[int]] = [[]] * len(pieces)
        old, last = b"", []
        for i in sorted(range(len(pieces)), key=pieces.__getitem__):
            last = self.reencode(old, last, pieces[i])
            old = pieces[i]
            out[i] = self.unwind(last)
        return out


class TrieCounter:
    """Counts longest-match tokens of a piece with failure links (all single bytes must be tokens)."""

    def __init__(self, tokens):
        self.children: list[dict[int, int]] = [{}]
        ends: list[bool] = [False]
        for token in tokens:
            node = 0
            for b in token:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    ends.append(False)
                node = nxt
            ends[node] = True
        n = len(self.children)
        #: Where to go on when no child fits, and how many tokens that step emits; -1 at the root.
        self.fail, self.emitted = [-1] * n, [0] * n
        level = [0]
        while level:
            below = []
            for node in level:
                for b, child in self.children[node].items():
                    below.append(child)
                    if ends[child]:
                        self.fail[child], self.emitted[child] = 0, 1
                        continue
                    at, count = self.fail[node], self.emitted[node]
                    while at >= 0 and b not in self.children[at]:
                        count += self.emitted[at]
                        at = self.fail[at]
                    if at < 0:
                        raise ValueError("the vocabulary lacks single bytes")
                    self.fail[child], self.emitted[child] = self.children[at][b], count
            level = below

    def count(self, piece: bytes) -> int:
        node, total = 0, 0
        for b in piece:
            while True:
                nxt = self.children[node].get(b)
                if nxt is not None:
                    node = nxt
                    break
                if node == 0:
                    raise ValueError("the vocabulary lacks single bytes")
                total += self.emitted[node]
                node = self.fail[node]
        while node:
            total += self.emitted[node]
            node = self.fail[node]
        return total
