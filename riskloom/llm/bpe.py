"""Byte-pair vocabularies as flat arrays, and the cutting of texts into pre-tokens.

Equal pre-tokens give equal tokens, and a worker keeps the results of those it has seen in a bounded table.
"""

from __future__ import annotations

import base64
import json
import re
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache
from unicodedata import category

import numpy as np
import regex

#: No pair of symbols merges.
NONE = np.int32(2**31 - 1)
#: Pre-tokens a worker remembers before it starts again.
REMEMBERED = 500_000

#: The split pattern that is also written for `re` below, which is faster than `regex` and has no `\\p`.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@lru_cache(1)
def odd_characters() -> re.Pattern:
    """The characters that `\\s`, `\\w` and `\\d` class otherwise than the split pattern: separators U+1C to U+1F,
    numbers that are no decimal digits, code points without a meaning in this Python's tables, and all beyond U+FFFF."""
    odd = [
        c for c in range(1 << 16)
        if 0x1C <= c <= 0x1F or (chr(c).isalnum() and not chr(c).isalpha() and not chr(c).isdecimal()) or category(chr(c)) == "Cn"
    ]
    ends = [k for k in range(len(odd)) if k + 1 == len(odd) or odd[k + 1] != odd[k] + 1]
    ranges = "".join(f"\\u{odd[a]:04x}-\\u{odd[b]:04x}" for a, b in zip([0, *(k + 1 for k in ends)], ends))
    return re.compile(f"[{ranges}\\U00010000-\\U0010ffff]")


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into pre-tokens, as `regex` does with the pattern."""
    whole = regex.compile(pattern).findall
    if pattern != KNOWN_PATTERN:
        return whole
    plain, odd = PLAIN.findall, odd_characters().search
    return lambda text: whole(text) if odd(text) else plain(text)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a .json vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class PairTable:
    """(left id, right id) -> (rank, id of the merged symbol), as an open-addressed hash table in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        bits = max(10, int(np.ceil(np.log2(max(1, len(left)) * 6))))
        self.shift = np.uint64(64 - bits)
        size = 1 << bits
        self.mask = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NONE, np.int32)
        self.merged = np.zeros(size, np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        waiting, slot = np.arange(len(keys)), self.slots(keys)
        while len(waiting):
            free = self.keys[slot] < 0
            taken, first = np.unique(slot[free], return_index=True)
            placed = waiting[free][first]
            self.keys[taken], self.rank[taken], self.merged[taken] = keys[placed], rank[placed], merged[placed]
            left_over = ~np.isin(waiting, placed)
            waiting, slot = waiting[left_over], (slot[left_over] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; rank NONE where the pair does not merge."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self.slots(keys)
        held = self.keys[slot]
        rank = np.where(held == keys, self.rank[slot], NONE)
        merged = self.merged[slot]
        waiting = np.flatnonzero((held != keys) & (held >= 0))
        slot = slot[waiting]
        while len(waiting):
            slot = (slot + 1) & self.mask
            held, want = self.keys[slot], keys[waiting]
            hit = held == want
            rank[waiting[hit]] = self.rank[slot[hit]]
            merged[waiting[hit]] = self.merged[slot[hit]]
            more = ~hit & (held >= 0)
            waiting, slot = waiting[more], slot[more]
        return rank, merged


@dataclass
class Vocabulary:
    pairs: PairTable
    of_byte: np.ndarray  # id of each single byte
    symbols: list[bytes]  # bytes of each id
    special: dict[str, int] = field(default_factory=dict)


def from_json(path: str) -> Vocabulary:
    """A byte-level .json vocabulary: pairs merge as its merge list has them; special strings count as one token."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    ids, merges = whole["model"]["vocab"], whole["model"]["merges"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
    shown = byte_characters()
    back = {c: b for b, c in enumerate(shown)}
    special = {t["content"]: t["id"] for t in whole["added_tokens"] if t["special"]}
    symbols = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, k in ids.items():
        if token not in special:
            symbols[k] = bytes(back[c] for c in token)
    for token, k in special.items():
        symbols[k] = token.encode()
    left, right, merged = (
        np.array([ids[x] for x in column], np.int32)
        for column in (*zip(*merges), [a + b for a, b in merges])
    )
    pairs = PairTable(left, right, np.arange(len(merges), dtype=np.int32), merged)
    return Vocabulary(pairs, np.array([ids[c] for c in shown], np.int32), symbols, special)


def from_ranks(path: str) -> Vocabulary:
    """A rank file: any two neighbours merge whose joined bytes have a rank, and the rank is the id."""
    with open(path, "rb") as file:
        ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    symbols = [b""] * (max(ids.values()) + 1)
    left, right, merged = [], [], []
    for token, k in ids.items():
        symbols[k] = token
        for cut in range(1, len(token)):
            a, b = ids.get(token[:cut]), ids.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                merged.append(k)
    merged = np.array(merged, np.int32)
    pairs = PairTable(np.array(left, np.int32), np.array(right, np.int32), merged, merged)
    return Vocabulary(pairs, np.array([ids[bytes([b])] for b in range(256)], np.int32), symbols)


class Units:
    """Looks texts up pre-token by pre-token; unseen ones go to `solve` in batches.

    solve(list of utf-8 byte strings) gives one value for each; `join(values)` is the value of several in a row.
    """

    def __init__(self, pattern: str, solve: Callable, join: Callable, special: dict[str, object] | None = None):
        self.find = cutter(pattern)
        self.solve, self.join = solve, join
        self.special = special or {}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.forget()

    def forget(self) -> None:
        self.seen: dict[object, object] = {(s,): value for s, value in self.special.items()}
        self.held = 0

    def parts(self, text: str) -> list:
        """The pre-tokens of a text; special strings stand between them as tuples, so no pre-token equals one."""
        if not any(s in text for s in self.special):
            return self.find(text)
        out = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append((part,))
            else:
                out.extend(self.find(part))
        return out

    def values(self, texts: list[str]) -> list:
        """The joined value of each text."""
        if len(self.seen) > REMEMBERED or self.held > 32 * REMEMBERED:
            self.forget()
        parts = [self.parts(t) for t in texts]
        look = self.seen.get
        found = [list(map(look, p)) for p in parts]
        short = [k for k, values in enumerate(found) if None in values]
        if short:
            new = list({u for k in short for u, value in zip(parts[k], found[k]) if value is None})
            self.seen.update(zip(new, self.solve([u.encode() for u in new])))
            self.held += sum(map(len, new))
            for k in short:
                found[k] = list(map(look, parts[k]))
        return list(map(self.join, found))
