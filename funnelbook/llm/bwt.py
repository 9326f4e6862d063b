"""Burrows-Wheeler transforms of shards of strings, merged by iterative interleave refinement.

Each shard is a collection of byte strings with a terminator of its own after each. Its transform comes from its sorted
suffixes. Merging never compares suffixes of different shards: starting from the shards one after another, each round
takes the merged order by the first h symbols to that by the first h + 1, by sending every row to the place of the suffix one
symbol longer, which its own shard's transform tells. A row that is alone in its interval stays alone however long its suffix gets, so it leaves
the rounds; rows that leave in round h share h - 1 symbols with a neighbour, and those that never leave are the repeated intervals.
"""

from __future__ import annotations

import numpy as np


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order as positions in the joined strings, symbol before each). Terminators are 0, byte b is b + 1."""
    symbols = np.frombuffer(b"".join(s + b"\0" for s in strings), dtype=np.uint8).astype(np.uint16) + 1
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    symbols[ends] = 0
    rank = symbols.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))  # terminators differ and come in the order of their strings
    step, n = 1, len(symbols)
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (max(n, int(rank.max())) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], key[order[1:]] != key[order[:-1]]]))
        rank = new
        if rank[order[-1]] == n - 1 or 2 * step >= n:
            return order, symbols[order - 1]
        step *= 2


def merge(orders: list[np.ndarray], transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(position in the joined shards, interval) of the rows that agree with another in their first ``depth`` symbols, in merged order.

    A row that meets a terminator earlier agrees with none.
    """
    offsets = np.cumsum([0, *map(len, orders)])
    symbols = np.concatenate(transforms)
    if symbols.max(initial=0) < 256:  # always so for UTF-8, which has no byte 255
        symbols = symbols.astype(np.uint8)
    longer = np.empty(len(symbols), dtype=np.int32)
    for t, at in zip(transforms, offsets.tolist()):
        longer[at + np.argsort(t, kind="stable")] = at + np.arange(len(t), dtype=np.int32)
    row = np.arange(len(symbols), dtype=np.int32)
    interval = np.zeros(len(symbols), dtype=np.int32)
    for _ in range(depth):
        before = symbols[row]
        sent = np.argsort(before, kind="stable")[np.count_nonzero(before == 0):]  # a terminator before a row ends its suffixes
        first, rest = before[sent], interval[sent]
        begins = np.ones(len(sent) + 1, dtype=bool)
        np.not_equal(first[1:], first[:-1], out=begins[1:-1])
        begins[1:-1] |= rest[1:] != rest[:-1]
        shared = ~(begins[:-1] & begins[1:])
        row = longer[row[sent[shared]]]
        interval = np.cumsum(begins[:-1], dtype=np.int32)[shared]
    return np.concatenate([o + at for o, at in zip(orders, offsets)])[row], interval


def repeated(strings: list[bytes], depth: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, interval) of every substring of ``depth`` bytes that occurs at least twice, by interval."""
    shards: list[list[bytes]] = [[]]
    held = 0
    for s in strings:
        if held > shard_bytes:
            shards.append([])
            held = 0
        shards[-1].append(s)
        held += len(s) + 1
    made = [transform(s) for s in shards]
    place, interval = merge([o for o, _ in made], [t for _, t in made], depth)
    starts = np.cumsum([0, *(len(s) + 1 for s in strings)])
    string = np.searchsorted(starts, place, side="right") - 1
    return string, place - starts[string], interval
