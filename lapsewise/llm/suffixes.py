"""Sorting the suffixes of a text in two stages, as arrays.

A suffix is ascending if it is smaller than the suffix one byte on, else descending. Only ascending
suffixes are sorted directly. A scan of the buckets of first bytes, from the smallest, then puts the
descending ones in place: whatever stands in a bucket hands on the suffix that starts one byte earlier,
in order, to the bucket of that byte. Last come the common prefixes of neighbours.

As callers look for repeats of ``DEPTH`` bytes, suffixes that agree in ``8 * WORDS`` bytes and more may
stand in any order, and common prefixes are counted up to that length.
"""

from __future__ import annotations

import numpy as np

DEPTH = 50
WORDS = 7  # of 8 bytes


def words(text: np.ndarray) -> np.ndarray:
    """For each place the next 8 bytes as a number, zeros after the end; 64 places more than the text."""
    padded = np.concatenate([text, np.zeros(64 + 8, np.uint8)]).astype(np.uint64)
    two = padded[:-1] << np.uint64(8) | padded[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    return (four[:-4] << np.uint64(32) | four[4:])[: len(text) + 64]


def ascending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is not."""
    step = np.append(np.sign(text[1:].astype(np.int16) - text[:-1]), -1)
    decides = np.where(step != 0, np.arange(len(text)), len(text))
    decides = np.minimum.accumulate(decides[::-1])[::-1]  # the next place where the byte changes
    return step[decides] > 0


def direct_order(starts: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The suffixes at ``starts`` sorted by their first ``8 * WORDS`` bytes, word by word among ties."""
    starts = starts[np.argsort(word[starts], kind="stable")]
    new = np.append(True, word[starts[1:]] != word[starts[:-1]])
    for k in range(1, WORDS):
        group = np.cumsum(new)
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied):
            break
        some, of = starts[tied], group[tied]
        value = word[some + 8 * k]
        order = np.lexsort((value, of))
        some, value = some[order], value[order]
        starts[tied] = some
        new[tied] = np.append(True, (of[1:] != of[:-1]) | (value[1:] != value[:-1]))
    return starts


def suffix_order(text: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of the bytes in ascending order."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    up = ascending(text)
    counts, down_counts = np.bincount(text, minlength=256), np.bincount(text[~up], minlength=256)
    ends = np.cumsum(counts)
    begins = ends - counts
    order = np.empty(n, np.int64)
    direct = direct_order(np.flatnonzero(up), word)
    direct_ends = np.cumsum(counts - down_counts)
    for byte in np.flatnonzero(counts - down_counts):
        size = counts[byte] - down_counts[byte]
        order[ends[byte] - size : ends[byte]] = direct[direct_ends[byte] - size : direct_ends[byte]]
    heads = begins.copy()  # where the next descending suffix of each byte goes
    order[heads[text[-1]]] = n - 1  # what the empty suffix hands on
    heads[text[-1]] += 1
    for byte in np.flatnonzero(counts):
        low = begins[byte]
        while low < heads[byte]:  # descending suffixes that start with two equal bytes come from their own bucket
            before = order[low : heads[byte]] - 1
            low = heads[byte]
            before = before[before >= 0]
            before = before[(text[before] == byte) & ~up[before]]
            order[low : low + len(before)] = before
            heads[byte] += len(before)
        before = order[begins[byte] : ends[byte]] - 1
        before = before[before >= 0]
        before = before[(text[before] > byte) & ~up[before]]
        if len(before):
            to = text[before]
            by_byte = np.argsort(to, kind="stable")
            before, to = before[by_byte], to[by_byte]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            sizes = np.diff(np.append(first, len(to)))
            order[np.repeat(heads[to[first]] - first, sizes) + np.arange(len(to))] = before
            heads[to[first]] += sizes
    return order


def common_prefixes(order: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it, up to ``8 * WORDS``; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    left = np.arange(1, len(order))
    for k in range(WORDS):
        differ = word[order[left] + 8 * k] ^ word[order[left - 1] + 8 * k]
        zeros = sum((differ < np.uint64(1 << 8 * b)).astype(np.int64) for b in range(8))
        shared[left] += zeros
        left = left[differ == 0]
    return shared


def repeats(strings: list[bytes], firsts: np.ndarray) -> np.ndarray:
    """For each string a bit mask of the places where a run of ``DEPTH`` bytes starts that also occurs in a string of a smaller ``first``.

    Strings have fewer than ``DEPTH`` + 64 bytes, so that places fit into 64 bits.
    """
    text = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    masks = np.zeros(len(strings), np.uint64)
    if not len(text):
        return masks
    word = words(text)
    order = suffix_order(text, word)
    run = np.cumsum(common_prefixes(order, word) < DEPTH)
    string = np.repeat(np.arange(len(strings)), sizes)
    begins = np.cumsum(sizes) - sizes
    inside = order + DEPTH <= (begins + sizes)[string[order]]
    order, run = order[inside], run[inside]
    if not len(order):
        return masks
    owner = string[order]
    new = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    smallest = np.minimum.reduceat(firsts[owner], new)
    smallest = np.repeat(smallest, np.diff(np.append(new, len(run))))
    hit = smallest < firsts[owner]
    np.bitwise_or.at(masks, owner[hit], np.uint64(1) << (order[hit] - begins[owner[hit]]).astype(np.uint64))
    return masks
