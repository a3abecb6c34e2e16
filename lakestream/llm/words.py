"""Words of many texts at once, as arrays. Words are stretches of bytes other than ASCII white space."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: The first n bytes of eight, read as a number.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: An odd factor and its inverse modulo 2 ** 64, for hashes of runs of words.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit number with its bits spread over the whole of it."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class RunHashes:
    """Hashes of runs of consecutive numbers: equal runs have equal hashes, wherever they stand."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.back = powers(INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(FACTOR, n), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


@dataclass
class Words:
    """All words of some texts: the texts with one blank between words, where each word starts and ends there,
    the number of its text, and a hash that equal words share."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray


def words_of(texts: Sequence[bytes]) -> Words:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    text_ends = np.cumsum(lengths + 1)
    space = SPACE[raw]
    # one blank stays after each word
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    firsts = np.flatnonzero(~space & np.append(True, space[:-1]))
    data = np.where(space, np.uint8(0x20), raw)[keep]
    ends = np.flatnonzero(data == 0x20)
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    return Words(
        data.tobytes(), starts, ends, np.searchsorted(text_ends, firsts, side="right"), word_hashes(data, starts, ends)
    )


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """From the first and the last eight bytes and the length. Others that agree in these collide, so whoever
    needs exact answers compares the words."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[8 : len(data) + 8] = data
    eight = np.ndarray((len(data) + 9,), "<u8", padded.data, strides=(1,))
    size = ends - starts
    short = FIRST[np.minimum(size, 8)]
    head = eight[starts + 8] & short
    tail = eight[ends] >> (np.uint64(8) * np.uint64(8) - np.uint64(8) * np.minimum(size, 7).astype(np.uint64))
    return mixed(head ^ mixed(tail + np.uint64(FACTOR) * size.astype(np.uint64)))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values
