"""Hashes of the words and word sequences of many texts at once, without a Python step per word."""

from __future__ import annotations

import numpy as np

#: Every byte that is no letter, digit or part of a longer character becomes a space; capitals become small.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, np.ndarray] = {}
_BLOCK = 1 << 19  # bytes that are hashed at once


def _powers_of(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.ones(max(n, 1 << 20), np.uint64)
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of h."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, text number of each word). Scratch memory is that of a block, also for long texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text = b" ".join([*texts, b""]).translate(WORD_BYTES)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    low = 0
    while low < len(text):
        high = text.find(b" ", low + _BLOCK)  # blocks end between words
        high = len(text) if high < 0 else high
        data = np.frombuffer(text, np.uint8, high - low, low)
        inside = data != 32
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        # prefix sums of a polynomial; multiplying by the inverse power makes a word's hash independent of where it stands
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers_of(_BASE, len(data)), out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * _powers_of(_INVERSE, len(data) + 1)[starts]))
        places.append(starts + low)
        low = high
    return np.concatenate(hashes), np.searchsorted(np.cumsum(sizes), np.concatenate(places), "right")


def sequence_hashes(words: np.ndarray, owner: np.ndarray, length: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each run of `length` words; with `whole`, a text of fewer words is one run."""
    n = len(words) - length + 1
    found, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        total = np.zeros(n, np.uint64)
        for at in range(length):
            total = total * _BASE + words[at : at + n]
        fits = owner[:n] == owner[length - 1 :]
        found, owners = mix(total[fits]), owner[:n][fits]
    if whole and len(words):
        texts, first, count = np.unique(owner, return_index=True, return_counts=True)
        for text, at, many in zip(texts[count < length], first[count < length], count[count < length], strict=True):
            total = np.full(1, many, np.uint64)
            for word in words[at : at + many]:
                total = total * _BASE + word
            found, owners = np.append(found, mix(total)), np.append(owners, text)
    return found, owners
