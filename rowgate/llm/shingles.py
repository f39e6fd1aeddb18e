"""Word shingles as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
# Text handled by one round of array work; bounds the memory of a task.
ROUND_BYTES = 2 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 1024, dtype=np.uint64) | np.uint64(1)
_ORDER = _RANDOM.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
# ASCII that is neither letter nor digit separates words; all other bytes are kept.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and the first word of each text plus the end."""
    raws = [b"" if t is None else t.lower().encode("utf-8", "surrogatepass") for t in texts]
    joined = (b" " + b" ".join(raws) + b" ").translate(_TABLE)
    begins = np.cumsum([1, *(len(r) + 1 for r in raws)])
    codes = np.frombuffer(joined, np.uint8)
    inside = codes != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lengths = ends - starts
    places = np.flatnonzero(inside)
    firsts = np.cumsum(lengths) - lengths
    offsets = np.arange(len(places)) - np.repeat(firsts, lengths)
    values = _BYTE[codes[places]] * _PLACE[offsets & 1023]
    hashes = mixed(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(starts, begins)


def shingles(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of every text's shingles, in order and with repeats.

    A text of one to four words has one shingle, of all its words; one without words
    has none. Long texts are handled whole.
    """
    for group in rounds(texts):
        words, bounds = word_hashes(group)
        count = max(len(words) - WORDS + 1, 0)
        rolled = np.zeros(count, np.uint64)
        for j in range(WORDS):
            rolled += words[j : j + count] * _ORDER[j]
        rolled = mixed(rolled)
        for first, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - first >= WORDS:
                yield rolled[first : end - WORDS + 1]
            elif end > first:
                own = words[first:end]
                yield mixed((own * _ORDER[: len(own)]).sum(keepdims=True) + np.uint64(len(own)))
            else:
                yield words[:0]


def rounds(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about ``ROUND_BYTES``; a longer text is a run of its own."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += 0 if text is None else len(text)
        if size >= ROUND_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group
