"""Benchmark decontamination within an edit distance, by CGK embedding and LSH.

The CGK random walk (Chakraborty, Goldenberg, Koucky, 2016) reads a word sequence
with a pointer that stays or advances by a random bit of step and word, and writes
out what it reads; sequences at a small edit distance become sequences at a small
Hamming distance. Sampling a few places of the output gives a hash key, and enough
repetitions with walks and samples of their own reach the target recall. Every
item-sized window of every document is compared with the benchmark items so; what
shares a key is verified by the exact edit distance.

Walks over longer sequences drift apart, so items of more than ``LONGEST`` words are
searched as pieces of at most that many. Pieces do not overlap, so an item within its
distance has a piece within its own, and is found where one of its pieces is; the whole
item is verified there. Items of fewer than ``LEAST_WORDS`` words have at most one edit:
they are found where they, or from five words on one of their halves, occur exactly.

An edit destroys two pairs of neighbouring words at most, so a window within distance
d of an n-word piece still has n - 1 - 2d pairs of some piece. Windows with fewer can
match none and are left out before they are embedded; this loses nothing. Items and
their keys go to every task, ``BLOCK_WORDS`` words at a time: a larger benchmark takes
more passes, not more memory. Nothing else is moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import read, with_columns
from rowgate.llm.shingles import mixed, rounds, word_hashes

# Edits, in words, per word of the item.
EDITS = 0.2
# Places of the embedding in one key.
PLACES = 3
RECALL = 0.99
# What repetitions(EDITS, RECALL) measures.
REPETITIONS = 40
# Words of a piece at most.
LONGEST = 24
# Items below this many words occur by chance: they are reported as short, and clean()
# drops a document for them only if they make up SHORT_SHARE of its words.
LEAST_WORDS = 8
SHORT_SHARE = 0.5
# Words of benchmark items compared in one pass over the documents.
BLOCK_WORDS = 1_000_000
SEED = 6
# Windows embedded together by a task.
WINDOWS = 4096

FOUND = "doc_id long, item_id long, edits int, item_words int, first_word long, short boolean"


def allowed(words: int, edits: float = EDITS) -> int:
    return int(edits * words + 1e-9)


def edited(item: list, kinds: tuple[int, ...], count: int, random: np.random.Generator) -> list:
    """``item`` with random edits: 0 replaces a word, 1 deletes one, 2 inserts one."""
    other = list(item)
    for _ in range(count):
        kind, at = kinds[random.integers(len(kinds))], int(random.integers(len(other)))
        new = random.integers(1, 2**63, dtype=np.uint64)
        if kind == 0:
            other[at] = new
        elif kind == 1:
            del other[at]
        else:
            other.insert(at, new)
    return other


def repetitions(edits: float = EDITS, recall: float = RECALL, words: int = LONGEST) -> int:
    """Repetitions that find a piece at the largest allowed distance with ``recall``.

    The chance that one repetition finds it at one of the windows around it is measured
    on random sequences with that many random edits, under a fixed seed, for edits of
    every kind alone and of all kinds; the worst one counts.
    """
    return max(_repetitions(edits, recall, words, kinds) for kinds in ((0,), (1,), (2,), (0, 1, 2)))


def _repetitions(edits: float, recall: float, words: int, kinds: tuple[int, ...]) -> int:
    random = np.random.Generator(np.random.PCG64(SEED))
    trials, tries = 200, 64
    walks = Walks(tries)
    hits = np.zeros((trials, tries), bool)
    slack = allowed(words, edits)
    for trial in range(trials):
        item = random.integers(1, 2**63, words, dtype=np.uint64)
        around = random.integers(1, 2**63, 2 * words, dtype=np.uint64)
        other = edited(list(item), kinds, slack, random)
        text = np.array([*around[:words], *other, *around[words:]], np.uint64)
        rows = np.stack([item, *(text[i : i + words] for i in range(words - slack, words + slack + 1))])
        keys = walks.keys(rows, np.full(len(rows), words))
        hits[trial] = (keys[:, 1:] == keys[:, :1]).any(axis=1)
    share = hits.mean(axis=1)
    return next((n for n in range(1, 10_000) if 1 - np.mean((1 - share) ** n) >= recall), 10_000)


class Walks:
    """``count`` random walks with their sampled places."""

    def __init__(self, count: int):
        random = np.random.Generator(np.random.PCG64(SEED + 1))
        self.count = count
        # Drawn per walk, so a walk is the same however many there are.
        self.seeds = random.integers(1, 2**63, 20_000, dtype=np.uint64)[:count]
        self.parts = np.sort(random.random((20_000, PLACES))[:count], axis=1)

    def keys(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Keys (walk, window) of windows padded with 0; lengths are item lengths.

        An embedding has two places a word: the pointer advances every other step.
        """
        n, width = windows.shape
        padded = np.concatenate([windows, np.zeros((n, 1), np.uint64)], axis=1).ravel()
        origin = np.arange(n) * (width + 1)
        limit = origin + width
        places = (self.parts[:, :, None] * (2 * lengths)).astype(np.int64)
        path = np.empty((int(places.max()) + 1, self.count, n), np.int32)
        at = np.broadcast_to(origin, (self.count, n)).copy()
        for step in range(len(path)):
            path[step] = at
            bits = mixed(self.seeds + np.uint64(step)) | np.uint64(1)
            at += ((padded[at] * bits[:, None]) >> np.uint64(63)).astype(np.int64)
            np.minimum(at, limit, out=at)
        key = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.seeds[:, None]
        for place in range(PLACES):
            seen = padded[np.take_along_axis(path, places[None, :, place], axis=0)[0]]
            key = mixed(key ^ (seen + np.uint64(place)))
        return key


def substring_edits(item: list[int], words: list[int]) -> tuple[int, int]:
    """The least edit distance of ``item`` to any run of ``words``, and where that ends.

    Myers' bit-vector algorithm, one bit per word of the item.
    """
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    plus, minus, score = full, 0, n
    best, end = n, 0
    for at, word in enumerate(words):
        equal = places.get(word, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(across | plus) & full
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, at + 1
    return best, end


def pairs_of(words: np.ndarray) -> np.ndarray:
    """A hash of each word and the next one."""
    return mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])


def pieces_of(words: int) -> list[tuple[int, int]]:
    """(begin, end) of an item's pieces of nearly equal length."""
    count = -(-words // LONGEST)
    if words < LEAST_WORDS:
        count = 1 if allowed(words) == 0 else 2
    bounds = [words * k // count for k in range(count + 1)]
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    out = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(out)])
    return out


@dataclass(frozen=True)
class Items:
    """Benchmark items of one pass with the keys of their pieces' embeddings."""

    ids: np.ndarray
    words: list[np.ndarray]
    # Which item a piece is of, where it begins there.
    owner: np.ndarray
    begin: np.ndarray
    # Lengths of pieces; which of them the pieces with a pair have, a bit per length.
    pairs: np.ndarray
    lengths: np.ndarray
    has_pair: np.ndarray
    keys: np.ndarray
    pieces: np.ndarray
    # Hashes of the exact pieces of short items, by their number of words.
    exact: dict[int, tuple[np.ndarray, np.ndarray]]
    walks: Walks
    edits: float

    @classmethod
    def of(cls, ids: list[int], texts: list[str], walks: Walks, edits: float) -> Items | None:
        hashes, bounds = word_hashes(texts)
        kept = [i for i in range(len(texts)) if bounds[i + 1] > bounds[i]]
        if not kept:
            return None
        words = [hashes[bounds[i] : bounds[i + 1]] for i in kept]
        owner, begin, pieces = [], [], []
        for i, item in enumerate(words):
            for first, end in pieces_of(len(item)):
                owner.append(i)
                begin.append(first)
                pieces.append(item[first:end])
        short = np.array([len(words[i]) < LEAST_WORDS for i in owner])
        lengths = np.array([len(p) for p in pieces])
        keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        sizes = np.unique(lengths[~short])
        for n in sizes:
            same = np.flatnonzero((lengths == n) & ~short)
            for i in range(0, len(same), WINDOWS):
                part = same[i : i + WINDOWS]
                own = walks.keys(np.stack([pieces[j] for j in part]), lengths[part])
                keys.append(own.ravel())
                places.append(np.tile(part, walks.count))
        keys, places = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(keys, kind="stable")
        embedded = [p for p, s in zip(pieces, short, strict=True) if not s]
        pairs = np.unique(np.concatenate([np.zeros(0, np.uint64), *(pairs_of(w) for w in embedded)]))
        has_pair = np.zeros(len(pairs), np.uint64)
        for w in embedded:
            bit = np.uint64(1) << np.uint64(np.searchsorted(sizes, len(w)))
            has_pair[np.searchsorted(pairs, pairs_of(w))] |= bit
        exact = {}
        for n in np.unique(lengths[short]).tolist():
            same = np.flatnonzero((lengths == n) & short)
            found = np.array([runs(pieces[i], n)[0] for i in same])
            by = np.argsort(found, kind="stable")
            exact[n] = found[by], same[by]
        return cls(
            np.array([ids[i] for i in kept]), words, np.array(owner), np.array(begin), pairs, sizes,
            has_pair, keys[order], places[order], exact, walks, edits,
        )

    def windows(self, words: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(piece length, starts) of the windows with enough word pairs of such pieces.

        ``ends`` has the end of each word's document; a window may be cut by it.
        """
        if not len(self.pairs):
            return
        pairs = pairs_of(words)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        hits = np.flatnonzero((self.pairs[at] == pairs) & (ends[:-1] == ends[1:]))
        if not len(hits):
            return
        # A window that is good enough begins at most a few words before a hit, so it
        # is enough to look at starts in reach of one.
        for i, n in enumerate(self.lengths.tolist()):
            own = hits[self.has_pair[at[hits]] >> np.uint64(i) & np.uint64(1) == 1]
            least = n - 1 - 2 * allowed(n, self.edits)
            if len(own) < least:
                continue
            # The window from a start holds the hits in [start, start + n - 2].
            dense = own[least - 1 :] - own[: len(own) - least + 1] <= n - 2
            spans = own[: len(own) - least + 1][dense], own[least - 1 :][dense]
            if not len(spans[0]):
                continue
            marks = np.zeros(len(words) + 1, np.int32)
            np.add.at(marks, np.maximum(spans[1] - (n - 2), 0), 1)
            np.add.at(marks, spans[0] + 1, -1)
            found = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            # Hits of the text before do not count: the start must lie in the hits' text.
            last = np.searchsorted(own, found) + least - 1
            found = found[own[np.minimum(last, len(own) - 1)] < ends[found]]
            if len(found):
                yield n, found

    def candidates(self, words: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
        """(piece, start) of windows that share a key with a piece, or equal a short one."""
        found: set[tuple[int, int]] = set()

        def add(known: np.ndarray, owners: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> None:
            low, high = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
            for k in np.flatnonzero(high > low):
                start = int(starts[k % len(starts)])
                found.update((int(o), start) for o in owners[low[k] : high[k]])

        for n, (known, owners) in self.exact.items():
            keys = runs(words, n)
            inside = np.flatnonzero(ends[: len(keys)] == ends[n - 1 :][: len(keys)])
            add(known, owners, keys[inside], inside)
        all_sizes, all_starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, starts in self.windows(words, ends):
            all_sizes.append(np.full(len(starts), n))
            all_starts.append(starts)
        all_sizes, all_starts = np.concatenate(all_sizes), np.concatenate(all_starts)
        for i in range(0, len(all_starts), WINDOWS):
            starts, sizes = all_starts[i : i + WINDOWS], all_sizes[i : i + WINDOWS]
            places = starts[:, None] + np.arange(sizes.max())
            inside = places < np.minimum(starts + sizes, ends[starts])[:, None]
            rows = np.where(inside, words[np.minimum(places, len(words) - 1)], np.uint64(0))
            add(self.keys, self.pieces, self.walks.keys(rows, sizes).ravel(), starts)
        return found

    def leaks(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, item, edits, item words, first word, text's words) of each item's best place."""
        words, bounds = word_hashes(texts)
        if not len(words):
            return
        sizes = np.diff(bounds)
        ends = np.repeat(bounds[1:], sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)
        regions: dict[tuple[int, int], set[tuple[int, int]]] = {}
        for piece, start in self.candidates(words, ends):
            item = int(self.owner[piece])
            n = len(self.words[item])
            slack, text = allowed(n, self.edits), int(owner[start])
            begin = start - int(self.begin[piece])
            first = max(begin - slack, int(bounds[text]))
            regions.setdefault((text, item), set()).add((first, min(begin + n + slack, int(ends[start]))))
        for (text, item), places in sorted(regions.items()):
            joined: list[list[int]] = []
            for first, end in sorted(places):
                if joined and first <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], end)
                else:
                    joined.append([first, end])
            wanted = self.words[item].tolist()
            edits, length, first = min(
                (*substring_edits(wanted, words[first:end].tolist()), first) for first, end in joined
            )
            if edits <= allowed(len(wanted), self.edits):
                begin = max(first + length - len(wanted), first) - int(bounds[text])
                yield text, item, edits, len(wanted), begin, int(sizes[text])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, repeats: int = REPETITIONS
) -> DataFrame:
    """(doc_id, item_id, edits, item_words, first_word, short): items found in documents.

    One row per document row and item, with the least edit distance. Words are
    lower-cased runs of letters and digits. Null and empty texts hold nothing, items
    with a null text or without words are not looked for, equal items are each found.
    Items of under ``LEAST_WORDS`` words are ``short``. ``repeats`` is what
    ``repetitions`` gives for ``edits``. Texts are searched whole, a few at a time.
    """
    walks = Walks(repeats)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in blocks(benchmark):
        items = Items.of(block["item_id"].tolist(), block["text"].tolist(), walks, edits)
        if items is None:
            continue

        def search(batches: Iterator[pd.DataFrame], items: Items = items) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found, base = [], 0
                for group in rounds(list(batch["text"])):
                    for text, item, edits, size, first, _ in items.leaks(group):
                        row = batch["doc_id"].iloc[base + text], items.ids[item], edits, size, first
                        found.append((*row, size < LEAST_WORDS))
                    base += len(group)
                names = ["doc_id", "item_id", "edits", "item_words", "first_word", "short"]
                yield pd.DataFrame(found, columns=names).astype({"item_id": "Int64"})

        part = rows.mapInPandas(search, FOUND)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], FOUND)
    return out


def clean(
    docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, repeats: int = REPETITIONS
) -> DataFrame:
    """The rows of ``docs`` that hold no item, in the sense of ``contaminated``.

    A short item counts only if it has at least ``SHORT_SHARE`` of the text's words.

    Each row is judged by its own text, so rows without a doc_id, or that share one,
    are kept or dropped one by one, and no text is shuffled.
    """
    walks = Walks(repeats)
    for block in blocks(benchmark):
        items = Items.of(block["item_id"].tolist(), block["text"].tolist(), walks, edits)
        if items is None:
            continue

        docs = docs.filter(~holding(items)(F.col("text")))
    return docs


def holding(items: Items):
    """Column function: whether a text holds one of the items."""

    @F.pandas_udf("boolean")
    def leaks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            held, base = np.zeros(len(batch), bool), 0
            for group in rounds(list(batch)):
                for text, _, _, size, _, words in items.leaks(group):
                    held[base + text] |= size >= LEAST_WORDS or size >= SHORT_SHARE * words
                base += len(group)
            yield pd.Series(held)

    return leaks


def blocks(benchmark: DataFrame) -> Iterator[pd.DataFrame]:
    """The items in runs of at most about ``BLOCK_WORDS`` words, in order of their id."""
    items = benchmark.filter("text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    )
    held, words = [], 0
    for row in items.orderBy("item_id").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        words += row["text"].count(" ") + 1
        if words >= BLOCK_WORDS:
            yield pd.DataFrame(held, columns=["item_id", "text"])
            held, words = [], 0
    if held:
        yield pd.DataFrame(held, columns=["item_id", "text"])


def op6_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document."""
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = contaminated(docs, benchmark)
    return with_columns(found, similarity=F.round(1 - F.col("edits") / F.col("item_words"), 6))


QUERIES = {"op6_cgk_decontamination": op6_cgk_decontamination}
# Edit distance to every window is too slow in SQL on whole tables; tests compare with
# brute force.
SQL: dict[str, str] = {}
