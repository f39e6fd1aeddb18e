"""Spelling variants: words one edit apart, found by an index of variable-length grams.

1. *Words* are counted in the tasks and combined before they are shuffled.
2. *Gram dictionary.* A gram of at least ``SHORTEST`` characters that more than
   1 / ``FREQUENT`` of all places hold is frequent. Grams grow while they are frequent,
   so the dictionary is a tree pruned by frequency: every leaf is rare, or as long as
   grams get. Only frequent grams are kept, at most ``FREQUENT`` of a length, whatever
   the number of words.
3. *Decomposition.* At every place of a word the gram grows from ``SHORTEST`` until it is
   rare; a gram that lies inside an earlier one is left out.
4. *Affected grams.* One edit changes only grams near it. Where a gram ends, and which
   earlier gram could come to cover it, tells at which edits it may change.
5. *List merging.* All others are shared. So for each edit of a word, the first gram, in
   one global order, rarest first, that the edit leaves alone bounds how far the first
   shared gram can be; only the lists up to these bounds are merged. A list holds the
   words with a gram at the same place: counted from the left or, behind an insertion or
   a deletion, from the right.
6. *Verification* compares the words of a list in their task and puts out only words
   that are near; long lists are dealt out as pairs of parts.

Two near words have at least ``least_length`` characters, and grams are at most as long
as leaves two apart in the shorter word, so the bound always leaves a shared gram and no
pair is missed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import joined, read, written

SHORTEST, LONGEST = 2, 6
FREQUENT = 20_000
# Words that a task counts before it hands the counts on.
COUNTED = 300_000
# Words of a list that one task compares with each other.
BLOCK = 4096
# Rows of lists that a task compares at a time, and pairs in one array operation.
ROWS, PAIRS = 60_000, 500_000
# Rows of an Arrow batch: rows are single words here.
WORD_ROWS = 10_000

# Runs of letters in UTF-8: A to Z, a to z, U+00C0 to U+00FF.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SAME, LEFT, RIGHT = 0, 1, 2


@contextmanager
def _batches(spark: SparkSession, rows: int) -> Iterator[None]:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def word_counts(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, slips: int | None = None
) -> DataFrame:
    """(word, n) of the words of whole texts, only A to Z lower-cased; null has none.

    With ``slips`` a run loses a character where the CRC-32 of its document's id and of
    the run is a multiple of it: a reproducible typist. A null doc_id counts as empty.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[bytes, int] = {}

        def framed() -> pd.DataFrame:
            words = [(w.decode("utf-8"), n) for w, n in counts.items()]
            kept = [(w, n) for w, n in words if len(w) >= least_length]
            counts.clear()
            return pd.DataFrame(kept, columns=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                known = crc32(f"{doc_id or ''}:".encode())
                for run in RUN.findall(text.encode("utf-8").translate(LOWER)):
                    # A run of fewer bytes has fewer characters too.
                    if len(run) < least_length:
                        continue
                    if slips:
                        code = crc32(run, known)
                        if code % slips == 0:
                            word = run.decode("utf-8")
                            at = code % len(word)
                            run = (word[:at] + word[at + 1 :]).encode("utf-8")
                    counts[run] = counts.get(run, 0) + 1
                if len(counts) >= COUNTED:
                    yield framed()
        yield framed()

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").filter("text is not null")
    found = texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= least_count)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The grams that more than 1 / ``FREQUENT`` of the places of (word) hold, counted."""
    places = words.agg(F.sum(F.length("word"))).first()[0]
    if not places:
        return {}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()

        def framed() -> pd.DataFrame:
            rows = list(counts.items())
            counts.clear()
            return pd.DataFrame(rows, columns=["gram", "n"])

        for batch in batches:
            for word in batch["word"]:
                for size in range(SHORTEST, LONGEST):
                    counts.update([word[i : i + size] for i in range(len(word) - size + 1)])
                if len(counts) >= COUNTED:
                    yield framed()
        yield framed()

    found = words.select("word").mapInPandas(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = found.filter(F.col("n") > places / FREQUENT).toPandas()
    return dict(zip(rows["gram"], rows["n"].tolist(), strict=True))


def longest_gram(shorter: int) -> int:
    """Length to which grams grow where the shorter word of a pair has this length."""
    return max(SHORTEST, min(LONGEST, (shorter - 1) // 2))


def decomposed(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int, bool]]:
    """(begin, end, open) of a word's grams; an open one would grow if the word went on."""
    grams, reach, size = [], 0, len(word)
    for begin in range(size - SHORTEST + 1):
        end = begin + SHORTEST
        while end - begin < longest and end < size and word[begin:end] in frequent:
            end += 1
        if end > reach:
            grams.append((begin, end, end - begin < longest and word[begin:end] in frequent))
            reach = end
    return grams


def merged_lists(word: str, least_length: int, frequent: dict[str, int]) -> list[tuple[int, int, str]]:
    """(kind, length of the shorter word, list) of the lists that a word is merged in.

    Replacing or deleting the character at i, a gram that ends before it stays, as does
    one that begins behind it and ends at least ``longest`` behind it: an earlier gram
    cannot come to cover that. Inserting before place i is the same but one place
    further, and an open gram grows at the end. The first gram that two near words share
    is in a list of both: neither word's bound for their edit can be before it.
    """
    size, lists = len(word), []
    for shorter in (size - 1, size):
        if shorter < least_length:
            continue
        longest = longest_gram(shorter)
        grams = [
            (frequent.get(word[begin:end], 0), begin - end, word[begin:end], begin, end, grows)
            for begin, end, grows in decomposed(word, longest, frequent)
        ]
        grams.sort()
        same: set[int] = set()
        left: set[int] = set()
        right: set[int] = set()
        for i in range(size):
            for k, (_, _, _, begin, end, _) in enumerate(grams):
                if begin <= i < end:
                    continue
                if shorter == size:
                    same.add(k)
                else:
                    (left if end <= i else right).add(k)
                if end <= i or end > i + longest:
                    break
        if shorter == size:
            for i in range(size + 1):
                for k, (_, _, _, begin, end, grows) in enumerate(grams):
                    if begin < i < end:
                        continue
                    (left if end <= i else right).add(k)
                    if end < i or end == i and not grows or end > i + longest - 1:
                        break
        for kind, chosen in ((SAME, same), (LEFT, left), (RIGHT, right)):
            for k in chosen:
                _, _, gram, begin, end, _ = grams[k]
                lists.append((kind, shorter, f"{size - end if kind == RIGHT else begin} {gram}"))
    return lists


def near_same(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j of 64-bit words of characters differ in exactly one byte."""
    differ = np.zeros(len(i), np.uint8)
    low, high = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
    for column in words.T:
        x = column[i] ^ column[j]
        differ += np.minimum(np.bitwise_count((((x & low) + low) | x) & high), 2)
        np.minimum(differ, 2, out=differ)
    return differ == 1


def near_longer(letters: np.ndarray, i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """Whether row j, of one letter more than the ``size`` of row i, is i and one letter."""
    near = np.zeros(len(i), bool)
    short, long = letters[i, :size], letters[j, : size + 1]
    # Begin equal up to a place and end equal from it on.
    ahead = np.cumprod(short == long[:, :size], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    behind = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    near[:] = ahead + behind >= size
    return near


def near_of_lists(rows: pd.DataFrame) -> pd.DataFrame:
    """The near pairs inside the lists of rows that are sorted by kind, size and block."""
    found = [np.zeros((2, 0), np.int64)]
    kinds, sizes = rows["kind"].to_numpy(), rows["size"].to_numpy()
    bounds = np.flatnonzero((kinds[1:] != kinds[:-1]) | (sizes[1:] != sizes[:-1])) + 1
    for begin, end in zip([0, *bounds], [*bounds, len(rows)], strict=True):
        kind, size = int(kinds[begin]), int(sizes[begin])
        words = rows["word"].iloc[begin:end].to_numpy(object)
        block, side = rows["block"].iloc[begin:end].to_numpy(), rows["side"].iloc[begin:end].to_numpy()
        wide = -(-(size if kind == SAME else size + 1) // 8) * 8
        # Every letter is below U+0100, so a word is a row of bytes.
        raw = b"".join([w.ljust(wide, b"\0") for w in words])
        letters = np.frombuffer(raw, np.uint8).reshape(len(words), wide)
        packed = np.ascontiguousarray(letters).view(np.uint64)
        longer = letters[:, size] > 0 if kind != SAME else None
        at, step = np.arange(len(words) - 1), 1
        while len(at):
            at = at[at + step < len(words)]
            at = at[block[at] == block[at + step]]
            for k in range(0, len(at), PAIRS):
                i = at[k : k + PAIRS]
                j = i + step
                # A block of two parts compares only words of different parts.
                other = (side[i] < 0) | (side[i] != side[j])
                if kind == SAME:
                    i, j = i[other], j[other]
                    near = near_same(packed, i, j)
                else:
                    other &= longer[i] != longer[j]
                    i, j = i[other], j[other]
                    i, j = np.where(longer[i], j, i), np.where(longer[i], i, j)
                    near = near_longer(letters, i, j, size)
                if near.any():
                    found.append(np.stack([i[near], j[near]]) + begin)
            step += 1
    i, j = np.concatenate(found, axis=1)
    words, n = rows["word"].to_numpy(object), rows["n"].to_numpy(np.int64)
    once = {(a, b): (p, q) for a, b, p, q in zip(words[i], words[j], n[i].tolist(), n[j].tolist(), strict=True)}
    rows = [(a.decode("latin-1"), b.decode("latin-1"), p, q) for (a, b), (p, q) in once.items()]
    return pd.DataFrame(rows, columns=["a", "b", "n_a", "n_b"])


def in_slices(pairs: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for i in range(0, len(pairs), ROWS):
        yield pairs.iloc[i : i + ROWS]


def near_words(words: DataFrame, least_length: int = 7) -> DataFrame:
    """(word, near, n, near_n) of all pairs of (word, n) that are one edit apart, both ways.

    Words hold letters below U+0100 only, have at least ``least_length`` (5 or more)
    characters, and are distinct. Written to the shared folder.
    """
    if least_length < 2 * SHORTEST + 1:
        raise ValueError("shorter words may share no gram")
    spark = words.sparkSession
    frequent = frequent_grams(words)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*key, raw, n)
                for word, raw, n in zip(
                    batch["word"], map(lambda w: w.encode("latin-1"), batch["word"]), batch["n"], strict=True
                )
                for key in merged_lists(word, least_length, frequent)
            ]
            yield pd.DataFrame(rows, columns=["kind", "size", "list", "word", "n"])

    order = ["kind", "size", "block"]

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        held = 0
        for batch in batches:
            rest.append(batch)
            held += len(batch)
            if held >= ROWS:
                rows = pd.concat(rest, ignore_index=True)
                # The last list may go on in the next batch.
                last = np.logical_and.reduce([rows[c].to_numpy() == rows[c].iloc[-1] for c in order])
                cut = int(last.argmax())
                if cut:
                    yield from in_slices(near_of_lists(rows.iloc[:cut]))
                rest = [rows.iloc[cut:]]
                held = len(rows) - cut
        if rest:
            yield from in_slices(near_of_lists(pd.concat(rest, ignore_index=True)))

    with _batches(spark, WORD_ROWS):
        rows = words.mapInPandas(spread, "kind byte, size int, list string, word binary, n long")
        # Lists that share a hash are merged together, which only adds comparisons.
        lists = written(rows.withColumn("list", F.xxhash64("list")), "lists")
        keys = ["kind", "size", "list"]
        long = lists.groupBy(*keys).count().filter(F.col("count") > BLOCK)
        long = written(long.withColumn("parts", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count"), "long")
        dealt = joined(lists, long, keys, "left")
        own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        others = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = dealt.select(*keys, "word", "n", own.alias("own"), F.explode(others).alias("other"))
        name = F.when(F.col("other") < 0, F.col("list")).otherwise(
            F.xxhash64("list", F.least("own", "other"), F.greatest("own", "other"))
        )
        # In a block of one part all are compared, in one of two only across them.
        side = F.when((F.col("other") < 0) | (F.col("own") == F.col("other")), F.lit(-1)).otherwise(F.col("own"))
        blocks = dealt.select("kind", "size", name.alias("block"), side.alias("side"), "word", "n")
        blocks = blocks.repartition(*order).sortWithinPartitions(*order)
        found = blocks.mapInPandas(compared, "a string, b string, n_a long, n_b long")
        one = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                           F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
                           F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"))
        pairs = written(one.distinct(), "near")
    there = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_a").alias("n"), F.col("n_b").alias("near_n"))
    back = pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_b").alias("n"), F.col("n_a").alias("near_n"))
    return there.unionByName(back)


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), following forms to the last.

    Each round joins every path with the path that its end begins, so a path doubles; a
    form has several times the occurrences of its word, so paths are short and no circle
    is possible.
    """
    paths = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = written(paths.join(ahead, "root", "left").select("word", "root", "far"), "roots")
        paths = step.select("word", F.coalesce("far", "root").alias("root"))
        if not step.filter("far is not null").limit(1).count():
            return paths


def grouped_variants(words: DataFrame, least_length: int = 7, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every (word, n).

    ``form`` is the near word of largest n, on ties the smallest, if it has at least
    ``ratio`` times the word's n; else null. ``root`` is the last form of the chain, the
    word itself if it has none.
    """
    words = written(words.select("word", "n"), "words")
    near = near_words(words, least_length)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.first("n").alias("own_n"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    chosen = -F.col("best.less") >= ratio * F.col("own_n")
    best = best.select(
        "word",
        "n_near",
        F.when(chosen, F.col("best.near")).alias("form"),
        F.when(chosen, -F.col("best.less")).alias("form_n"),
    )
    best = written(best, "best")
    roots = roots_of(best.filter("form is not null"))
    out = words.join(best, "word", "left").join(roots, "word", "left")
    return out.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form and root of every word of the documents with reproducible slips."""
    return grouped_variants(word_counts(read(spark, sf_dir, "documents"), slips=31))


QUERIES = {"op13_spelling_variants": op13_spelling_variants}
# SQL engines have no CRC-32 and no edit distance index; tests use brute force.
SQL: dict[str, str] = {}
