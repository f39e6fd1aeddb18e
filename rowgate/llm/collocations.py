"""Phrase collocations, counted by vertically partitioned suffix subtrees of words.

All phrase counts come from suffix trees of the corpus' words, of which no task ever
holds more than a part, after the idea of elastic range suffix construction (Mansour,
Allam, Skiadopoulos and Kalnis, 2011):

1. *Prefixes.* Words are counted; a word is the first edge of its suffixes' subtree, and
   its count is that subtree's number of leaves. Slots of word hashes are put together
   to groups of at most ``BUDGET`` leaves. A word with more leaves is extended: its
   suffixes are grouped by their first two words instead.
2. *Subtrees.* Tasks send every suffix, cut off at the depth that is asked for and
   combined with equal ones, to its group; a group sorts its suffixes, which gives its
   subtrees independently of all others, and reads the count of a phrase from the
   total of the leaves below its node.
3. *Elastic depth.* Subtrees are first built two words deep. Only where a node has
   enough leaves can a deeper one have them, so a second pass, from four words down,
   sends just the suffixes that begin with two such nodes; it is partitioned by their
   first two words, extended to three where these have too many leaves.

Words travel as 64-bit hashes of language and word. The table of all words shows whether
two share a hash; then another hash function is drawn, so counts are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowgate.llm.frames import joined, read, text_of, written
from rowgate.llm.shingles import mixed

DEPTH = 4
# Suffixes of a group. More of them when there would be more than MOST_GROUPS groups.
BUDGET = 1_000_000
MOST_GROUPS = 65_536
SLOTS = 1 << 16
# Words whose suffixes a task combines before it sends them.
PACKET_WORDS = 1_000_000
# Text hashed in one round of array work.
ROUND_BYTES = 1 << 20
# Distinct words that a task counts before it hands the counts on.
COUNTED = 150_000
# Bits of the filter of frequent nodes: 16 a node, 16 MB at most. A full filter only
# lets through suffixes that turn out rare.
MOST_BITS = 1 << 27
SEEDS = 5

# What ends a piece of text, and what separates its words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b" \t"
_TABLE = bytes(
    10 if c in PIECE_ENDS else 32 if c in WORD_ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_FIRST, _SECOND, _THIRD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Hashing:
    """One hash function of words."""

    def __init__(self, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.seed = seed
        self.byte = draw.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        self.place = draw.integers(1, 2**63, 1024, dtype=np.uint64) | np.uint64(1)
        self.languages: dict[str, np.uint64] = {}

    def language(self, lang: str) -> np.uint64:
        if lang not in self.languages:
            raw = hashlib.blake2b(lang.encode("utf-8"), digest_size=8, key=str(self.seed).encode()).digest()
            self.languages[lang] = np.uint64(int.from_bytes(raw, "big"))
        return self.languages[lang]


@dataclass
class Words:
    """The words of a stretch of prepared bytes."""

    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    places: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray
    breaks: np.ndarray  # places of piece ends

    @classmethod
    def of(cls, raw: bytes, hashing: Hashing) -> Words:
        """``raw`` begins and ends with a separator."""
        codes = np.frombuffer(raw, np.uint8)
        inside = (codes != 32) & (codes != 10)
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        places = np.flatnonzero(inside)
        firsts = np.cumsum(lengths) - lengths
        offsets = np.arange(len(places)) - np.repeat(firsts, lengths)
        breaks = np.flatnonzero(codes == 10)
        if not len(starts):
            return cls(codes, starts, lengths, places, offsets, np.zeros(0, np.uint64), breaks)
        factors = hashing.place[offsets & 1023]
        if lengths.max() > 1024:
            factors = factors + (offsets >> 10).astype(np.uint64) * _FIRST
        values = hashing.byte[codes[places]] * factors
        hashes = mixed(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))
        return cls(codes, starts, lengths, places, offsets, hashes, breaks)

    def linked(self) -> np.ndarray:
        """Whether a word and the next are in one piece."""
        piece = np.searchsorted(self.breaks, self.starts)
        return np.append(piece[1:] == piece[:-1], False)[: len(piece)]


def _stretches(texts: list[str], langs: list[str]) -> Iterator[tuple[bytes, list[int], list[str], bool]]:
    """(bytes, places where texts begin, their languages, whether it continues a text).

    Short texts share a stretch, a long one is cut between words.
    """
    parts, begins, names, size = [b""], [], [], 1
    for text, lang in zip(texts, langs, strict=True):
        raw = text.encode("utf-8").translate(_TABLE)
        if len(raw) > ROUND_BYTES:
            if begins:
                yield b"\n".join([*parts, b""]), begins, names, False
                parts, begins, names, size = [b""], [], [], 1
            at = 0
            while at < len(raw):
                ends = [e for e in (raw.find(b" ", at + ROUND_BYTES), raw.find(b"\n", at + ROUND_BYTES)) if e >= 0]
                end = min(ends, default=len(raw))
                yield b" " + raw[at:end] + b" ", [0], [lang], at > 0
                at = end
            continue
        begins.append(size)
        names.append(lang)
        parts.append(raw)
        size += len(raw) + 1
        if size > ROUND_BYTES:
            yield b"\n".join([*parts, b""]), begins, names, False
            parts, begins, names, size = [b""], [], [], 1
    if begins:
        yield b"\n".join([*parts, b""]), begins, names, False


def _hashed(batch: pd.DataFrame, hashing: Hashing) -> Iterator[tuple[Words, np.ndarray, list[str], bool]]:
    """Words with the language in their hashes, each word's text, the texts' languages,
    whether the words continue the text before."""
    for raw, begins, langs, continued in _stretches(list(batch["text"]), list(batch["lang"])):
        words = Words.of(raw, hashing)
        text = np.searchsorted(np.array(begins), words.starts, "right") - 1
        keys = np.array([hashing.language(x) for x in langs], np.uint64)
        words.hashes = np.maximum(mixed(words.hashes ^ keys[text]), np.uint64(1))
        yield words, text, langs, continued


def _packets(batches: Iterator[pd.DataFrame], hashing: Hashing) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of whole texts, and whether a word's piece goes on behind it."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, broken = 0, True

    def packed() -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])

    for batch in batches:
        for words, _, _, continued in _hashed(batch, hashing):
            h, linked, breaks = words.hashes, words.linked(), words.breaks
            if not continued:
                if size >= PACKET_WORDS:
                    yield packed()
                    held, size = [], 0
                broken = True
            elif len(h) and not broken and not (len(breaks) and breaks[0] < words.starts[0]):
                held[-1][1][-1] = True
            if len(h):
                broken = bool(len(breaks) and breaks[-1] > words.starts[-1])
                held.append((h, linked))
                size += len(h)
            else:
                broken = broken or len(breaks) > 0
    if held:
        yield packed()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_of().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")).filter("text <> ''")


def counted_words(docs: DataFrame, hashing: Hashing) -> DataFrame:
    """(h, lang, word, n, other): ``other`` is set where two words share a hash; written."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[int, str, bytes], int] = {}

        def framed() -> pd.DataFrame:
            rows = [(h, lang, w.decode("utf-8"), n) for (h, lang, w), n in counts.items()]
            counts.clear()
            return pd.DataFrame(rows, columns=["h", "lang", "word", "n"])

        def add(words: Words, at: int, lang: str, n: int) -> None:
            start = words.starts[at]
            word = words.codes[start : start + words.lengths[at]].tobytes()
            key = int(words.hashes[at].view(np.int64)), lang, word
            counts[key] = counts.get(key, 0) + n

        for batch in batches:
            for words, text, langs, _ in _hashed(batch, hashing):
                if not len(words.hashes):
                    continue
                _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
                # Equal hashes must mean equal bytes and languages.
                like = first[which]
                equal = words.lengths == words.lengths[like]
                named = np.unique(np.array(langs, object).astype(str), return_inverse=True)[1]
                equal &= named[text] == named[text[like]]
                source = np.repeat(words.starts[like], words.lengths) + words.offsets
                same = words.codes[words.places] == words.codes[np.minimum(source, len(words.codes) - 1)]
                firsts = np.cumsum(words.lengths) - words.lengths
                equal &= np.logical_and.reduceat(same, firsts)
                for at, n in zip(first, np.bincount(which[equal], minlength=len(first)), strict=True):
                    add(words, at, langs[text[at]], int(n))
                for at in np.flatnonzero(~equal):
                    add(words, at, langs[text[at]], 1)
                if len(counts) >= COUNTED:
                    yield framed()
        yield framed()

    rows = _texts(docs).mapInPandas(count, "h long, lang string, word string, n long")
    name = F.struct("lang", "word")
    table = rows.groupBy("h").agg(F.sum("n").alias("n"), F.min(name).alias("name"), F.max(name).alias("last"))
    table = table.select("h", "name.lang", "name.word", "n", (F.col("name") != F.col("last")).alias("other"))
    return written(table, "words")


def word_table(docs: DataFrame) -> tuple[DataFrame, Hashing]:
    """(h, lang, word, n) of all words, and a hash function under which no two share one."""
    for seed in range(SEEDS):
        hashing = Hashing(seed)
        table = counted_words(docs, hashing)
        if not table.filter("other").limit(1).count():
            return table.drop("other"), hashing
    raise ValueError("two words share a hash under every hash function tried")


@dataclass
class Partition:
    """Which nodes have enough leaves, and which group a prefix's suffixes go to."""

    bits: np.ndarray
    hot: np.ndarray
    groups: np.ndarray

    def frequent(self, h: np.ndarray) -> np.ndarray:
        h = h & np.uint64(len(self.bits) * 64 - 1)
        return (self.bits[h >> np.uint64(6)] >> (h & np.uint64(63))) & np.uint64(1) == 1

    def extended(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(h), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)] == h


def partitioned(nodes: DataFrame, budget: int) -> Partition:
    """The partition of frequent (h, n).

    The driver gets at most ``MOST_GROUPS`` hashes of nodes over the budget, a sum for
    every slot, and ``MOST_BITS`` bits.
    """
    known = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    many, total = known
    budget = max(budget, -(-total // MOST_GROUPS))
    hot = nodes.filter(F.col("n") > budget).select("h", "n").toPandas()
    slot = F.shiftrightunsigned("h", 48)
    sums = nodes.filter(F.col("n") <= budget).groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).toPandas()
    loads = np.full(SLOTS, float(hot["n"].sum()) / SLOTS)
    loads[sums["slot"].to_numpy(np.int64)] += sums["n"].to_numpy(np.float64)
    size = 1 << 16
    while size < min(16 * many, MOST_BITS):
        size *= 2
    place = F.col("h").bitwiseAND(F.lit(size - 1))
    set_ = nodes.groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("bits")
    ).toPandas()
    bits = np.zeros(size // 64, np.uint64)
    bits[set_["at"].to_numpy(np.int64)] = set_["bits"].to_numpy(np.int64).view(np.uint64)
    groups = ((np.cumsum(loads) - loads) // budget).astype(np.int32)
    return Partition(bits, np.sort(hot["h"].to_numpy(np.int64).view(np.uint64)), groups)


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _FIRST + second * _SECOND)


def triple_key(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mixed(first * _FIRST + second * _SECOND + third * _THIRD)


def combined(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct columns of ``rows`` (words x suffixes) and their summed counts."""
    if not rows.shape[1]:
        return rows, counts
    order = np.lexsort(rows[::-1])
    rows, counts = rows[:, order], counts[order]
    new = np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))
    at = np.flatnonzero(new)
    return rows[:, at], np.add.reduceat(counts, at)


Parts = list[Partition]


def _two_deep(h: np.ndarray, linked: np.ndarray, parts: Parts) -> tuple[np.ndarray, np.ndarray]:
    """Keys of groups and suffixes of two frequent words."""
    words = parts[0]
    usual = words.frequent(h)
    at = np.flatnonzero(linked[:-1] & usual[:-1] & usual[1:])
    first, second = h[at], h[at + 1]
    key = np.where(words.extended(first), pair_key(first, second), first)
    return key, np.stack([first, second])


def _four_deep(h: np.ndarray, linked: np.ndarray, parts: Parts) -> tuple[np.ndarray, np.ndarray]:
    """Keys of groups and suffixes of three words, or four, all of whose pairs are frequent."""
    words, pairs = parts
    usual = words.frequent(h)
    two = np.zeros(len(h) + DEPTH, bool)
    ahead = np.append(h, np.zeros(DEPTH, np.uint64))
    at = np.flatnonzero(linked[:-1] & usual[:-1] & usual[1:])
    two[at] = pairs.frequent(pair_key(h[at], h[at + 1]))
    at = np.flatnonzero(two[:-1] & two[1:])
    first, second, third = ahead[at], ahead[at + 1], ahead[at + 2]
    fourth = np.where(two[at + 2], ahead[at + 3], 0)
    key = pair_key(first, second)
    key = np.where(pairs.extended(key), triple_key(first, second, third), key)
    return key, np.stack([first, second, third, fourth])


def subtrees(docs: DataFrame, hashing: Hashing, parts: Parts, least: int) -> DataFrame:
    """(size, p, a, h): the nodes of ``least`` leaves or more, two words deep for one
    partition, three and four deep for two; ``p`` is the phrase as eight bytes a word."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((hashing, parts))
    deep: Callable = _two_deep if len(parts) == 1 else _four_deep
    width, shown = (2, (2,)) if len(parts) == 1 else (DEPTH, (3, 4))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashing, parts = sent.value
        for h, linked in _packets(batches, hashing):
            key, suffixes = deep(h, linked, parts)
            group = parts[-1].groups[key >> np.uint64(48)].astype(np.uint64)
            rows, counts = combined(np.vstack([group, suffixes]), np.ones(len(key), np.uint64))
            if not len(counts):
                continue
            bounds = [0, *(np.flatnonzero(np.diff(rows[0])) + 1), len(counts)]
            bodies = [
                np.vstack([rows[1:, i:j], counts[i:j]]).tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pd.DataFrame({"group": rows[0, bounds[:-1]].astype(np.int32), "body": bodies})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, bodies, size = None, [], 0

        def compact() -> None:
            nonlocal bodies, size
            rows, counts = combined(*(np.concatenate(x, axis=-1) for x in zip(*bodies, strict=True)))
            bodies, size = [(rows, counts)], 0

        def nodes() -> Iterator[pd.DataFrame]:
            compact()
            rows, counts = bodies[0]
            for deep in shown:
                new = np.append(True, (rows[:deep, 1:] != rows[:deep, :-1]).any(axis=0))
                at = np.flatnonzero(new)
                leaves = np.add.reduceat(counts, at)
                kept = (leaves >= least) & (rows[deep - 1, at] != 0)
                at, leaves = at[kept], leaves[kept]
                raw = np.ascontiguousarray(rows[:deep, at].T).astype(">u8").tobytes()
                phrases = [raw[i : i + 8 * deep] for i in range(0, len(raw), 8 * deep)]
                h = pair_key(rows[0, at], rows[1, at]).view(np.int64)
                yield pd.DataFrame({"size": deep, "p": phrases, "a": leaves.astype(np.int64), "h": h})

        for batch in batches:
            for group, body in zip(batch["group"], batch["body"], strict=True):
                if group != now:
                    if bodies:
                        yield from nodes()
                    now, bodies, size = group, [], 0
                rows = np.frombuffer(body, np.uint64).reshape(width + 1, -1)
                bodies.append((rows[:-1], rows[-1]))
                size += rows.shape[1]
                if size > BUDGET and len(bodies) > 1:
                    compact()
        if bodies:
            yield from nodes()

    packets = _texts(docs).mapInPandas(send, "group int, body binary")
    dealt = packets.repartition("group").sortWithinPartitions("group")
    return dealt.mapInPandas(build, "size int, p binary, a long, h long")


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, budget: int = BUDGET) -> DataFrame:
    """The first ``most`` phrases of two to four words of every language by score.

    Columns: lang, rank, phrase, a, l, r, n, score. Texts are read whole; null texts are
    empty and a null language is ``und``. A phrase lies within a piece of text between
    punctuation or line breaks, counts once at each place, overlaps included, and needs
    ``least`` occurrences a. Where it is cut into a beginning and a rest, of l and r
    occurrences, floor(2,000,000 a / (l + r)) is least, on ties first. Phrases that lie
    in a longer one with four fifths of their occurrences or more are left out. Ties go
    by a, then in byte order.
    """
    words, hashing = word_table(docs)
    usual = words.filter(F.col("n") >= least)
    first = partitioned(usual, budget)
    two = written(subtrees(docs, hashing, [first], least), "two")
    second = partitioned(two.select("h", F.col("a").alias("n")), budget)
    more = written(subtrees(docs, hashing, [first, second], least), "more")
    phrases = two.select("size", "p", "a").unionByName(more.select("size", "p", "a"))

    # Parts of longer phrases, with the occurrences of the most frequent longer one.
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(0, size - n),"
        " i -> substring(p, 8 * i + 1, 8 * n))))"
    )
    parts = more.select(F.explode(inner).alias("p"), "a").groupBy("p").agg(F.max("a").alias("longer"))
    kept = phrases.join(parts, "p", "left").filter("longer is null or 5 * longer < 4 * a")
    kept = written(kept.select("size", "p", "a"), "kept")

    word = F.unhex(F.lpad(F.hex("h"), 16, "0"))
    named = usual.select(word.alias("w"), "lang", "word", "n")
    known = named.select(F.col("w").alias("p"), F.col("n").alias("f"))
    known = written(known.unionByName(phrases.filter("size < 4").select("p", F.col("a").alias("f"))), "known")
    cuts = kept.select("size", "p", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {"head": F.expr("substring(p, 1, 8 * k)"), "tail": F.expr("substring(p, 8 * k + 1, 8 * (size - k))")}
    )
    cuts = cuts.join(known.select(F.col("p").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(known.select(F.col("p").alias("tail"), F.col("f").alias("r")), "tail")
    # Decimals: 2,000,000 a may pass 64 bits.
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + r)")
    best = cuts.withColumn("score", score).groupBy("p").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    places = kept.select("p", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("i"))
    places = places.withColumn("w", F.expr("substring(p, 8 * i + 1, 8)"))
    texts = joined(places, named.select("w", "lang", "word"), "w").groupBy("p").agg(
        F.first("lang").alias("lang"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias(
            "phrase"
        ),
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.join(texts, "p").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return joined(ranked, totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of every language of the documents."""
    return collocations(read(spark, sf_dir, "documents"))


QUERIES = {"op11_collocations": op11_collocations}
SQL = {
    "op11_collocations": r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents WHERE text IS NOT NULL
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), places AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists
), spans AS (
    SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
    FROM places, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE i + k - 1 <= len(words)
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM spans GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words
    FROM counts WHERE k > 1 AND f >= 30
), parts AS (
    SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM candidates), (VALUES (2), (3)) AS sizes(m)
    WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), kept AS (
    SELECT c.* FROM candidates c LEFT JOIN parts p ON c.lang = p.lang AND c.phrase = p.phrase
    WHERE p.longer IS NULL OR 100::HUGEINT * p.longer < 80::HUGEINT * c.a
), cuts AS (
    SELECT lang, phrase, a, c, array_to_string(words[:c], ' ') AS head, array_to_string(words[c + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS c FROM kept)
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, c, h.f AS l, t.f AS r, (2000000::HUGEINT * a) // (h.f + t.f) AS score
    FROM cuts JOIN counts h ON h.lang = cuts.lang AND h.phrase = cuts.head
    JOIN counts t ON t.lang = cuts.lang AND t.phrase = cuts.tail
), best AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM best WHERE place = 1
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
""",
}
