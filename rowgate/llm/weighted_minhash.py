"""Near-duplicates by improved consistent weighted sampling (Ioffe, 2010).

A document is a weighted set: its five-word shingles, weighted by TF-IDF. Two
documents are linked when their weighted Jaccard similarity is 0.8 or more; classes
are the connected components of the links.

1. Exact copies are collapsed to their smallest doc_id by digest, so from here on each
   distinct text counts once, also for IDF.
2. IDF covers every shingle. Runs of texts (packets) send each of their shingles once,
   with the number of their texts that hold it, to the bucket of its hash; a bucket adds
   these up and answers every packet which of its shingles other texts hold too, and how
   many do. What no answer names is held by one text. What near copies hold in common is
   not common for that: texts connected by equal bands of plain MinHash sketches are a
   group, and a group counts once for each shingle it holds. Only a group that makes up a
   large part of all texts counts for more (``together``).
3. Consistent weighted samples make a signature, bands of samples make buckets.
4. In a bucket the signatures give a maximum spanning forest and nearest partners:
   links in number linear in the bucket, never all its pairs. A bucket of more than
   ``BLOCK`` documents is dealt out as pairs of parts; the forests of all pairs of
   parts contain the forest of the whole.
5. These links are verified on the documents' weighted shingle sets.
6. A forest over estimates can miss true links where many texts resemble each other at
   about ``SIMILARITY``. So where verified links leave texts apart that candidate links
   connect, all their sets go to one task once: it verifies every pair that agrees
   enough and is not connected yet, and puts out only links that connect. Of more than
   ``TOGETHER`` connected texts it is their buckets that go to a task each. Rows stay
   linear in the number of texts either way, and no pair is left out.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowgate.llm.components import components
from rowgate.llm.frames import drop_written, joined, read, text_of, written
from rowgate.llm.shingles import mixed, shingles

SIMILARITY = 0.8
BANDS, ROWS = 20, 5
SAMPLES = BANDS * ROWS
# Added to the number of documents per document with a shingle: IDF flattens for what most
# documents hold, so that a group of copies keeps some weight in what its members share.
SMOOTH = 2.0
# Shingles of a packet of texts, all of them candidates for being shared, at one in
# CHARACTERS. A longer text is a packet of its own.
MOST_CANDIDATES = 1 << 19
CHARACTERS = 6
# Shingles of all packets that a bucket counts, and bits of a hash that name one.
BUCKET = 1 << 21
LEAST_BITS = 8
# Documents of a bucket that one task compares: BLOCK ** 2 signature comparisons.
BLOCK = 8192
# Part of the samples that must agree for a link to be verified: about 4 standard
# deviations below SIMILARITY.
LEAST_AGREEMENT = 0.62
# Bands of the sketches that tell which texts count once, and samples of a band: two texts
# share one of them with probability 0.998 at a Jaccard similarity of 0.8, 0.54 at 0.5, 0.02
# at 0.2. Copies that are too far apart to be linked count once too, so these are loose.
COPY_BANDS, COPY_ROWS = 12, 4
# Texts of a group whose shingles one task counts; of more texts it is parts.
WHOLE = 512
# Shingles whose counts such a task collects before it sends them on.
COLLECTED = 1 << 20
# Texts connected by candidates whose sets go to one task.
TOGETHER = 2048
# Rows of agreements that such a task holds at a time.
AT_ONCE = 256
# Open partners of a text up to which its pairs are verified one by one.
FEW = 4
# Shingles whose samples are drawn in one round of array work.
DRAWN = 1 << 16

# What sums in another order may differ by.
ROUNDING = 1e-9

POOL = 1 << 16
PACKETS = "packet long, node long, doc_id long, digest string, text string"
QUESTIONS = "packet long, bucket int, keys binary, several binary"
ANSWERS = "packet long, bucket int, keys binary, held_by binary"
COPIES = "bucket int, root long, once double, keys binary, less binary"
# Buckets below 0 carry sketches instead of questions, dealt over so many.
SKETCH_BUCKETS = 1 << 16
SIGNED = (
    "node long, doc_id long, digest string, bands array<long>, samples binary, "
    "keys binary, odd binary, vals binary"
)


def _pool() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1), the logarithm of another, and uniform numbers, in the order of what
    they give a weight of 1."""
    u = np.random.Generator(np.random.PCG64(10)).random((5, POOL)) * (1 - 2e-16) + 1e-16
    r, log_c, beta = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]
    order = np.argsort(log_c - r * (1 - beta), kind="stable")
    return r[order], log_c[order], beta[order]


R, LOG_C, BETA = _pool()
MULTIPLIERS = np.random.Generator(np.random.PCG64(11)).integers(
    1, 2**63, SAMPLES, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)
INVERSES = np.array([pow(int(x), -1, 1 << 64) for x in MULTIPLIERS], np.uint64)
SKETCHERS = np.random.Generator(np.random.PCG64(13)).integers(
    1, 2**63, COPY_BANDS * COPY_ROWS, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)
# Range of ln(a) over all pool entries and weights from 1e-6 to 1e12.
LOW, HIGH = -60.0, 40.0


def draw(logs: np.ndarray | float, at: np.ndarray | slice) -> np.ndarray:
    """Sortable 64-bit numbers of ICWS, of logarithms of weights: 24 bits of ln(a), 32
    empty, 8 of t."""
    r = R[at]
    t = np.floor(logs / r + BETA[at])
    a = LOG_C[at] - r * (t - BETA[at] + 1)
    rank = np.clip((a - LOW) / (HIGH - LOW), 0, 1) * (2**24 - 1)
    low = (t.astype(np.int64) & 0xFF).astype(np.uint64)
    return (rank.astype(np.uint64) << np.uint64(40)) | low


UNIT = draw(0.0, slice(None))
NONE = np.uint64(2**64 - 1)
HIGH_BITS, LOW_BITS = np.uint64((2**24 - 1) << 40), np.uint64(2**48 - 1)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row per set without an empty one: a sample (shingle, t) per hash function, 40 bits.

    A sample's random numbers come from a pool entry that shingle and hash function
    choose. The pool is in the order of what weight 1, by far the most frequent, gives:
    of these shingles the one with the least product wins, and a lower weight whose entry
    comes behind it cannot win either.
    """
    keys = np.concatenate([k for k, _ in sets])
    weights = np.concatenate([v for _, v in sets])
    starts = np.cumsum([0, *(len(k) for k, _ in sets[:-1])])
    other = np.flatnonzero(weights != 1.0)
    logs = np.log(weights[other])
    heavy = logs > 0
    owners = np.searchsorted(starts, other, "right") - 1
    out = np.empty((len(sets), SAMPLES), np.uint64)
    for i, (factor, inverse) in enumerate(zip(MULTIPLIERS, INVERSES, strict=True)):
        products = keys * factor
        rest = products[other]
        products[other] = NONE
        least = np.minimum.reduceat(products, starts)
        out[:, i] = (least * inverse) >> np.uint64(32) << np.uint64(8)
        near = np.flatnonzero(heavy | (rest >> np.uint64(48) <= least[owners] >> np.uint64(48)))
        if not len(near):
            continue
        own, rest = owners[near], rest[near]
        drawn = draw(logs[near], rest >> np.uint64(48))
        ranks = in_order(drawn, rest)
        runs = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        best = np.minimum.reduceat(ranks, runs)
        before = in_order(UNIT[least >> np.uint64(48)], least)[own[runs]]
        won = np.flatnonzero((best < before) | (least[own[runs]] == NONE))
        lengths = np.diff(np.append(runs, len(own)))
        hits = np.flatnonzero(ranks == np.repeat(best, lengths))
        at = hits[np.searchsorted(hits, runs[won])]
        names = (rest[at] * inverse) >> np.uint64(32) << np.uint64(8)
        out[own[runs[won]], i] = names | (drawn[at] & np.uint64(0xFF))
    return out


def in_order(drawn: np.ndarray, products: np.ndarray) -> np.ndarray:
    """What is drawn, equal values in the order of the products."""
    return (drawn & HIGH_BITS) | (products & LOW_BITS) >> np.uint64(8)


def signature(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return signatures([(keys, weights)])[0]


def idf_of(share: np.ndarray) -> np.ndarray:
    """The logarithm of documents per document with the shingle, smoothed; of any share."""
    return np.log2(SMOOTH + 1 / share)


class Weights:
    """TF-IDF of a text's shingles, given the shares of those that several of ``total``
    texts hold. In units of the IDF of all others, which one text holds: theirs is 1."""

    def __init__(self, keys: np.ndarray, shares: np.ndarray, total: int | None = None):
        order = np.argsort(keys)
        self.keys, self.idf = keys[order], idf_of(shares[order])
        self.unit = float(idf_of(np.float64(1 / total))) if total else 1.0

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.weighed(hashes)[:2]

    def weighed(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The shingles, their weights, and which of them several texts hold."""
        keys, counts = np.unique(hashes, return_counts=True)
        weights = counts.astype(np.float64)
        found = np.zeros(len(keys), bool)
        if len(self.keys) and len(keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = self.keys[at] == keys
            weights[found] *= self.idf[at[found]] / self.unit
        return keys, weights, found


def condensed(keys: np.ndarray, weights: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set with one of the shingles that no other text holds in place of them all, with
    the weight of all: its total and what it shares with any other set stay the same."""
    alone = np.flatnonzero(~found)
    if len(alone) < 2:
        return keys, weights
    weights, kept = weights.copy(), found.copy()
    weights[alone[0]], kept[alone[0]] = weights[alone].sum(), True
    return keys[kept], weights[kept]


def squeezed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte, without bytes that are 0 in all."""
    steps = np.diff(numbers, prepend=np.uint64(0))
    width = max((int(steps.max()).bit_length() + 7) // 8, 1)
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes() + bytes([width])


def widened(data: bytes) -> np.ndarray:
    width = data[-1]
    columns = np.frombuffer(data, np.uint8, len(data) - 1).reshape(width, -1)
    steps = np.zeros((columns.shape[1], 8), np.uint8)
    steps[:, :width] = columns.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(packet, node, doc_id, digest, text) of the distinct texts of (doc_id, text), with the
    smallest doc_id of each; written, so packets and nodes keep their numbers."""
    most = MOST_CANDIDATES * CHARACTERS

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packet, size = uuid.uuid4().int >> 65, 0
        for batch in batches:
            packets = []
            for text in batch["text"]:
                if size and size + len(text) > most:
                    packet, size = uuid.uuid4().int >> 65, 0
                packets.append(packet)
                size += len(text) + 1
            yield batch.assign(packet=packets)

    named = docs.select("doc_id", F.md5(text_of()).alias("digest"), text_of().alias("text"))
    texts = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    texts = texts.withColumn("node", F.monotonically_increasing_id())
    columns = [x.split()[0] for x in PACKETS.split(", ")]
    return written(texts.select(*columns[1:]).mapInPandas(deal, PACKETS).select(*columns), "packets")


def asked(packets: DataFrame, bits: int) -> DataFrame:
    """(packet, bucket, keys, several): the shingles of a packet's texts, by their first
    ``bits`` bits; of those that several of these texts hold, where they are and how many.
    With them, in buckets below 0, the nodes of the texts with words and their sketches."""
    shift = np.uint64(64 - bits)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A packet that two batches or tasks read asks twice.
        for batch in batches:
            for packet, texts in batch.groupby("packet", sort=False):
                sets = [np.unique(h) for h in shingles(list(texts["text"]))]
                worded = [len(s) > 0 for s in sets]
                if any(worded):
                    sets = [s for s in sets if len(s)]
                    held = np.concatenate(sets)
                    yield questions(packet, *np.unique(held, return_counts=True))
                    nodes = texts["node"].to_numpy(np.int64)[worded]
                    place = -1 - int(nodes[0]) % SKETCH_BUCKETS
                    row = (packet, place, nodes.tobytes(), sketches(sets).tobytes())
                    yield pd.DataFrame([row], columns=["packet", "bucket", "keys", "several"])

    def questions(packet: int, keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        buckets = keys >> shift
        bounds = [0, *(np.flatnonzero(np.diff(buckets)) + 1), len(keys)]
        rows = []
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            several = np.flatnonzero(counts[i:j] > 1)
            more = np.stack([several, counts[i:j][several]]).astype(np.uint32)
            rest = keys[i:j] - (buckets[i] << shift)
            rows.append((packet, int(buckets[i]), squeezed(rest), more.tobytes()))
        return pd.DataFrame(rows, columns=["packet", "bucket", "keys", "several"])

    return packets.select("packet", "node", "text").mapInPandas(ask, QUESTIONS)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The keys of the bands of plain MinHash of every set, none of them empty."""
    out = np.empty((len(sets), len(SKETCHERS)), np.uint64)
    bounds = np.cumsum([0, *map(len, sets)])
    begin = 0
    while begin < len(sets):
        end = max(int(np.searchsorted(bounds, bounds[begin] + DRAWN, "right")) - 1, begin + 1)
        keys, starts = np.concatenate(sets[begin:end]), bounds[begin:end] - bounds[begin]
        for i, factor in enumerate(SKETCHERS):
            out[begin:end, i] = np.minimum.reduceat(keys * factor, starts)
        begin = end
    bands = (out * SKETCHERS[::-1]).reshape(-1, COPY_BANDS, COPY_ROWS).sum(axis=2)
    places = np.arange(COPY_BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(bands + places).view(np.int64)


def answered(questions: DataFrame, bits: int) -> DataFrame:
    """(packet, bucket, keys, held_by) of the questions' shingles that several texts hold,
    with the number of all texts that hold them, and the sketches as they came; written."""
    shift = np.uint64(64 - bits)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            bounds = [0, *(np.flatnonzero(np.diff(rest["bucket"].to_numpy())) + 1)]
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                yield told(rest.iloc[i:j])
            rest = rest.iloc[bounds[-1] :]
        if rest is not None and len(rest):
            yield told(rest)

    def told(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        if bucket < 0:
            return rows.rename(columns={"several": "held_by"})
        parts = [widened(x) for x in rows["keys"]]
        bounds = np.cumsum([0, *map(len, parts)])
        keys, counts = np.concatenate(parts), np.ones(bounds[-1], np.int64)
        for i, more in zip(bounds, rows["several"]):
            places, held = np.frombuffer(more, np.uint32).reshape(2, -1)
            counts[i + places] = held
        # Each part is in order already, which makes merging them cheap.
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        held_by = np.add.reduceat(counts[order], starts)
        counts[order] = np.repeat(held_by, np.diff(np.append(starts, len(keys))))
        first = np.uint64(bucket) << shift
        out = []
        for packet, i, j in zip(rows["packet"], bounds[:-1], bounds[1:], strict=True):
            shared = np.flatnonzero(counts[i:j] > 1) + i
            if len(shared):
                held = counts[shared].astype(np.float32)
                out.append((packet, bucket, squeezed(keys[shared] + first), held.tobytes()))
        return pd.DataFrame(out, columns=["packet", "bucket", "keys", "held_by"])

    dealt = questions.repartition("bucket").sortWithinPartitions("bucket")
    return written(dealt.mapInPandas(answer, ANSWERS), "answers")


def copy_groups(answers: DataFrame) -> DataFrame | None:
    """(node, root, n) of the texts that are connected by equal bands of their sketches, in
    groups of n texts; written. None if there are no such texts."""

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for nodes, bands in zip(batch["keys"], batch["held_by"], strict=True):
                named = np.repeat(np.frombuffer(nodes, np.int64), COPY_BANDS)
                yield pd.DataFrame({"node": named, "key": np.frombuffer(bands, np.int64)})

    rows = answers.filter("bucket < 0").select("keys", "held_by")
    rows = written(rows.mapInPandas(told, "node long, key long"), "sketches")
    several = rows.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1")
    links = rows.withColumnRenamed("node", "b").join(several.drop("n"), "key").filter("a <> b")
    links = written(links.select("a", "b").distinct(), "copies")
    drop_written(rows)
    if links.isEmpty():
        return None
    roots = written(components(links), "roots")
    return written(roots.join(roots.groupBy("root").agg(F.count("*").alias("n")), "root"), "copy_groups")


def together(n: np.ndarray | int, total: int) -> np.ndarray | float:
    """How much each further text of a group of n counts: the part of all pairs of texts
    that are pairs of the group. Nothing in copies, all in what the whole table is made of."""
    return (n / total) ** 2


def counted_once(packets: DataFrame, groups: DataFrame, total: int, bits: int) -> DataFrame:
    """(bucket, root, once, keys, less): what to take off the numbers of texts that hold
    shingles, so that each group counts once. Where a row names its group, a part of one,
    it says what all of them take off, and ``once`` is what is then to be added again."""
    shift = np.uint64(64 - bits)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, collected, size, at = [], [], 0, None
        for batch in batches:
            bounds = np.flatnonzero((batch[["root", "part"]] != batch[["root", "part"]].shift()).any(axis=1))
            for i, j in zip(bounds, [*bounds[1:], len(batch)], strict=True):
                here = tuple(batch[["root", "part", "n"]].iloc[i].tolist())
                if at is not None and here[:2] != at[:2]:
                    if at[2] > WHOLE:
                        yield from sent(at[0], 1 - together(at[2], total), [of(held, at[2])])
                    else:
                        collected.append(of(held, at[2]))
                        size += len(collected[-1][0])
                    held = []
                at = here
                held += [np.unique(h) for h in shingles(list(batch["text"].iloc[i:j]))]
            if size > COLLECTED:
                yield from sent(-1, 0.0, collected)
                collected, size = [], 0
        if at is not None and at[2] > WHOLE:
            yield from sent(at[0], 1 - together(at[2], total), [of(held, at[2])])
        elif at is not None:
            collected.append(of(held, at[2]))
        if collected:
            yield from sent(-1, 0.0, collected)

    def of(held: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        if n <= WHOLE:
            keys, counts = keys[counts > 1], counts[counts > 1] - 1
        return keys, counts * (1 - together(n, total))

    def sent(root: int, once: float, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pd.DataFrame]:
        keys, less = summed(found)
        if len(keys):
            buckets = keys >> shift
            bounds = [0, *(np.flatnonzero(np.diff(buckets)) + 1), len(keys)]
            rows = [
                (int(buckets[i]), root, once, squeezed(keys[i:j]), less[i:j].tobytes())
                for i, j in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in COPIES.split(", ")])

    rows = joined(packets.select("node", "text"), groups, "node")
    parts = F.ceil(F.col("n") / WHOLE)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts)).select("root", "part", "n", "text")
    dealt = rows.repartition("root", "part").sortWithinPartitions("root", "part")
    return dealt.mapInPandas(count, COPIES)


def summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all, and the sums of their values."""
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([v for _, v in found]), len(keys))


def corrected(answers: DataFrame, copies: DataFrame) -> DataFrame:
    """The answers, less what ``counted_once`` takes off; written."""

    def correct(told: pd.DataFrame, copies: pd.DataFrame) -> pd.DataFrame:
        if not len(told) or not len(copies):
            return told
        found = []
        for root, rows in copies.groupby("root"):
            parts = [(widened(k), np.frombuffer(v)) for k, v in zip(rows["keys"], rows["less"], strict=True)]
            keys, less = summed(parts)
            found.append((keys, less - rows["once"].iloc[0]))
        keys, less = summed(found)
        held_by = []
        for own, held in zip(told["keys"], told["held_by"], strict=True):
            own, held = widened(own), np.frombuffer(held, np.float32).copy()
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            same = keys[at] == own
            held[same] -= less[at[same]]
            held_by.append(held.tobytes())
        return told.assign(held_by=held_by)

    both = answers.groupBy("bucket").cogroup(copies.groupBy("bucket"))
    return written(both.applyInPandas(correct, ANSWERS), "counted")


def shared_shingles(packets: DataFrame) -> tuple[DataFrame, int]:
    """The answers to all packets, and the number of texts."""
    total, size = packets.agg(F.count("*"), F.sum(F.length("text"))).first()
    bits = max(math.ceil(math.log2((size or 0) / CHARACTERS / BUCKET + 1)), LEAST_BITS)
    told = answered(asked(packets, bits), bits)
    groups, answers = copy_groups(told), told.filter("bucket >= 0")
    if groups is not None:
        answers = corrected(answers, counted_once(packets, groups, total, bits))
        drop_written(told)
        told = answers
    answers = answers.select("packet", "keys", "held_by")
    answers._written_at = told._written_at
    return answers, total


def weights_of(answers: pd.DataFrame, total: int) -> Weights:
    """The weights that answers to a packet give."""
    if not len(answers):
        return Weights(np.zeros(0, np.uint64), np.zeros(0), total)
    keys = np.concatenate([widened(x) for x in answers["keys"]])
    held_by = np.concatenate([np.frombuffer(x, np.float32) for x in answers["held_by"]])
    keys, at = np.unique(keys, return_index=True)
    return Weights(keys, held_by[at] / total, total)


def common_shingles(docs: DataFrame, column: str = "text") -> Weights:
    """The weights of all shingles of a small table: those that several distinct texts hold
    are collected, with their exact shares. ``near_duplicates`` never collects them."""
    named = docs.select(F.lit(0).cast("long").alias("doc_id"), F.col(f"`{column}`").alias("text"))
    answers, total = shared_shingles(distinct_texts(named))
    return weights_of(answers.toPandas(), total)


def signed(packets: DataFrame, answers: DataFrame, total: int) -> DataFrame:
    """(node, doc_id, digest, bands, samples, keys, odd, vals), the last three the text's
    condensed weighted set; no bands for a text without words; written."""

    def drawn(run: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, bytes]]:
        bands = np.random.Generator(np.random.PCG64(12)).integers(
            1, 2**63, (BANDS, ROWS), dtype=np.uint64
        ) | np.uint64(1)
        rows = signatures(run)
        keys = (rows.reshape(-1, BANDS, ROWS) * bands).sum(axis=2)
        keys = (keys ^ (keys >> np.uint64(29))).view(np.int64)
        kept = (rows * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8)
        return zip(keys, map(bytes, kept), strict=True)

    def sign(texts: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        weigh = weights_of(told, total)
        found: list[tuple[np.ndarray, bytes]] = []
        sets, run, size, worded = [], [], 0, []
        for hashes in shingles(list(texts["text"])):
            own = weigh.weighed(hashes)
            sets.append(packed(*condensed(*own)))
            worded.append(len(hashes) > 0)
            if len(hashes):
                run.append(own[:2])
                size += len(own[0])
            if size >= DRAWN:
                found += drawn(run)
                run, size = [], 0
        if run:
            found += drawn(run)
        rows = iter(found)
        marks = [next(rows) if has else (None, None) for has in worded]
        out = texts[["node", "doc_id", "digest"]].reset_index(drop=True)
        out["bands"], out["samples"] = [x for x, _ in marks], [x for _, x in marks]
        return out.join(pd.DataFrame(sets, columns=["keys", "odd", "vals"]))

    both = packets.groupBy("packet").cogroup(answers.groupBy("packet"))
    return written(both.applyInPandas(sign, SIGNED), "signed")


def forest(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows whose samples agree enough, as places: a maximum spanning forest
    by agreement, and everyone's nearest partner."""
    n, least = len(samples), LEAST_AGREEMENT * SAMPLES
    best, parent = np.full(n, -1, np.int32), np.full(n, -1)
    left = np.ones(n, bool)
    a, b = [], []
    at = 0
    for _ in range(n):
        left[at] = False
        if best[at] >= least:
            a.append(at)
            b.append(parent[at])
        agree = (samples == samples[at]).sum(axis=1, dtype=np.int32)
        agree[at] = -1
        near = int(agree.argmax())
        if agree[near] >= least:
            a.append(at)
            b.append(near)
        closer = left & (agree > best)
        best[closer] = agree[closer]
        parent[closer] = at
        if not left.any():
            break
        at = int(np.where(left, best, -2).argmax())
    return np.array(a, int), np.array(b, int)


def bucket_blocks(nodes: DataFrame) -> DataFrame:
    """(node, block) from (node, bands): any two texts of a bucket share a block; written."""
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = rows.withColumn("n", F.count("*").over(W.partitionBy("band", "key"))).filter("n > 1")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    others = F.when(parts == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), parts - 1))
    blocks = shared.select("node", "band", "key", own.alias("own"), F.explode(others).alias("other"))
    blocks = blocks.select(
        "node",
        F.xxhash64("band", "key", F.least("own", "other"), F.greatest("own", "other")).alias("block"),
    )
    return written(blocks, "blocks")


def in_blocks(rows: DataFrame, links, label: str) -> DataFrame:
    """(a, b) with a < b, once each, of what ``links`` yields for the rows of every block,
    as places; written."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            ends = np.flatnonzero(np.diff(rest["block"].to_numpy())) + 1
            if len(ends):
                yield linked(rest.iloc[: ends[-1]])
                rest = rest.iloc[ends[-1] :]
        if rest is not None and len(rest):
            yield linked(rest)

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        ids, block = rows["node"].to_numpy(np.int64), rows["block"].to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(block)) + 1), len(rows)]
        found = [np.zeros((2, 0), np.int64)]
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            if j - i > 1:
                a, b = links(rows.iloc[i:j])
                found.append(np.stack([ids[i:j][a], ids[i:j][b]]))
        a, b = np.concatenate(found, axis=1)
        out = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        return out[out["a"] != out["b"]].drop_duplicates()

    dealt = rows.repartition("block").sortWithinPartitions("block", "node")
    return written(dealt.mapInPandas(link, "a long, b long").distinct(), label)


def matrix_of(samples: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(samples), np.uint8).reshape(len(samples), SAMPLES)


def candidate_links(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) with a < b from (node, block) and (node, samples), to be verified."""

    def spanning(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return forest(matrix_of(rows["samples"]))

    return in_blocks(blocks.join(nodes.select("node", "samples"), "node"), spanning, "candidates")


def packed(keys: np.ndarray, weights: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Sorted 32-bit fingerprints, and places and values of weights other than 1."""
    short = (keys >> np.uint64(32)).astype(np.uint32)
    odd = np.flatnonzero(weights != 1.0)
    return short.tobytes(), odd.astype(np.uint32).tobytes(), weights[odd].astype(np.float32).tobytes()


def unpacked(keys: bytes, odd: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    short = np.frombuffer(keys, np.uint32)
    weights = np.ones(len(short))
    weights[np.frombuffer(odd, np.uint32)] = np.frombuffer(values, np.float32)
    return short, weights


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum()
    most = a[1].sum() + b[1].sum() - least
    return float(least / most) if most else 0.0


class Sets:
    """Weighted sets that are compared with each other by postings."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray]]):
        lengths = np.array([len(k) for k, _ in sets])
        keys, weights = (np.concatenate([x[i] for x in sets]) for i in (0, 1))
        order = np.argsort(keys, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), lengths)[order]
        self.weights = weights[order]
        _, rank, self.held = np.unique(keys, return_inverse=True, return_counts=True)
        self.first = np.cumsum(self.held) - self.held
        self.bounds = np.append(0, np.cumsum(lengths))
        self.rank, self.own = rank, weights
        self.totals = np.add.reduceat(weights, self.bounds[:-1])

    def similar(self, i: int) -> np.ndarray:
        """The weighted Jaccard similarity of set i to every set."""
        mine = slice(self.bounds[i], self.bounds[i + 1])
        rank, own = self.rank[mine], self.own[mine]
        shared = self.held[rank] > 1
        rank, own = rank[shared], own[shared]
        held = self.held[rank]
        at = np.arange(held.sum()) + np.repeat(self.first[rank] - (np.cumsum(held) - held), held)
        least = np.minimum(self.weights[at], np.repeat(own, held))
        common = np.bincount(self.owners[at], least, len(self.totals))
        return common / (self.totals[i] + self.totals - common)


def connecting(
    samples: np.ndarray, roots: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of at least ``least``, as places, that connect all rows with different roots
    that such links can connect; of rows that agree enough every pair is looked at."""
    labels = np.unique(roots, return_inverse=True)[1]
    a, b, postings = [], [], None
    n, enough = len(samples), LEAST_AGREEMENT * SAMPLES
    for begin in range(0, n, AT_ONCE):
        some = samples[begin : begin + AT_ONCE]
        agree = np.zeros((len(some), n), np.uint8)
        for k in range(SAMPLES):
            agree += some[:, k, None] == samples[None, :, k]
        for i in range(begin, begin + len(some)):
            near = np.flatnonzero((agree[i - begin] >= enough) & (labels != labels[i]))
            near = near[near > i]
            if not len(near):
                continue
            if len(near) > FEW:
                postings = postings or Sets(sets)
                similar = postings.similar(i)[near]
            else:
                similar = np.array([weighted_jaccard(sets[i], sets[j]) for j in near])
            for j in near[similar >= least - ROUNDING]:
                if labels[i] != labels[j]:
                    a.append(i)
                    b.append(j)
                    labels[labels == labels[j]] = labels[i]
    return np.array(a, int), np.array(b, int)


def sets_of(nodes: DataFrame, named: DataFrame) -> DataFrame:
    """(node, keys, odd, vals) of the nodes that are named; written."""
    # The list grows with the corpus, so it is joined by shuffle at every size.
    sets = nodes.select("node", "keys", "odd", "vals").join(named.hint("merge"), "node")
    return written(sets, "sets", "none")


def verified(sets: DataFrame, links: DataFrame, least: float) -> DataFrame:
    """(a, b) of the links that hold; written."""

    @F.pandas_udf("double")
    def similarity(left: pd.DataFrame, right: pd.DataFrame) -> pd.Series:
        return pd.Series(
            weighted_jaccard(unpacked(*x), unpacked(*y))
            for x, y in zip(left.itertuples(index=False), right.itertuples(index=False), strict=True)
        )

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.struct("keys", "odd", "vals").alias(f"of_{name}"))

    both = links.join(side("a"), "a").join(side("b"), "b")
    scored = both.select("a", "b", similarity("of_a", "of_b").alias("similarity"))
    return written(scored.filter(F.col("similarity") >= least - ROUNDING).select("a", "b").distinct(), "verified")


def open_links(
    blocks: DataFrame, nodes: DataFrame, tried: DataFrame, roots: DataFrame, sets: DataFrame, least: float
) -> DataFrame:
    """(a, b) of links that connect what candidates connect and verified ones do not; written."""
    groups = components(tried).withColumnRenamed("root", "block")
    groups = groups.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = written(groups, "groups")
    sizes = groups.groupBy("block").agg(F.count("*").alias("n"), (F.min("root") != F.max("root")).alias("mixed"))
    sizes = written(sizes.filter("mixed").select("block", "n"), "mixed")
    apart = groups.join(sizes.hint("merge"), "block")
    small = apart.filter(F.col("n") <= TOGETHER).select("node", "root", "block")
    large = apart.filter(F.col("n") > TOGETHER).select("node", "root")
    # A bucket's block has a bounded number of rows; most have a single root.
    mixed = F.min("root").over(W.partitionBy("block")) != F.max("root").over(W.partitionBy("block"))
    large = blocks.distinct().join(large.hint("merge"), "node").withColumn("mixed", mixed)
    rows = small.unionByName(large.filter("mixed").select("node", "root", "block"))
    rows = rows.join(nodes.select("node", "samples").hint("merge"), "node").join(sets, "node")

    def connect(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        own = [unpacked(*x) for x in zip(rows["keys"], rows["odd"], rows["vals"], strict=True)]
        return connecting(matrix_of(rows["samples"]), rows["root"].to_numpy(np.int64), own, least)

    return in_blocks(rows, connect, "open")


def verified_links(nodes: DataFrame, least: float) -> DataFrame:
    """(a, b) of verified links that connect all classes of ``signed`` texts with words."""
    blocks = bucket_blocks(nodes)
    tried = candidate_links(blocks, nodes)
    named = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    sets = sets_of(nodes, named)
    held = verified(sets, tried, least)
    links = held.unionByName(open_links(blocks, nodes, tried, components(held), sets, least))
    # The links are complete; nothing reads what they were found by again.
    drop_written(blocks, tried, sets)
    return links


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every row of (doc_id, text).

    ``class_id`` is the smallest doc_id of the class. Null and empty texts are equal
    texts without shingles, as is any text without words: only exact copies of those
    share a class. Rows that share a doc_id are one document and share a class, also
    with different texts. A null doc_id gets a null class. Very long texts are shingled
    whole.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = named.filter("doc_id is not null")
    rows = written(known.select("doc_id", F.md5(text_of()).alias("digest")), "rows")
    packets = distinct_texts(known)
    answers, total = shared_shingles(packets)
    nodes = signed(packets, answers, total)
    # The sets are complete; nothing reads the texts again.
    drop_written(packets, answers)
    links = verified_links(nodes.filter("bands is not null"), least)
    # Different texts of one doc_id.
    several = rows.groupBy("doc_id").agg(F.min("digest").alias("digest"), F.max("digest").alias("last"))
    several = several.filter("digest <> last").select("doc_id")
    several = joined(rows.select("doc_id", "digest"), written(several, "several"), "doc_id").join(
        nodes.select("digest", "node"), "digest"
    )
    several = several.select("node", F.min("node").over(W.partitionBy("doc_id")).alias("first"))
    links = links.unionByName(several.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))
    roots = components(links)
    texts = nodes.select("digest", "node", "doc_id").join(roots.hint("merge"), "node", "left")
    texts = texts.withColumn("root", F.coalesce("root", "node"))
    classes = texts.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    classes = written(texts.join(classes, "root").select("digest", "class_id"), "classes")
    drop_written(nodes)
    done = rows.select("doc_id", "digest").join(classes, "digest")
    lost = named.filter("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return done.select("doc_id", "class_id").unionByName(lost)


def op10_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates(read(spark, sf_dir, "documents"))


QUERIES = {"op10_weighted_minhash": op10_weighted_minhash}
# All pairs are too many for SQL on whole tables; tests compare with brute force.
SQL: dict[str, str] = {}
