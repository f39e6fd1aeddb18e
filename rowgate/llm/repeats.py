"""Repeated passages by an enhanced suffix array over anchors.

A passage of ``LENGTH`` bytes has ``WINDOW`` substrings of ``GRAM`` bytes; the one with the
smallest hash is its anchor. Equal passages have equal anchors at equal places, so all
occurrences of a passage meet where its anchor's suffixes are sorted, and a suffix array
of one suffix in about sixteen finds every repeated passage.

1. Texts are packed (``PACKET`` bytes a row).
2. Packets send the hashes of their anchors, each once, to hash buckets, which answer
   which of them occur in several documents. Only those go on.
3. Packets send the fragments around these anchors, each once with the smallest
   document that has it, to the bucket of the anchor. A bucket sorts the suffixes that
   begin at the anchors, and the stack scan over the lengths of common prefixes gives
   the interval tree. Within an interval the texts to the left are sorted and scanned
   likewise: members that differ in the byte before the common left part make the
   repeat left-maximal. So come maximal repeats with all their occurrences.
4. Packets turn the answers into the bytes to remove.

What is common never gathers in one task. A fragment that many documents share is one
row per packet. An anchor that many documents share amid different texts (``HOT`` in a
packet) would have as many fragments as documents: its passages of exactly ``LENGTH``
bytes are reduced to their smallest document by hash instead, which gives the same
bytes. All else is bounded by packets and buckets, whose number grows with the data.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import drop_written, read, text_of, written
from rowgate.llm.nn_descent import runs, slices
from rowgate.llm.shingles import mixed

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1
SIDE = LENGTH - GRAM
WIDTH = 2 * SIDE + GRAM
# Text of a packet; a longer document is a packet of its own.
PACKET = 1 << 20
# Text per hash bucket.
BUCKET_BYTES = 8 << 20
# Documents of one packet with an anchor amid different texts that make it hot.
HOT = 48
# Window starts that are hashed together.
STRETCH = 1 << 18
# No byte of a UTF-8 text; stands before its begin and after its end.
OUTSIDE = 255
LAST = np.int64(2**63 - 1)

PACKETS = "packet long, kind int, bucket int, orders binary, nulls binary, sizes binary, body binary"
_RANDOM = np.random.Generator(np.random.PCG64(50))
_STEP = _RANDOM.integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)
_BYTE = _RANDOM.integers(1, 2**63, (3, 256), dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 2**63, (2, LENGTH), dtype=np.uint64) | np.uint64(1)


# --- Arrays in rows.


def squeezed(array: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(array).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def widened(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return np.frombuffer(raw, kind)


# --- Anchors.


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position, by doubling."""
    hashes = {1: _BYTE[0][codes]}
    size = 1
    while 2 * size <= GRAM:
        one = hashes[size]
        hashes[2 * size] = one[:-size] * _STEP[size.bit_length()] + one[size:]
        size *= 2
    out, have = hashes[size], size
    while have < GRAM:  # the binary digits of GRAM, from above
        size = 1 << ((GRAM - have).bit_length() - 1)
        more = hashes[size][have:]
        out = out[: len(more)] * _STEP[0] + more
        have += size
    return mixed(out)


def anchors(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all anchors of texts that lie one after another."""
    ends = np.cumsum(sizes)
    found = []
    for first in range(0, max(len(codes) - LENGTH + 1, 0), STRETCH):
        last = min(first + STRETCH, len(codes) - LENGTH + 1)
        hashes = gram_hashes(codes[first : last + LENGTH - 1])
        # The leftmost of equal hashes counts, so that the choice depends on the
        # passage alone: the position fills the lowest bits.
        keys = (hashes & ~np.uint64((1 << 20) - 1)) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while 2 * size <= WINDOW:
            keys = np.minimum(keys[:-size], keys[size:])
            size *= 2
        if size < WINDOW:
            keys = np.minimum(keys[: size - WINDOW], keys[WINDOW - size :])
        starts = np.arange(first, last)
        inside = starts + LENGTH <= ends[np.searchsorted(ends, starts, "right")]
        places = np.unique((keys & np.uint64((1 << 20) - 1)).astype(np.int64)[inside])
        found.append((places + first, hashes[places]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, where = np.unique(np.concatenate([p for p, _ in found]), return_index=True)
    return places, np.concatenate([h for _, h in found])[where]


class Packet:
    """The texts of a packet with what is computed from them again in every pass."""

    def __init__(self, row):
        self.id = row.packet
        self.orders = np.frombuffer(row.orders, np.int64)
        self.sizes = np.frombuffer(row.sizes, np.int64)
        self.codes = widened(row.body, np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.places, self.hashes = anchors(self.codes, self.sizes)
        self.owners = np.searchsorted(self.ends, self.places, "right")

    def distinct(self, most: int = HOT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes, which each anchor has, and whether several documents
        have it and whether it is hot."""
        keys, index = np.unique(self.hashes, return_inverse=True)
        pairs = np.unique(index.astype(np.int64) * (len(self.sizes) + 1) + self.owners)
        documents = np.bincount(pairs // (len(self.sizes) + 1), minlength=len(keys))
        # Hot are anchors amid many different texts, not those of many equal texts.
        hot = documents >= most
        if hot.any():
            own = np.flatnonzero(hot[index])
            _, fragment = distinct_rows(self.fragments(own))
            amid = np.unique(index[own].astype(np.int64) * (len(own) + 1) + fragment) // (len(own) + 1)
            hot = np.bincount(amid, minlength=len(keys)) >= most
        return keys, index, documents > 1, hot

    def fragments(self, which: np.ndarray) -> np.ndarray:
        """Anchor, text to the right, text to the left read backwards."""
        out = np.empty((len(which), WIDTH), np.uint8)
        places, owners = self.places[which], self.owners[which]
        begins = (self.ends - self.sizes)[owners]
        ends = self.ends[owners]
        shifts = [*range(LENGTH), *range(-1, -SIDE - 1, -1)]
        for column, shift in enumerate(shifts):
            at = places + shift
            inside = (at >= begins) & (at < ends)
            out[:, column] = np.where(inside, self.codes[np.clip(at, 0, len(self.codes) - 1)], OUTSIDE)
        return out


def least_orders(index: np.ndarray, count: int, orders: np.ndarray) -> np.ndarray:
    out = np.full(count, LAST)
    np.minimum.at(out, index, orders)
    return out


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct byte rows in order, and which of them each row is."""
    view = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()
    found, index = np.unique(view, return_inverse=True)
    return found.view(np.uint8).reshape(-1, rows.shape[1]), index.ravel()


# --- The enhanced suffix array.


def common_prefix(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the next; the text's end ends it."""
    same = (rows[1:] == rows[:-1]) & (rows[1:] != OUTSIDE)
    return np.where(same.all(axis=1), rows.shape[1], (~same).argmax(axis=1))


def intervals(lengths: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of the common-prefix tree, by one scan
    with a stack over the lengths between neighbours."""
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*lengths, -1]):
        first = i
        while stack and stack[-1][0] > length:
            depth, first = stack.pop()
            yield depth, first, i
        if length >= 0 and (not stack or stack[-1][0] < length):
            stack.append((length, first))


def maximal_repeats(rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(left, right, members) of the maximal repeats of ``LENGTH`` bytes and more.

    ``rows`` are distinct fragments of one anchor in suffix order. The members share
    ``left`` bytes before and ``right`` after the anchor, and no more to either side.
    """
    right = (common_prefix(rows[:, :LENGTH]) - GRAM).tolist()
    for depth, first, last in intervals(right):
        members = np.arange(first, last + 1)
        lefts = rows[members, LENGTH:]
        order = np.lexsort(lefts.T[::-1])
        common = common_prefix(lefts[order]).tolist()
        for left, i, j in intervals(common):
            if left + depth >= SIDE:
                yield left, depth, members[order[i : j + 1]]


def reaches(rows: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """For distinct sorted fragments: how far left and right of the anchor the
    fragment's smallest document repeats a smaller one; 255 for not at all."""
    out = np.full((len(rows), 2), 255, np.uint8)
    if len(rows) < 2:
        return out
    lcp = common_prefix(rows[:, :LENGTH])
    joined = lcp >= GRAM
    starts = np.flatnonzero(np.concatenate([[True], ~joined]))
    sizes = np.diff([*starts, len(rows)])
    # Most anchors have two different fragments: one interval with two members.
    two = starts[sizes == 2]
    if len(two):
        left = common_prefix_of(rows[two, LENGTH:], rows[two + 1, LENGTH:])
        right = lcp[two] - GRAM
        long = (left + right >= SIDE) & (orders[two] != orders[two + 1])
        later = two + (orders[two + 1] > orders[two])
        out[later[long]] = np.stack([left[long], right[long]], axis=1)
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
        own = rows[start : start + size]
        best = np.full((size, 2), -1)
        for left, right, members in maximal_repeats(own):
            own_orders = orders[start + members]
            late = members[own_orders > own_orders.min()]
            best[late] = np.maximum(best[late], [left, right])
        hit = best[:, 0] >= 0
        out[start + np.flatnonzero(hit)] = best[hit]
    return out


def common_prefix_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = (a == b) & (a != OUTSIDE)
    return np.where(same.all(axis=1), a.shape[1], (~same).argmax(axis=1))


# --- Messages between packets and buckets.


def packed_texts(docs: DataFrame, packet_bytes: int = PACKET) -> DataFrame:
    """Packets of (doc_id, text); written. A null doc_id is larger than all others."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        orders, nulls, texts, size = [], [], [], 0

        def row() -> pd.DataFrame:
            sizes = np.array([len(t) for t in texts], np.int64)
            body = squeezed(np.frombuffer(b"".join(texts), np.uint8))
            name = uuid.uuid4().int >> 65
            values = (
                name, 0, -1, np.array(orders, np.int64).tobytes(), np.array(nulls, bool).tobytes(),
                sizes.tobytes(), body,
            )
            return pd.DataFrame([values], columns=[x.split()[0] for x in PACKETS.split(", ")])

        for batch in batches:
            for name, null, text in zip(batch["doc_id"], batch["is_null"], batch["text"], strict=True):
                orders.append(name)
                nulls.append(null)
                texts.append(text.encode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size >= packet_bytes:
                    yield row()
                    orders, nulls, texts, size = [], [], [], 0
        if texts:
            yield row()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc_id"),
        F.col("doc_id").isNull().alias("is_null"), text_of().alias("text"),
    )
    return written(rows.mapInPandas(pack, PACKETS), "packets", "none")


MESSAGE = "packet long, kind int, bucket int, body binary"


def to_buckets(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys by bucket, the buckets that have any, and where they begin."""
    bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, begins = np.unique(bucket[order], return_index=True)
    return order, names, np.append(begins, len(keys))


def sent_anchors(packets: DataFrame, buckets: int, most: int = HOT) -> DataFrame:
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                packet, out = Packet(row), []
                keys, _, several, hot = packet.distinct(most)
                state = several.astype(np.uint8) + hot
                order, names, begins = to_buckets(keys, buckets)
                for name, i, j in zip(names, begins[:-1], begins[1:], strict=True):
                    at = order[i:j]
                    body = (keys[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
                    out.append((packet.id, 1, name, body + state[at].tobytes()))
                yield pd.DataFrame(out, columns=["packet", "kind", "bucket", "body"])

    return packets.mapInPandas(send, MESSAGE)


def answered(messages: DataFrame, answer) -> DataFrame:
    """The messages of each bucket, answered together by ``answer(bodies)``."""

    def reply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, "group"):
            for group in slices(run, "group"):
                bodies = answer(group["body"].tolist())
                yield group[["packet", "kind", "bucket"]].assign(body=bodies)

    dealt = messages.withColumn("group", F.xxhash64("kind", "bucket"))
    dealt = dealt.repartition("group").sortWithinPartitions("group")
    return dealt.mapInPandas(reply, MESSAGE)


def answer_anchors(bodies: list[bytes]) -> list[bytes]:
    """0 for an anchor of one document, 1 for one of several, 2 for a hot one."""
    counts = [len(b) // 5 for b in bodies]
    keys = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(bodies, counts, strict=True)])
    state = np.concatenate(
        [np.frombuffer(b, np.uint8, n, 4 * n) for b, n in zip(bodies, counts, strict=True)]
    )
    _, index, held_by = np.unique(keys, return_inverse=True, return_counts=True)
    most = np.zeros(len(held_by), np.uint8)
    np.maximum.at(most, index, state)
    most = np.maximum(most, (held_by > 1).astype(np.uint8))[index]
    return [squeezed(part) for part in np.split(most, np.cumsum(counts)[:-1])]


def anchor_states(packet: Packet, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """The answered state of every anchor of the packet."""
    keys, index, _, _ = packet.distinct()
    order, names, begins = to_buckets(keys, buckets)
    states = np.zeros(len(keys), np.uint8)
    for name, i, j in zip(names, begins[:-1], begins[1:], strict=True):
        states[order[i:j]] = widened(answers[int(name)], np.uint8)
    return states[index]


def with_answers(packets: DataFrame, *answers: DataFrame) -> DataFrame:
    """Each packet's row followed by the answers to it, in one task."""
    both = packets
    for more in answers:
        both = both.unionByName(more, allowMissingColumns=True)
    return both.repartition("packet").sortWithinPartitions("packet", "kind")


def opened(group: pd.DataFrame) -> tuple[Packet, dict[int, dict[int, bytes]]]:
    rows = list(group.itertuples(index=False))
    answers: dict[int, dict[int, bytes]] = {1: {}, 2: {}, 3: {}}
    for row in rows[1:]:
        answers[row.kind][row.bucket] = row.body
    return Packet(rows[0]), answers


class Outgoing:
    """What a packet asks about its shared anchors, the same in both passes."""

    def __init__(self, packet: Packet, states: np.ndarray, buckets: int):
        orders = packet.orders[packet.owners]
        self.cool = np.flatnonzero(states == 1)
        rows, self.fragment = distinct_rows(packet.fragments(self.cool))
        self.rows, self.orders = rows, least_orders(self.fragment, len(rows), orders[self.cool])
        self.row_hash = mixed(
            (_BYTE[1][rows[:, :GRAM]] * _PLACE[0][:GRAM]).sum(axis=1) if len(rows) else np.zeros(0, np.uint64)
        )
        # Passages of hot anchors: (anchor, first byte), hashed twice with 64 bits.
        hot = np.flatnonzero(states == 2)
        firsts, owners = [], []
        for shift in range(WINDOW):
            first = packet.places[hot] - shift
            owner = packet.owners[hot]
            inside = (first >= (packet.ends - packet.sizes)[owner]) & (first + LENGTH <= packet.ends[owner])
            firsts.append(first[inside])
            owners.append(owner[inside])
        self.firsts, where = np.unique(np.concatenate(firsts), return_index=True) if firsts else ([], [])
        self.first_orders = packet.orders[np.concatenate(owners)[where].astype(np.int64)]
        names = np.zeros((len(self.firsts), 2), np.uint64)
        for k in range(LENGTH):
            at = packet.codes[self.firsts + k]
            names[:, 0] += _BYTE[1][at] * _PLACE[0][k]
            names[:, 1] += _BYTE[2][at] * _PLACE[1][k]
        names = mixed(names)
        view, self.passage = distinct_rows(names.view(np.uint8).reshape(-1, 16))
        self.names = np.ascontiguousarray(view).view(np.uint64).reshape(-1, 2)
        self.name_orders = least_orders(self.passage, len(self.names), self.first_orders)
        self.by_row = to_buckets(self.row_hash, buckets)
        self.by_name = to_buckets(self.names[:, 0], buckets)

    def messages(self, name: int) -> list[tuple[int, int, int, bytes]]:
        out = []
        order, names, begins = self.by_row
        for bucket, i, j in zip(names, begins[:-1], begins[1:], strict=True):
            at = order[i:j]
            body = np.concatenate([self.orders[at].view(np.uint8), self.rows[at].ravel()])
            out.append((name, 2, bucket, squeezed(body)))
        order, names, begins = self.by_name
        for bucket, i, j in zip(names, begins[:-1], begins[1:], strict=True):
            at = order[i:j]
            body = np.concatenate([self.name_orders[at].view(np.uint8), self.names[at].view(np.uint8).ravel()])
            out.append((name, 3, bucket, squeezed(body)))
        return out


def sent_fragments(packets: DataFrame, states: DataFrame, buckets: int) -> DataFrame:
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, "packet"):
            for group in slices(run, "packet"):
                packet, answers = opened(group)
                asked = Outgoing(packet, anchor_states(packet, answers[1], buckets), buckets)
                yield pd.DataFrame(asked.messages(packet.id), columns=["packet", "kind", "bucket", "body"])

    return with_answers(packets, states).mapInPandas(send, MESSAGE)


def split_rows(bodies: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Orders, rows and their number in each of the bodies."""
    orders, rows, counts = [], [], []
    for body in bodies:
        data = widened(body, np.uint8)
        n = len(data) // (8 + width)
        counts.append(n)
        orders.append(data[: 8 * n].view(np.int64))
        rows.append(data[8 * n :].reshape(n, width))
    return np.concatenate(orders), np.concatenate(rows), counts


def answer_fragments(bodies: list[bytes]) -> list[bytes]:
    """Per fragment its smallest document and how far that one repeats smaller ones."""
    orders, rows, counts = split_rows(bodies, WIDTH)
    distinct, index = distinct_rows(rows)
    least = least_orders(index, len(distinct), orders)
    reach = reaches(distinct, least)
    ends = np.cumsum(counts)
    return [
        squeezed(np.concatenate([least[index[i:j]].view(np.uint8), reach[index[i:j]].ravel()]))
        for i, j in zip(ends - counts, ends, strict=True)
    ]


def answer_passages(bodies: list[bytes]) -> list[bytes]:
    """Per passage its smallest document."""
    orders, rows, counts = split_rows(bodies, 16)
    distinct, index = distinct_rows(rows)
    least = least_orders(index, len(distinct), orders)[index]
    return [squeezed(part) for part in np.split(least, np.cumsum(counts)[:-1])]


def covered(packet: Packet, asked: Outgoing, answers: dict[int, dict[int, bytes]]) -> np.ndarray:
    """Whether each byte of the packet is to be removed."""
    marks = np.zeros(len(packet.codes) + 1, np.int32)
    begins = packet.ends - packet.sizes

    least = np.zeros(len(asked.rows), np.int64)
    reach = np.zeros((len(asked.rows), 2), np.uint8)
    order, names, starts = asked.by_row
    for bucket, i, j in zip(names, starts[:-1], starts[1:], strict=True):
        data = widened(answers[2][int(bucket)], np.uint8)
        least[order[i:j]] = data[: 8 * (j - i)].view(np.int64)
        reach[order[i:j]] = data[8 * (j - i) :].reshape(-1, 2)
    places, owners = packet.places[asked.cool], packet.owners[asked.cool]
    whole = packet.orders[owners] > least[asked.fragment]
    left = np.where(whole, SIDE, reach[asked.fragment, 0]).astype(np.int64)
    right = np.where(whole, SIDE, reach[asked.fragment, 1]).astype(np.int64)
    first = np.maximum(places - left, begins[owners])
    end = np.minimum(places + GRAM + right, packet.ends[owners])
    hit = (left < 255) & (end - first >= LENGTH)
    np.add.at(marks, first[hit], 1)
    np.add.at(marks, end[hit], -1)

    least = np.zeros(len(asked.names), np.int64)
    order, names, starts = asked.by_name
    for bucket, i, j in zip(names, starts[:-1], starts[1:], strict=True):
        least[order[i:j]] = widened(answers[3][int(bucket)], np.int64)
    hit = asked.firsts[asked.first_orders > least[asked.passage]]
    np.add.at(marks, hit, 1)
    np.add.at(marks, hit + LENGTH, -1)
    return np.cumsum(marks[:-1]) > 0


RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
)


def removed(packets: DataFrame, *answers: DataFrame, buckets: int, with_kept: bool) -> DataFrame:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, "packet"):
            for group in slices(run, "packet"):
                packet, told = opened(group)
                nulls = np.frombuffer(group["nulls"].iloc[0], bool)
                asked = Outgoing(packet, anchor_states(packet, told[1], buckets), buckets)
                gone, out = covered(packet, asked, told), []
                for i, (begin, end) in enumerate(zip(packet.ends - packet.sizes, packet.ends, strict=True)):
                    mask = gone[begin:end]
                    spans = int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum())
                    kept = packet.codes[begin:end][~mask].tobytes()
                    out.append(
                        (
                            None if nulls[i] else int(packet.orders[i]), int(end - begin), int(mask.sum()),
                            spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None,
                        )
                    )
                frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
                yield frame.astype({"doc_id": "Int64"})

    return with_answers(packets, *answers).mapInPandas(cut, RESULT)


def without_repeats(
    docs: DataFrame, with_kept: bool = True, packet_bytes: int = PACKET, hot: int = HOT
) -> DataFrame:
    """Per row of (doc_id, text): what is left when repeated passages are removed.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the bytes that
    remain (they may begin or end inside a character; null unless ``with_kept``). A byte
    is removed if a passage of ``LENGTH`` bytes covers it that also starts in a document
    with a smaller doc_id. Null texts are empty. Rows that share a doc_id are not smaller
    than one another, a null doc_id is larger than all others. Texts under ``LENGTH``
    bytes are kept.
    """
    packets = packed_texts(docs, packet_bytes)
    total = packets.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    # Text is about three times its compressed size.
    buckets = max(8, 3 * total // BUCKET_BYTES)
    states = written(answered(sent_anchors(packets, buckets, hot), answer_anchors), "anchors")
    asked = written(sent_fragments(packets, states, buckets), "fragments", "none")
    cool = answered(asked.filter("kind = 2"), answer_fragments)
    passages = answered(asked.filter("kind = 3"), answer_passages)
    told = written(cool.union(passages), "told", "none")
    # The answers are complete; the questions are as large as the texts.
    drop_written(asked)
    return removed(packets, states, told, buckets=buckets, with_kept=with_kept)


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document repeats passages of earlier ones."""
    docs = read(spark, sf_dir, "documents")
    return without_repeats(docs, with_kept=False).drop("kept")


QUERIES = {"op1_suffix_repeats": op1_suffix_repeats}
# All 50-byte strings of all texts are too many for SQL; tests compare with brute force.
SQL: dict[str, str] = {}
