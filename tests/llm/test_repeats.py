import hashlib
import random

import numpy as np
import pytest

from rowgate.llm import repeats

WORDS = [f"{a}{b}{c}" for a in ("ba", "no", "té", "ri") for b in ("l", "mu", "z") for c in ("o", "an")]


def brute(rows):
    """Every string of 50 bytes, looked up in all documents."""
    first = {}
    for key, text in rows:
        raw = (text or "").encode()
        key = 2**63 if key is None else key
        for p in range(len(raw) - 49):
            s = raw[p : p + 50]
            first[s] = min(first.get(s, key), key)
    out = []
    for key, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < (2**63 if key is None else key):
                gone[p : p + 50] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((key, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    shared = [sentence(rng, 25) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(1, 40))]
        if i % 2:
            parts.insert(rng.randrange(2), shared[i % 4])
        if i % 5 == 0:
            parts.append("x" * 120)
        rows.append((100 - i, " ".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (1, None), (2, ""), (3, "a" * 49), (4, "a" * 50)]
    rows += [(None, rows[5][1]), (7, rows[5][1]), (7, rows[5][1]), (8, "ü" * 3000), (9, "ü" * 40)]
    return rows


@pytest.mark.parametrize(("packet_bytes", "hot"), [(1 << 20, 48), (700, 2), (3000, 1000)])
def test_equals_brute_force(docs, packet_bytes, hot):
    rows = corpus(packet_bytes)
    found = repeats.without_repeats(docs(rows), packet_bytes=packet_bytes, hot=hot).collect()
    found = [(r[0], r[1], r[2], r[3], r[4], bytes(r[5])) for r in found]
    key = lambda r: (2**63 if r[0] is None else r[0], r[4])
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def test_extra_columns_and_empty_table(docs):
    rows = [(1, "q" * 60, "en", "s", 60, 5), (2, "q" * 60, "en", "s", 60, 6)]
    found = repeats.without_repeats(docs(rows, ", kept long"))
    assert sorted((r.doc_id, r.n_removed) for r in found.collect()) == [(1, 0), (2, 60)]
    assert repeats.without_repeats(docs([])).collect() == []


def test_intervals_of_a_known_tree():
    # banana$: suffix array 6 5 3 1 0 4 2, common prefixes 0 1 3 0 0 2.
    found = set(repeats.intervals([0, 1, 3, 0, 0, 2]))
    assert found == {(3, 2, 3), (1, 1, 3), (2, 5, 6), (0, 0, 6)}


def test_maximal_repeats_have_all_members_and_differ_to_both_sides():
    core, side = b"k" * repeats.GRAM, repeats.SIDE

    def row(left, right):
        text = core + right.ljust(side, b"\xff") + left[::-1].ljust(side, b"\xff")
        return np.frombuffer(text, np.uint8)

    long = b"r" * side
    rows = np.stack([row(b"a" * 9, long), row(b"b" * 9, long), row(b"b" * 9, b"r" * 10 + b"s" * 20)])
    rows, _ = repeats.distinct_rows(rows)
    found = {(left, right, len(m)) for left, right, m in repeats.maximal_repeats(rows)}
    assert found == {(0, side, 2)}
