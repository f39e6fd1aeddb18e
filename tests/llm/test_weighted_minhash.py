import random
from pathlib import Path

import numpy as np
import pytest

from rowgate.llm import weighted_minhash as w
from rowgate.llm.components import components
from rowgate.llm.shingles import shingles
from rowgate.session import checkpoint_root

WORDS = [f"{a}{b}" for a in "abcdefghij" for b in ("ra", "lo", "mi", "nu", "tes", "vo", "ki", "sa")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def changed(source, count, rng):
    words = source.split()
    for _ in range(count):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def brute(rows, weigh):
    texts = [t or "" for _, t in rows]
    sets = [weigh(h) for h in shingles(texts)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = texts[i] == texts[j]
            if same or len(sets[i][0]) and len(sets[j][0]) and w.weighted_jaccard(sets[i], sets[j]) >= w.SIMILARITY:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    classes = {}
    for i, (key, _) in enumerate(rows):
        classes.setdefault(find(i), []).append(key)
    return {key: min(own) for own in classes.values() for key in own}


def test_classes_equal_brute_force(docs):
    rng = random.Random(5)
    rows, hub = [], text(rng, 300)
    rows += [(1000 - i, changed(hub, 6, rng)) for i in range(40)] + [(2000, hub)]
    for i in range(25):
        base = text(rng, rng.randrange(1, 200))
        rows.append((i, base))
        if i % 2:
            rows.append((100 + i, changed(base, 1, rng)))
        if i % 5 == 0:
            rows += [(200 + i, base), (300 + i, base.upper())]
    boiler = text(rng, 60)
    rows += [(400 + i, boiler + " " + text(rng, 60)) for i in range(12)]
    rows += [(500, None), (501, ""), (502, "!!!"), (503, "?"), (504, "one"), (505, "one"), (506, "one two")]
    rows += [(507, text(rng, 40_000)), (508, "a a a a a a a a a a"), (509, "a a a a a a")]
    weigh = w.common_shingles(docs(rows))
    assert len(weigh.keys), "some shingles are common"
    found = {r.doc_id: r.class_id for r in w.near_duplicates(docs(rows)).collect()}
    assert found == brute(rows, weigh)


def test_repeated_ids_nulls_and_empty_table(docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, "x")]
    found = sorted(((r.doc_id, r.class_id) for r in w.near_duplicates(docs(rows)).collect()), key=str)
    assert found == [(1, 1), (1, 1), (2, 1), (3, 3), (None, None)]
    assert w.near_duplicates(docs([])).collect() == []


def test_samples_agree_as_often_as_the_weighted_sets():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    weights = rng.choice([0.5, 1.0, 2.0, 3.3], 3000)
    for shift in (200, 800):
        a = slice(0, 2000)
        b = slice(shift, 2000 + shift)
        heavier = weights[b] * np.where(np.arange(2000) % 2, 1.0, 1.5)
        true = w.weighted_jaccard(
            tuple(x[np.argsort(keys[a])] for x in (keys[a], weights[a])),
            tuple(x[np.argsort(keys[b])] for x in (keys[b], heavier)),
        )
        agree = (w.signature(keys[a], weights[a]) == w.signature(keys[b], heavier)).mean()
        assert abs(agree - true) < 4 * np.sqrt(true * (1 - true) / w.SAMPLES)


def test_common_shingles_are_counted_exactly(docs, monkeypatch):
    rng = random.Random(9)
    common, rare = text(rng, 5), text(rng, 5)
    rows = [(i, f"{common} . {text(rng, 30)}" if i % 10 else text(rng, 30)) for i in range(100)]
    rows[3] = (3, rare)
    weigh = w.common_shingles(docs(rows))
    (key,) = next(shingles([common])).tolist()
    assert key in weigh.keys.tolist()
    share = 90 / 100 - (0.01 if 3 % 10 else 0)
    at = weigh.keys.tolist().index(key)
    assert weigh.idf[at] == pytest.approx(float(w.idf_of(np.array([share]))[0]))
    monkeypatch.setattr(w, "MOST_CANDIDATES", 0)
    again = w.common_shingles(docs(rows))
    assert again.keys.tolist() == weigh.keys.tolist() and np.allclose(again.idf, weigh.idf)


def test_blocks_of_a_large_bucket_span_it(spark, docs, monkeypatch):
    monkeypatch.setattr(w, "BLOCK", 4)
    rng = random.Random(7)
    base = text(rng, 200)
    rows = [(i, changed(base, 1, rng)) for i in range(30)]
    found = {r.class_id for r in w.near_duplicates(docs(rows)).collect()}
    assert found == {0}


def dense(rng, n):
    """Texts that all resemble each other a little below and above the threshold."""
    hub = text(rng, 600)
    return [(i, changed(hub, rng.randrange(3, 5), rng)) for i in range(n)]


@pytest.mark.parametrize("together", [1, 50, w.TOGETHER])
def test_links_that_the_forest_misses_are_found(docs, monkeypatch, together):
    monkeypatch.setattr(w, "TOGETHER", together)
    rng = random.Random(17)
    rows = dense(rng, 150)
    weigh = w.common_shingles(docs(rows))
    truth = brute(rows, weigh)
    found = {r.doc_id: r.class_id for r in w.near_duplicates(docs(rows)).collect()}
    assert 1 < len(set(truth.values())) < len(rows)
    assert found == truth


def test_a_group_without_links_is_searched_whole_and_puts_out_none():
    """1,500 texts at about 0.75: over a million pairs that agree enough, hardly a link."""
    rng = random.Random(18)
    hub = text(rng, 300)
    texts = [changed(hub, 5, rng) for _ in range(1500)]
    sets = [w.unpacked(*w.packed(*w.Weights(np.zeros(0, np.uint64), np.zeros(0))(h))) for h in shingles(texts)]
    rows = (w.signatures([(k.astype(np.uint64) << np.uint64(32), v) for k, v in sets])).astype(np.uint8)
    a, b = w.connecting(rows, np.arange(1500), sets, w.SIMILARITY)
    assert len(a) < 1500
    linked = set(zip(a.tolist(), b.tolist(), strict=True))
    assert all(w.weighted_jaccard(sets[i], sets[j]) >= w.SIMILARITY - w.ROUNDING for i, j in linked)
    label = list(range(1500))
    for i, j in linked:
        old, new = label[j], label[i]
        label = [new if x == old else x for x in label]
    draw = random.Random(19)
    for _ in range(4000):
        i, j = draw.sample(range(1500), 2)
        if w.weighted_jaccard(sets[i], sets[j]) >= w.SIMILARITY:
            assert label[i] == label[j]


def test_postings_give_the_weighted_jaccard_similarity():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(20):
        keys = np.unique(rng.integers(0, 60, rng.integers(1, 50), dtype=np.uint32))
        sets.append((keys, rng.choice([0.5, 1.0, 2.0], len(keys))))
    held = w.Sets(sets)
    for i in range(20):
        assert np.allclose(held.similar(i), [w.weighted_jaccard(sets[i], s) for s in sets])


def test_different_texts_of_one_id_share_a_class(docs):
    rng = random.Random(20)
    a, b, c = (text(rng, 80) for _ in range(3))
    rows = [(5, a), (5, b), (3, a), (8, b), (9, c), (4, changed(b, 1, rng)), (None, c)]
    found = sorted(((r.doc_id, r.class_id) for r in w.near_duplicates(docs(rows)).collect()), key=str)
    assert found == sorted([(5, 3), (5, 3), (3, 3), (8, 3), (9, 9), (4, 3), (None, None)], key=str)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 80), (7, 7)]
    frame = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {**{i: 0 for i in range(41)}, 80: 80, 90: 80, 100: 80}
    assert components(frame.limit(0)).collect() == []


def counted(texts):
    """How many distinct texts hold each shingle."""
    held = {}
    for hashes in shingles(sorted(set(texts))):
        for key in set(hashes.tolist()):
            held[key] = held.get(key, 0) + 1
    return held


@pytest.mark.parametrize("most", [0, 300, w.MOST_CANDIDATES])
def test_idf_covers_rare_shingles_and_counts_exact_copies_once(docs, monkeypatch, most):
    monkeypatch.setattr(w, "MOST_CANDIDATES", most)
    rng = random.Random(21)
    parts = [text(rng, 12) for _ in range(4)]
    # Shingles in one, two, three and five of 200 texts: all of them in under 5 %.
    rows = [(i, text(rng, 30)) for i in range(200)]
    for part, count in zip(parts, (1, 2, 3, 5), strict=True):
        for i in rng.sample(range(200), count):
            rows[i] = (i, f"{rows[i][1]} {part}")
    held = counted(t for _, t in rows)
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [(2000, None), (2001, "")]
    weigh = w.common_shingles(docs(rows))
    assert dict(zip(weigh.keys.tolist(), weigh.idf.tolist(), strict=True)) == pytest.approx(
        {key: float(w.idf_of(np.float64(n / 201))) for key, n in held.items() if n > 1}
    )
    found = [set(weigh(h)[1].tolist()) for h in shingles(parts)]
    assert found[0] == {1.0}
    assert 1 > max(found[1]) > max(found[2]) > max(found[3]) > 0.5
    for hashes in shingles([rows[7][1], f"{parts[1]} {parts[1]}"]):
        keys, weights = weigh(hashes)
        counts = [hashes.tolist().count(k) for k in keys.tolist()]
        idf = [np.log2(w.SMOOTH + 201 / held.get(k, 1)) / np.log2(w.SMOOTH + 201) for k in keys.tolist()]
        assert weights == pytest.approx(np.multiply(counts, idf))


@pytest.mark.parametrize("most", [40, w.MOST_CANDIDATES])
def test_what_a_few_texts_share_links_less_than_what_only_two_share(docs, monkeypatch, most):
    """Both pairs have 0.81 of their shingles in common; one pair's are in 20 of 500 texts."""
    monkeypatch.setattr(w, "MOST_CANDIDATES", most)
    rng = random.Random(22)
    rows = [(i, text(rng, 10)) for i in range(479)]
    often, seldom = text(rng, 52), text(rng, 56)
    rows += [(600 + i, f"{often} {text(rng, 6)}") for i in range(2)]
    rows += [(700 + i, f"{often} {text(rng, 90)}") for i in range(18)]
    rows += [(800 + i, f"{seldom} {text(rng, 4)}") for i in range(2)]
    sets = dict(zip([k for k, _ in rows], shingles([t for _, t in rows]), strict=True))
    counts = w.Weights(np.zeros(0, np.uint64), np.zeros(0))
    for a, b in ((600, 601), (800, 801)):
        assert w.weighted_jaccard(counts(sets[a]), counts(sets[b])) >= w.SIMILARITY
    weigh = w.common_shingles(docs(rows))
    found = {r.doc_id: r.class_id for r in w.near_duplicates(docs(rows)).collect()}
    assert found == brute(rows, weigh)
    assert found[601] == 601 and found[801] == 800


def test_squeezed_numbers_come_back():
    rng = np.random.default_rng(4)
    for top in (1, 2**8, 2**30, 2**56, 2**63):
        numbers = np.unique(rng.integers(0, top, 1000, dtype=np.uint64))
        assert w.widened(w.squeezed(numbers)).tolist() == numbers.tolist()
    ends = np.array([0, 2**64 - 1], np.uint64)
    assert w.widened(w.squeezed(ends)).tolist() == ends.tolist()


def test_condensed_sets_have_the_same_similarities_in_less_room(docs):
    rng = random.Random(23)
    base = [text(rng, 120) for _ in range(6)]
    rows = [(i, changed(b, k, rng)) for k in range(4) for i, b in enumerate(base, 10 * k)]
    rows += [(90, "one two"), (91, "one"), (92, ""), (93, f"{base[0]} {base[0]}")]
    weigh = w.common_shingles(docs(rows))
    whole = [weigh(h) for h in shingles([t for _, t in rows])]
    short = [w.condensed(*weigh.weighed(h)) for h in shingles([t for _, t in rows])]
    for a, b in zip(whole, short, strict=True):
        alone = ~np.isin(a[0], weigh.keys)
        assert len(b[0]) == (~alone).sum() + min(alone.sum(), 1) and set(b[0].tolist()) <= set(a[0].tolist())
    for i in range(len(rows)):
        for j in range(len(rows)):
            assert w.weighted_jaccard(short[i], short[j]) == pytest.approx(w.weighted_jaccard(whole[i], whole[j]))
    many = weigh.weighed(next(shingles([text(rng, 300)])))
    assert w.condensed(*many)[1].tolist() == [296.0]


def test_large_tables_are_deleted_once_the_classes_are_known(spark, docs):
    rng = random.Random(24)
    base = text(rng, 400)
    rows = [(i, changed(base, 1, rng)) for i in range(6)] + [(10, text(rng, 80))]
    folder = Path(checkpoint_root(spark).removeprefix("file://")) / "rowgate-llm"
    before = set(folder.glob("*"))
    found = w.near_duplicates(docs(rows))
    left = {p.name.split("-")[0] for p in set(folder.glob("*")) - before}
    assert not left & {"packets", "answers", "signed", "blocks", "candidates", "sets"}
    assert {r.doc_id: r.class_id for r in found.collect()} == {**dict.fromkeys(range(6), 0), 10: 10}


@pytest.mark.parametrize(("most", "whole"), [(w.MOST_CANDIDATES, w.WHOLE), (0, 7)])
def test_near_copies_in_a_large_group_are_found(docs, monkeypatch, most, whole):
    """Sixty copies, no two with 0.8 of their weights in common if each counts by itself."""
    monkeypatch.setattr(w, "MOST_CANDIDATES", most)
    monkeypatch.setattr(w, "WHOLE", whole)
    rng = random.Random(25)
    rows = [(i, text(rng, rng.randrange(10, 60))) for i in range(1, 500)]
    base = text(rng, 300)
    copies = [changed(base, 3, rng) for _ in range(60)]
    rows += [(1000 + i, t) for i, t in enumerate(copies)]
    pair = text(rng, 90)
    rows += [(2000, pair), (2001, changed(pair, 1, rng)), (2002, base[: len(base) // 3])]
    total, held = len(rows), counted(t for _, t in rows)
    weigh = w.common_shingles(docs(rows))
    shares = dict(zip(weigh.keys.tolist(), weigh.idf.tolist(), strict=True))
    assert set(shares) == {key for key, n in held.items() if n > 1}
    of_base, of_pair = (set(next(shingles([t])).tolist()) for t in (base, pair))
    in_copies = counted(copies)
    apart = counted(t for i, t in rows if not 1000 <= i < 2000)
    for key in of_base & set(shares):
        n = in_copies.get(key, 0)
        by_groups = apart.get(key, 0) + (1 + (n - 1) * w.together(60, total) if n else 0)
        assert shares[key] == pytest.approx(float(w.idf_of(np.float64(by_groups / total))), rel=1e-5)
    alone = float(w.idf_of(np.float64(1 / total)))
    assert [shares[k] for k in of_pair & set(shares)] == pytest.approx([alone] * len(of_pair & set(shares)), rel=1e-4)
    found = {r.doc_id: r.class_id for r in w.near_duplicates(docs(rows)).collect()}
    assert found == brute(rows, weigh)
    assert {found[1000 + i] for i in range(60)} == {1000} and found[2002] == 2002
    each = w.Weights(np.array(sorted(shares), np.uint64), np.array([held[k] / total for k in sorted(shares)]), total)
    sets = [each(h) for h in shingles(copies)]
    assert max(w.weighted_jaccard(sets[i], sets[j]) for i in range(60) for j in range(i)) < w.SIMILARITY


def test_samples_of_texts_that_all_or_none_share():
    """Sets of light weights only, of heavy ones only, and of one shingle."""
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
    for weight in (0.3, 1.0, 2.5):
        a, b = (keys[:600], np.full(600, weight)), (keys[100:700], np.full(600, weight))
        both = w.signatures([a, (keys[:1], np.array([weight])), b])
        agree = (both[0] == both[2]).mean()
        assert abs(agree - 500 / 700) < 4 * np.sqrt(0.2 / w.SAMPLES)
        assert (both[1] >> np.uint64(8) == keys[0] >> np.uint64(32)).all()
        names = set((keys >> np.uint64(32)).tolist())
        assert set((both >> np.uint64(8)).ravel().tolist()) <= names
