import random
import re
from collections import Counter
from zlib import crc32

import pytest

from rowgate.llm import spelling


def brute_words(rows, slips=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            code = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if code % slips == 0:
                at = code % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(words):
    forms, out = {}, []
    for w, n in words.items():
        near = [v for v in words if is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
        out.append((w, n, len(near)))
    rows = []
    for w, n, k in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, forms[w], root, n, k, words[forms[w]] if forms[w] else None))
    return sorted(rows, key=str)


def found(frame):
    return sorted(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def edited(draw, word, letters):
    i = draw.randrange(len(word) + 1)
    kind = draw.randrange(3)
    if kind == 0:
        return word[:i] + draw.choice(letters) + word[i:]
    return word[:i] + (draw.choice(letters) if kind == 1 else "") + word[i + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abcd", "abcdefghijéÿ"])
def test_near_words_always_meet_in_a_list(letters):
    draw = random.Random(len(letters))
    frequent = {}
    for size in range(2, spelling.LONGEST):
        for _ in range(draw.choice([5, 40, 300])):
            frequent["".join(draw.choice(letters) for _ in range(size))] = draw.randrange(1, 9)
    for _ in range(6000):
        word = "".join(draw.choice(letters) for _ in range(draw.randrange(7, 18)))
        other = edited(draw, word, letters)
        if len(other) < 7 or other == word:
            continue
        lists = [set(spelling.merged_lists(w, 7, frequent)) for w in (word, other)]
        kinds = {kind for kind, _, _ in lists[0] & lists[1]}
        assert (spelling.SAME in kinds) if len(word) == len(other) else kinds & {1, 2}


@pytest.mark.parametrize("block", [spelling.BLOCK, 7])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    draw = random.Random(5)
    words, letters = {}, "abceé"
    for _ in range(40):
        words["".join(draw.choice(letters) for _ in range(draw.randrange(7, 12)))] = draw.randrange(2, 3000)
    for _ in range(300):
        word = edited(draw, draw.choice(list(words)), letters)
        if len(word) >= 7:
            words.setdefault(word, draw.choice([2, 2, 3, 20, 200, 2000]))
    words["abcabca" * 300] = 2
    words["abcabca" * 300 + "b"] = 30
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.grouped_variants(frame)) == brute(words)


def test_query_reads_whole_texts(spark, docs, stored):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choice("abcdehéÉA") for _ in range(draw.randrange(4, 11))) for _ in range(60)]
    rows = [(i, " ".join(draw.choice(vocabulary) for _ in range(120))) for i in range(60)]
    rows += [(None, "Wordsabc-wordsabc"), (3, None), (4, ""), (5, "123 ..."), (1, rows[1][1]), (8, "longlong " * 30000)]
    folder = stored(documents=docs([(*r, "en", "s", 0, "w", 1) for r in rows], ", word string, n long"))
    expected = brute(brute_words(rows))
    assert len([r for r in expected if r[1]]) > 10
    assert found(spelling.op13_spelling_variants(spark, folder)) == expected


def test_no_words(spark, docs, stored):
    folder = stored(documents=docs([(1, ""), (2, None)]))
    assert spelling.op13_spelling_variants(spark, folder).count() == 0


def test_too_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        spelling.near_words(spark.createDataFrame([("abcd", 2)], "word string, n long"), 4)
