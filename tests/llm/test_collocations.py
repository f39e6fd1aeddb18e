import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from rowgate.llm import collocations


def pieces_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
        yield re.findall("[^ \t]+", piece)


def brute(rows, least=30, most=2000):
    counts, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    key = lang, tuple(words[i : i + size])
                    counts[key] = counts.get(key, 0) + 1
    usual = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longer = {}
    for (lang, words), a in usual.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                longer[key] = max(longer.get(key, 0), a)
    out = {}
    for (lang, words), a in usual.items():
        if 100 * longer.get((lang, words), 0) >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, left, right, score))
    return sorted(
        (lang, rank, p.decode(), a, left, right, n[lang], score)
        for lang, found in out.items()
        for rank, (_, _, p, a, left, right, score) in enumerate(sorted(found)[:most], 1)
    )


def sample(seed, texts=120):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "É", "new york", "new york city", "a-b", "x", "ÿ z", "日本"]
    ends = [" ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "; ", "\x0b"]
    rows = []
    for i in range(texts):
        words = [draw.choice(vocabulary) + draw.choice(ends) for _ in range(draw.randrange(60))]
        rows.append((i, "".join(words), draw.choice(["en", "en", "und", None])))
    return [*rows, (None, None, "en"), (7, "", None), (8, " .. ;\n", "xx"), rows[0], rows[0]]


@pytest.mark.parametrize("budget", [collocations.BUDGET, 40])
def test_equals_brute_force_also_where_prefixes_are_extended(spark, docs, budget):
    rows = sample(1)
    frame = docs([(*r, "s", 0) for r in rows]).withColumnsRenamed({"source": "h", "n_chars": "n"})
    found = collocations.collocations(frame, least=5, budget=budget).collect()
    assert sorted(map(tuple, found)) == brute(rows, 5)
    assert len(found) > 30


def test_overlaps_ties_and_first_ranks(spark, docs):
    rows = [(1, "a a a a a a. b c. b c. d e. d e. d e f", "en")] * 3
    found = collocations.collocations(docs([(*r, "s", 0) for r in rows]), least=3, most=4).collect()
    assert sorted(map(tuple, found)) == brute(rows, 3, 4)


def test_query_and_sql_agree(spark, docs, stored):
    rows = sample(2, 200)
    folder = stored(documents=docs([(*r, "s", 0) for r in rows]))
    found = collocations.op11_collocations(spark, folder)
    with duckdb.connect() as db:
        db.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
        rows = db.sql(collocations.SQL["op11_collocations"])
        assert sorted(found.columns) == sorted(rows.columns)
        assert sorted(map(tuple, found.select(*rows.columns).collect())) == sorted(rows.fetchall())


def test_no_texts(spark, docs):
    assert collocations.collocations(docs([(1, None), (2, "")])).count() == 0
    assert collocations.collocations(docs([]).filter("false")).count() == 0


def test_long_texts_are_cut_between_words_without_a_trace(monkeypatch):
    draw = random.Random(3)
    texts = [
        "".join(draw.choice(["ab", "cde", "f"]) + draw.choice([" ", "  ", ". ", " .\n "]) for _ in range(n))
        for n in (500, 3, 0, 900, 40)
    ]
    texts.insert(2, "w" * 5000 + " end of it")
    batch = pd.DataFrame({"text": texts, "lang": ["en", "de", "en", "en", "de", "en"]})
    hashing = collocations.Hashing(0)
    whole = list(collocations._packets(iter([batch]), hashing))
    monkeypatch.setattr(collocations, "ROUND_BYTES", 60)
    monkeypatch.setattr(collocations, "PACKET_WORDS", 10)
    cut = list(collocations._packets(iter([batch]), hashing))
    assert len(whole) == 1 and len(cut) > 2
    for k in (0, 1):
        assert np.array_equal(whole[0][k], np.concatenate([x[k] for x in cut]))


def test_words_that_share_a_hash_draw_another_function(spark, docs, monkeypatch):
    """The first hash function here is blind to words: all share one hash."""
    real = collocations.Hashing
    rows = sample(4)
    monkeypatch.setattr(collocations, "Hashing", lambda seed: _blinded(real(seed)))
    words, hashing = collocations.word_table(docs([(*r, "s", 0) for r in rows]))
    assert hashing.seed == 1
    assert words.count() == words.select("lang", "word").distinct().count()


def _blinded(hashing):
    if hashing.seed == 0:
        hashing.byte = hashing.byte * np.uint64(0)
    return hashing
