import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from rowgate.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   ", "▁", "▁ ▁", "a", "</s>", "<s>x", "<0x0A>", "\n\n\t", "\x00", "日本 語", "🙂🙂 é ß", "﻿�",
    "x" * 4000, "ab" * 2500, " " * 999, "é" * 300, "aaaab" * 200, "The end.  Two  spaces ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return pieces.Model(file.read())


def test_encodes_and_decodes_as_the_library(library, model):
    draw = random.Random(12)
    letters = "aabcdeeefghiiklmnoorsttuuwxyz   ▁\n0123456789éüß日🙂"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(3000)]
    texts += ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(500)) for _ in range(20)]
    for text in [*texts, *(t or "" for t in ODD)]:
        ids = model.encode(text)
        assert ids == library.encode(text, add_eos=True)
        assert model.decode(ids) == library.decode(ids)


def test_whole_text_as_one_word_gives_the_same(library, model):
    with open(PATH, "rb") as file:
        whole = pieces.Model(file.read())
    whole.by_word = False
    text = "the quick brown fox  jumps over the lazy dog, again and again. " * 40
    assert whole.encode(text) == library.encode(text, add_eos=True)


def test_decodes_any_ids_as_the_library(library, model):
    draw = random.Random(13)
    for _ in range(3000):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(259)]) for _ in range(draw.randrange(12))]
        assert model.decode(ids) == library.decode(ids)


def test_steps_back_from_failed_places(model):
    """Some longest matches lead nowhere, so the walk must return from them."""
    draw, steps = random.Random(14), 0
    for _ in range(300):
        text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60))
        ids = model.walked(text)
        at = 0
        for piece in ids:
            longest = max(n for n in range(1, 20) if text[at : at + n] in model.ids)
            steps += longest != model.lengths[piece]
            at += model.lengths[piece]
    assert steps > 100


def test_query_reads_whole_texts_and_keeps_repeated_rows(spark, docs, stored, library):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(1, ""), (None, "a b " * 20000)]
    folder = stored(documents=docs([(*r, "en", "s", 0, 1, 2) for r in rows], ", ids long, decoded long"))
    found = pieces.op12_pieces(spark, folder).collect()

    def expected(doc_id, text):
        ids = library.encode(text or "", add_eos=True)
        named = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        return doc_id, len(ids), named, hashlib.sha256(library.decode(ids).encode()).hexdigest()

    assert sorted(map(str, map(tuple, found))) == sorted(str(expected(*r)) for r in rows)


def test_columns_of_the_same_names_give_way(spark, docs):
    model = pieces.shared_model(spark, PATH)
    frame = docs([(1, "hello there", "en", "s", 0, 7, 8)], ", ids long, decoded long")
    row = pieces.decoded(pieces.encoded(frame, model), model).first()
    assert row["decoded"] == "hello there" and len(row["ids"]) > 1
    assert pieces.encoded(docs([]).filter("false"), model).count() == 0


def test_other_kinds_of_models_are_refused():
    with open(PATH, "rb") as file:
        raw = file.read()
    unused = b"\x0a\x06\x0a\x02zz\x18\x05"
    with pytest.raises(ValueError):
        pieces.Model(raw + unused)
