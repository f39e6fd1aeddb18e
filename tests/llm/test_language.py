import math
import zlib

import duckdb
import pytest

from rowgate.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = language.op4_centroid_language(spark, SF).toPandas()
    truth = duckdb.sql(f"select doc_id, lang, text from '{SF}/documents.parquet'").df()
    both = found.merge(truth, on="doc_id")
    assert len(found) == len(truth)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert both.score.between(0, 1).all()
    assert both.rejected.mean() < 0.01


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_edge_rows(docs, model):
    rows = [(1, None), (2, ""), (3, "123 ,.;"), (4, "Привет, как дела сегодня вечером?" * 20), (None, "the and of with that"),
            (6, "the thing is on the " * 20_000), (6, "the thing is on the " * 20_000)]
    found = language.predicted(docs(rows), model).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for i in (1, 2, 3):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[4].rejected and not by_id[6].rejected
    assert by_id[6].lang_pred == "en"
    clash = docs([(1, "the and of", "en", "s", 1, "x")], ", score string")
    assert isinstance(language.predicted(clash, model).first().score, float)
    assert language.predicted(docs([]), model).collect() == []


def test_nothing_to_learn_from(docs):
    nothing = docs([(1, "text", None, "s", 4), (2, "more", None, "s", 4)])
    fitted = language.fit(nothing)
    assert {r.lang_pred for r in language.predicted(nothing, fitted).collect()} == {"und"}


@pytest.mark.parametrize("out", ["de", "en", "es", "fr"])
def test_a_language_that_was_left_out_is_rejected(spark, out):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fitted = language.fit(docs.filter(f"lang <> '{out}'"))
    rows = docs.select("text", "lang", language.bucket_of(docs.doc_id).alias("bucket")).collect()
    unknown = [fitted.predict(r.text)[2] for r in rows if r.lang == out]
    known = [fitted.predict(r.text)[2] for r in rows if r.lang not in (out, None) and r.bucket == 2]
    assert sum(unknown) > 0.9 * len(unknown)
    assert sum(known) < 0.01 * len(known)


def test_predictions_equal_a_slow_nearest_centroid(spark, model):
    """Dictionaries of n-grams, hashed one by one, against every centroid."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    for row in rows:
        raw = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in f" {row.text.lower()} ".encode())
        counts = {}
        for size in (2, 3):
            for i in range(len(raw) - size + 1):
                gram = raw[i : i + size]
                if b"  " in gram:
                    continue
                code = int.from_bytes(gram, "big") + (1 << 24 if size == 2 else 0)
                code = code * 0x9E3779B1 % 2**32
                place = (code ^ code >> 15) % language.FEATURES
                counts[place] = counts.get(place, 0) + 1
        weights = {k: math.log1p(n) * float(model.idf[k]) for k, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        cosines = [sum(v * float(c[k]) for k, v in weights.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=lambda i: cosines[i])
        lang, score, _ = model.predict(row.text)
        assert score == pytest.approx(cosines[best], abs=1e-4)
        assert lang == model.languages[model.owners[best]] or sorted(cosines)[-2] > cosines[best] - 1e-4


def test_rows_of_one_id_are_learned_within_the_bound(docs):
    one = [(None, f"the word and number {i} of it", "en", "s", 1) for i in range(50)]
    same = [(1, "der die das und nicht", "de", "s", 1)] * 50
    sample = language.sampled(docs(one + same), 20).toPandas()
    assert set(sample["lang"]) == {"de", "en"} and sample.groupby("lang").size().max() <= 20
    found = language.fit(docs([*one, *same, (8, "x", "en", "s", 1)]))
    assert set(found.languages) == {"de", "en"}
