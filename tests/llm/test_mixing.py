import math

import pytest
from pyspark.sql import functions as F

from rowgate.llm import mixing


def quantile(u, rate):
    k, term = 0, math.exp(-rate)
    below = term
    while below <= u:
        k += 1
        term *= rate / k
        below += term
    return k


@pytest.mark.parametrize("rate", [0.05, 0.7, 1.0, 3.5, 40.0, 180.0])
def test_quantile_inverts_the_distribution(spark, rate):
    us = [i / 200 + 0.001 for i in range(200)]
    rows = spark.createDataFrame([(u,) for u in us], "u double")
    found = rows.select(mixing.poisson_quantile(F.col("u"), F.lit(rate)).alias("k")).collect()
    assert [r.k for r in found] == [quantile(u, rate) for u in us]


@pytest.mark.parametrize("rate", [0.3, 2.0, 650.0])
def test_mean_and_variance(spark, rate):
    keys = spark.range(2000).select(mixing.copies("s", F.col("id").cast("string"), F.lit(rate)).alias("k"))
    mean, variance = keys.agg(F.avg("k"), F.var_samp("k")).first()
    assert abs(mean - rate) < 5 * math.sqrt(rate / 2000)
    assert abs(variance / rate - 1) < 0.2


def test_rates_reach_the_target_weights(spark, docs):
    rows = [(i, "x" * (90 if i % 3 else 10), "en", "big" if i % 3 else None, 1) for i in range(300)]
    sizes = spark.createDataFrame([("big", 18000.0), (None, 1000.0), ("gone", 0.0)], "source string, bytes double")
    weights = spark.createDataFrame([("big", 1.0), (None, 1.0)], "source string, weight double")
    rates = {r.source: r.rate for r in mixing.rates_for(sizes, weights).collect()}
    assert rates["big"] == pytest.approx(0.5 * 19000 / 18000)
    assert rates[None] == pytest.approx(0.5 * 19000 / 1000)
    assert rates["gone"] == 1.0
    tempered = {r.source: r.rate for r in mixing.tempered_rates(docs(rows), 1.0).collect()}
    assert tempered == {"big": pytest.approx(1.0), None: pytest.approx(1.0)}


def test_same_draw_again_whole_rows_and_edges(spark, docs):
    rows = [(i, f"text {i}", "en", "s", 6) for i in range(200)]
    rows += [(None, None, None, None, None), (5, "text 5", "en", "s", 6), (900, "long " * 100_000, "en", "s", 1)]
    frame = docs(rows).withColumn("copy", F.lit("old"))
    rates = spark.createDataFrame([("s", 1.5), (None, 3.0)], "source string, rate double")
    one, two = (mixing.mixed(frame, rates).collect() for _ in range(2))
    assert sorted(map(str, one)) == sorted(map(str, two))
    by_id = {}
    for r in one:
        by_id.setdefault(r.doc_id, []).append(r.copy)
        assert r.doc_id is None or r.text == rows[[x[0] for x in rows].index(r.doc_id)][1]
    for key, copies in by_id.items():
        twice = 2 if key == 5 else 1
        assert sorted(copies) == sorted(list(range(len(copies) // twice)) * twice)
    assert abs(sum(map(len, by_id.values())) - 1.5 * 202) < 80
    other = mixing.mixed(frame, rates, seed="other").collect()
    assert sorted(map(str, one)) != sorted(map(str, other))
    assert mixing.mixed(docs([]), rates).collect() == []


def test_columns_may_have_any_names_and_weights_may_be_missing(spark, docs):
    rows = [(i, "a b c", "en", f"s{i % 2}", 5, i, "x", 2.0, 3) for i in range(40)]
    frame = docs(rows, ", _rate long, rate string, of double, copies int")
    sizes = frame.groupBy("source").agg(F.count("*").cast("double").alias("bytes"))
    none = spark.createDataFrame([("s0", 0.0)], "source string, weight double")
    rates = mixing.rates_for(sizes, none)
    assert {r.rate for r in rates.collect()} == {1.0}
    found = mixing.mixed(frame, rates)
    assert found.columns == [*frame.columns, "copy", "shuffle_key"]
    assert all((r["_rate"], r.rate, r.of, r.copies) == (r.doc_id, "x", 2.0, 3) for r in found.collect())
