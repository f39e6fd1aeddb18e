import random
import re

import corpus_pipeline
from __spark_entry__ import queries
from rowgate.llm import decontamination, language, mixing, sharding, weighted_minhash

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = {name.split("_")[0] for name in queries() if re.match(r"op\d+_", name)}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "sharding",
    ]


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = frames[name] = stage(spark, docs, SF)
        if name != "sharding":
            assert docs.columns == columns
    ids = {name: [r.doc_id for r in frame.collect()] for name, frame in frames.items()}

    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sorted(ids["language"]) == sorted(i for i, r in before.items() if not model.predict(r.text)[2])
    classes = {r.doc_id: r.class_id for r in weighted_minhash.near_duplicates(frames["language"]).collect()}
    assert sorted(ids["near_duplicates"]) == sorted(set(classes.values()))
    dirty = {r.doc_id for r in decontamination.contaminated(frames["near_duplicates"], benchmark).collect()}
    assert dirty, "the table holds passages of the benchmark"
    assert set(ids["decontamination"]) == set(ids["near_duplicates"]) - dirty
    rates = mixing.tempered_rates(frames["decontamination"])
    assert sorted(ids["mixing"]) == sorted(
        r.doc_id for r in mixing.mixed(frames["decontamination"], rates).collect()
    )
    final = frames["sharding"].collect()
    assert sorted(r.doc_id for r in final) == sorted(ids["mixing"])
    place = {r.doc_id: r.shard for r in sharding.assign(frames["decontamination"], "doc_id").collect()}
    assert all(r.shard == place[r.doc_id] and r.text == before[r.doc_id].text for r in final)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(ids["mixing"])


def test_edge_rows_go_through_every_stage(spark, docs, stored):
    rng = random.Random(2)
    item = " ".join(f"item{i}" for i in range(20))
    some = "the and of with that this from was " * 5
    rows = [(1, some), (1, some), (2, some), (None, some), (None, None), (3, None), (4, ""), (5, "w " * 100_000)]
    rows += [(6, item), (None, item), (7, " ".join(f"a{rng.randrange(99)}" for _ in range(50)))]
    frame = docs(rows)
    folder = stored(benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    kept = dict(corpus_pipeline.STAGES)
    once = kept["near_duplicates"](spark, frame, folder).collect()
    assert sorted((r.doc_id for r in once), key=str) == sorted([1, None, 5, 6, 7], key=str)
    # Rows of one id are judged by their own texts, and columns may have any name.
    twice = docs([(1, some, "en", "s", 3, 0), (1, item, "en", "s", 4, 0), (2, some, "en", "s", 5, 0)], ", count long")
    assert sorted(r.n_chars for r in kept["near_duplicates"](spark, twice, folder).collect()) == [3, 4]
    clean = kept["decontamination"](spark, frame, folder).collect()
    assert sorted((r.doc_id for r in clean), key=str) == sorted([1, 1, 2, None, None, 3, 4, 5, 7], key=str)
    empty = docs([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == [], name


def test_nothing_else_imports_the_operators():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for source in root.rglob("*.py"):
        if "llm" in source.parts or source.name in ("__spark_entry__.py", "corpus_pipeline.py"):
            continue
        assert "rowgate.llm" not in source.read_text(), source
