import hashlib
import zlib

import numpy as np

from rowgate.llm import sharding

SF = "/root/testdata/sf0.01"


def jump_one(key, shards):
    """The published loop, one key at a time."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def key_of(doc_id):
    text = "" if doc_id is None else str(doc_id)
    return int(hashlib.md5(text.encode()).hexdigest()[:16], 16)


def test_equals_the_published_loop_and_moves_only_to_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    for shards in (1, 2, 24, 25, 1000):
        assert sharding.jump(keys, shards).tolist() == [jump_one(int(k), shards) for k in keys]
    old, new = sharding.jump(keys, 24), sharding.jump(keys, 25)
    moved = old != new
    assert (new[moved] == 24).all() and 0.02 < moved.mean() < 0.06


def test_query_equals_brute_force(spark):
    import duckdb

    found = {r.doc_id: r for r in sharding.op7_jump_sharding(spark, SF).collect()}
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert len(found) == len(rows)
    slots = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        r = found[doc_id]
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump_one(key_of(doc_id), 24), jump_one(key_of(doc_id), 25))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edge_rows(docs, stored, spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 3)
    rows = [(1, "a"), (1, "a"), (2, None), (None, ""), (3, "x" * 200_000), *((i, "t") for i in range(10, 40))]
    found = sharding.op7_jump_sharding(spark, stored(documents=docs(rows))).collect()
    assert len(found) == len(rows)
    assert [r.size for r in found if r.doc_id == 2] == [8]
    assert {r.shard for r in found if r.doc_id is None} == {jump_one(key_of(None), 24)}
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    clash = docs([(1, "a", "en", "s", 1, "old")], ", shard string")
    assert sharding.assign(clash, "doc_id").first().shard == jump_one(key_of(1), 24)
    assert sharding.assign(docs([]), "doc_id").collect() == []


def test_equal_rows_are_numbered_by_many_tasks(spark, docs, stored, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 10)
    folder = stored(documents=docs([(None, None)] * 200 + [(1, "x")] * 50))
    found = sharding.op7_jump_sharding(spark, folder).collect()
    assert len(found) == 250
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
