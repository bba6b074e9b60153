import zlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.samples import awkward, documents
from tidedesk.llm.sharding import even_tree, shard_documents, shard_of


def test_rows_sizes_slots_and_growth(spark):
    docs = awkward(spark).unionByName(documents(spark, [(n, "t") for n in range(100, 2100)]))
    out = shard_documents(docs, even_tree(8), even_tree(8, grown=1)).collect()
    assert len(out) == docs.count()
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert texts == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out)
    for shard in range(8):
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots))) and 150 < len(slots) < 350
    assert all(r["grown_shard"] in (r["shard"], 8) for r in out)
    assert 100 < sum(r["grown_shard"] == 8 for r in out) < 350
    by_id = {}
    for r in out:
        assert by_id.setdefault(r["doc_id"], r["shard"]) == r["shard"]


def test_weights_and_confined_moves(spark):
    tree = {"a": {"x": {0: 1.0, 1: 3.0}, "y": {2: 4.0}}, "b": {"z": {3: 8.0}}}
    moved = {"a": {"x": {0: 3.0, 1: 1.0}, "y": {2: 4.0}}, "b": {"z": {3: 8.0}}}
    rows = spark.range(20_000).select(shard_of([F.col("id")], tree).alias("s"), shard_of([F.col("id")], moved).alias("t")).collect()
    counts = Counter(r["s"] for r in rows)
    for shard, share in {0: 1 / 16, 1: 3 / 16, 2: 1 / 4, 3: 1 / 2}.items():
        assert abs(counts[shard] / 20_000 - share) < 0.02
    # Weights change inside rack x only; so do places.
    assert all(r["s"] == r["t"] or {r["s"], r["t"]} == {0, 1} for r in rows)
    assert any(r["s"] != r["t"] for r in rows)


def test_empty_table(spark):
    assert shard_documents(documents(spark, []), even_tree(8)).count() == 0
