"""The pipeline's stages on small inputs, each against what its operator is tested for, and the contract's guard."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.samples import awkward, documents, words
from tidedesk.llm.common import DOCUMENT_COLUMNS
from tidedesk.llm.quality import quality_rules
from tidedesk.llm.simhash import near_duplicates

ROOT = Path(__file__).resolve().parents[2]


def folder(spark, tmp_path, docs, items=()):
    docs.select(DOCUMENT_COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_every_stage_takes_effect(spark, tmp_path):
    leak = words(900, 40)
    rows = [(n, words(n, 90), "en", "big" if n < 120 else "small") for n in range(130)]
    rows += [(200, words(0, 90), "en", "big"), (201, words(1, 90), "en", "big"), (202, "too short", "en", "big")]
    rows += [(203, f"{words(300, 60)} {leak} {words(301, 60)}", "en", "big")]
    docs = documents(spark, rows)
    sf_dir = folder(spark, tmp_path, docs, [(1, leak)])
    kept = corpus_pipeline.keep_quality(spark, docs, sf_dir)
    assert ids(kept) == sorted(set(r[0] for r in rows) - {202}) and kept.columns == DOCUMENT_COLUMNS
    single = corpus_pipeline.keep_one_of_each_group(spark, kept, sf_dir)
    assert ids(single) == [*range(130), 203] and single.columns == DOCUMENT_COLUMNS
    clean = corpus_pipeline.drop_benchmark_leaks(spark, single, sf_dir)
    assert ids(clean) == list(range(130)) and clean.columns == DOCUMENT_COLUMNS
    mixed = corpus_pipeline.mix(spark, clean, sf_dir)
    assert mixed.columns == DOCUMENT_COLUMNS
    drawn = Counter(r["doc_id"] for r in mixed.collect())
    assert max(drawn.values()) == 2 and all(n >= 120 for n, k in drawn.items() if k == 2)
    sharded = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in sharded) == drawn


def test_one_document_of_each_group_stays(spark):
    docs = awkward(spark)
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()
    groups = {(r["component_id"], r["fp"] if r["component_id"] is None else None) for r in near_duplicates(docs, ["doc_id"]).collect()}
    assert len(kept) == len(groups)
    assert Counter(r["doc_id"] for r in kept) == Counter(c for c, _ in groups)


def test_texts_that_share_an_id_are_kept_apart(spark):
    rows = [(7, words(8, 100)), (7, words(9, 100)), (7, words(8, 100)), (9, words(9, 100))]
    kept = corpus_pipeline.keep_one_of_each_group(spark, documents(spark, rows), "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(7, words(8, 100)), (7, words(9, 100))])


def test_short_benchmark_items_drop_whole_copies_only(spark, tmp_path):
    leak = words(900, 12)
    rows = [(1, f"the {words(1, 40)} und"), (2, "The."), (3, f"{words(2, 40)} {leak}"), (4, ""), (5, None), (6, words(3, 40))]
    docs = documents(spark, rows)
    sf_dir = folder(spark, tmp_path, docs, [(1, "the"), (2, "und"), (3, leak), (4, ""), (5, None)])
    assert ids(corpus_pipeline.drop_benchmark_leaks(spark, docs, sf_dir)) == [1, 4, 5, 6]


def test_quality_stage_keeps_what_the_operator_keeps(spark):
    docs = awkward(spark)
    judged = quality_rules(docs, ["doc_id"]).collect()
    kept = corpus_pipeline.keep_quality(spark, docs, "").collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in judged if r["kept"])


def test_awkward_rows_and_empty_table(spark, tmp_path):
    full = folder(spark, tmp_path / "full", awkward(spark), [(1, words(1, 80)), (2, None)])
    out = corpus_pipeline.run(spark, full).collect()
    # Equal texts leave one document each; those with the benchmark's text, too few words or repeats alone go.
    assert {r["doc_id"] for r in out} == {None, 6, 8}
    empty = folder(spark, tmp_path / "empty", documents(spark, []))
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_registered_and_guarded(tmp_path):
    names = set(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "SimHash near-dedup" and len(corpus_pipeline.STAGES) == 5
    (tmp_path / "tidedesk_checks").symlink_to(ROOT / "tidedesk_checks")
    (tmp_path / "tidedesk").mkdir()
    for item in (ROOT / "tidedesk").iterdir():
        if item.name != "llm":
            (tmp_path / "tidedesk" / item.name).symlink_to(item)
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    script = "import __spark_entry__ as e; print(sum(k.startswith('op') or k == 'pipeline' for k in e.queries()), len(e.queries()) > 40)"
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["0", "True"], done.stderr
