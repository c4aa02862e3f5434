"""The pipeline's stages, one after the other, each held against a plain definition of what it may drop."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from rowmill.llm.common import table, written
from rowmill.llm.simhash import fingerprint_of

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, FOLDER, "documents")
    out = [("documents", docs.toPandas())]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), name)
        out.append((name, docs.toPandas()))
    return dict(out)


def test_registered():
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_columns(stages):
    names = list(stages["documents"].columns)
    assert all(list(stages[s].columns) == names for s in ("quality", "near_duplicates", "decontamination", "mixing"))
    assert list(stages["sharding"].columns) == [*names, "shard", "slot"]


def test_quality_keeps_good_and_drops_bad(stages):
    kept, labels = set(stages["quality"].doc_id), pd.read_parquet(f"{FOLDER}/labels.parquet")
    good, bad = set(labels.doc_id[labels.quality == 1]), set(labels.doc_id[labels.quality == 0])
    assert len(good & kept) >= 0.99 * len(good) and len(bad & kept) <= 0.1 * len(bad)


def test_near_duplicates_leave_one_of_each_group(stages):
    """The smallest id of each component of fingerprints within three bits."""
    before, after = stages["quality"], set(stages["near_duplicates"].doc_id)
    prints = {i: fingerprint_of(t.encode()) for i, t in zip(before.doc_id, before.text)}
    ids = sorted(prints)
    group = {i: i for i in ids}
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert len(set(group.values())) < len(ids) and after == set(group.values())
    assert before.text[before.doc_id.isin(after)].is_unique


def test_decontamination_drops_just_what_holds_a_passage(stages):
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [words(t) for t in pd.read_parquet(f"{FOLDER}/benchmark.parquet").text]
    before, after = stages["near_duplicates"], set(stages["decontamination"].doc_id)
    holds = {i for i, t in zip(before.doc_id, before.text) if any(x in words(t) for x in items)}
    assert holds and after == set(before.doc_id) - holds


def test_mix_and_shards(stages):
    before, mixed, sharded = stages["decontamination"], stages["mixing"], stages["sharding"]
    assert set(mixed.doc_id) < set(before.doc_id) and mixed.doc_id.is_unique
    tokens = lambda d: sum(-(-len(t.encode()) // 4) for t in d.text)
    assert 0.85 * tokens(before) <= tokens(mixed) <= 0.9 * tokens(before)
    assert sorted(sharded.doc_id) == sorted(mixed.doc_id)
    sizes = sharded.assign(b=[len(t.encode()) + 16 for t in sharded.text]).groupby("shard").b.agg(["sum", "max"])
    assert list(sizes.index) == list(range(40))
    assert (sizes["sum"] - sizes["sum"].mean()).abs().max() <= sizes["max"].max()


def test_stages_with_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, row string, fp string"
    rows = [(None, None, None, None, None, None, None, None)] * 2 + [(1, "", "en", "src0", 0, "s", "r", "f")] * 3 + [(2, "some words of text here", "xx", "odd", 5, "s", "r", "f")]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            assert set(out.columns) == set(docs.columns) | ({"slot"} if name == "sharding" else set())
            if name == "sharding":
                assert out.count() == docs.count()
            if name == "near_duplicates":
                assert out.count() == (2 if docs.count() else 0)


def test_columns_of_the_caller_stay(spark):
    """Columns named like the operators' own come through every stage with their values."""
    names = ["kept", "log_weight", "draw_key", "epoch", "document", "row", "id", "text_", "f0", "at", "tie", "leaf", "size", "key", "of"]
    docs = table(spark, FOLDER, "documents").limit(60)
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), name)
        assert docs.count() and docs.where(" OR ".join(f"{n} <> concat('{n} ', doc_id)" for n in names)).isEmpty(), name


def test_run(spark, stages):
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()]
    assert sorted(ids) == sorted(stages["sharding"].doc_id)
