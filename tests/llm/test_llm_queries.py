"""The registered queries against their SQL, or against plain Python where SQL cannot say it."""

import html
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from compare import canonical, duck

from rowmill.llm import plans
from rowmill.llm.licences import TEMPLATES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_against_sql(spark, database, name):
    result = plans.QUERIES[name](spark, FOLDER)
    expected = database.execute(plans.ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert canonical(result.columns, result.collect()) == canonical(columns, expected.fetchall())


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in plans.QUERIES)
    assert numbers == list(range(1, 14))


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(ids: list, linked) -> dict:
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_simhash_by_brute_force(spark, documents):
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in plans.QUERIES["op2_simhash"](spark, FOLDER).collect()}
    prints = {i: brute_fingerprint(t) for i, t in zip(documents.doc_id, documents.text)}
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = components(ids, links)
    assert found == {i: (f"{prints[i]:016x}", expected[i]) for i in ids}


def test_quality_tells_labelled_documents_apart(spark):
    """Over all labelled documents at most a few of each kind are judged against their label."""
    folder = "/root/testdata/sf0.01"
    kept = {r["doc_id"]: r["kept"] for r in plans.QUERIES["op3_quality"](spark, folder).collect()}
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    good = [kept[i] for i in labels.doc_id[labels.quality == 1]]
    bad = [kept[i] for i in labels.doc_id[labels.quality == 0]]
    assert len(kept) == 1000
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_licences_by_whole_search(spark, documents):
    found = {(r["doc_id"], r["licence"]) for r in plans.QUERIES["op4_licences"](spark, FOLDER).collect()}
    squeeze = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    expected = {
        (i, name) for i, t in zip(documents.doc_id, documents.text) for name, s in TEMPLATES.items() if squeeze(s) in squeeze(t)
    }
    assert expected and found == expected


def test_decontamination_finds_every_planted_item(spark, documents):
    found = {(r["doc_id"], r["item_id"]) for r in plans.QUERIES["op7_decontamination"](spark, FOLDER).collect()}
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    windows = defaultdict(set)
    benchmark = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    for item, text in zip(benchmark.item_id, benchmark.text):
        own = words(text)
        for k in range(len(own) - 12):
            windows[tuple(own[k : k + 13])].add(item)
    expected = set()
    for i, text in zip(documents.doc_id, documents.text):
        own = words(text)
        for k in range(len(own) - 12):
            expected |= {(i, item) for item in windows.get(tuple(own[k : k + 13]), ())}
    assert expected and found == expected


def test_html_text_is_the_article(spark):
    rows = plans.QUERIES["op9_html_text"](spark, FOLDER).collect()
    pages = pd.read_parquet(f"{FOLDER}/pages.parquet").set_index("page_id")
    assert len(rows) == len(pages)
    for row in rows:
        page = pages.html[row["page_id"]]
        article = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert row["text"] == "\n".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"]) and row["url"] == pages.url[row["page_id"]]


def test_secrets_that_are_planted(spark):
    folder = "/root/testdata/sf0.01"
    rows = plans.QUERIES["op10_secrets"](spark, folder).collect()
    documents = pd.read_parquet(f"{folder}/documents.parquet").set_index("doc_id").text
    planted = re.compile(r"""\b(?:AKIA[0-9A-Z]{16}|password=[0-9a-f]{16,}|token = "[0-9a-f]{40}")""", re.I)
    expected = {i for i, t in documents.items() if planted.search(t)}
    secret = {r["doc_id"] for r in rows if r["secret"]}
    assert expected and expected <= secret
    assert len(secret - expected) <= 0.02 * len(rows)


def test_embeddings_with_odd_values(spark, tmp_path):
    rows = [(0, [1.0, 2.0]), (20, [0.5, -0.01]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [float("inf"), 1.0]), (5, [1.0, 2.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = plans.QUERIES["op6_top_k"](spark, str(tmp_path)).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (0, 1, 5, 64 * 64 + 128 * 128), (0, 2, 20, 64 * 32 - 128), (20, 1, 0, 64 * 32 - 128), (20, 2, 5, 64 * 32 - 128),
    ]


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table in ("documents", "pages", "labels", "benchmark", "embeddings", "conversations"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert plans.QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_nulls_repeats_and_other_columns(spark, tmp_path, name):
    """Null in any column, rows twice, and columns that are named like the operators' own."""
    from pyspark.sql import functions as F

    for table in ("documents", "pages", "labels", "benchmark", "embeddings", "conversations"):
        some = spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(60)
        nulls = some.limit(8).select(*(F.when(F.expr(f"{k} <> pmod(hash(*), 3)"), F.col(c)).alias(c) for k, c in enumerate(some.columns)))
        empty = some.limit(1).select(*(F.lit(None).cast(t).alias(c) for c, t in some.dtypes))
        rows = some.union(some.limit(5)).union(nulls).union(empty)
        for extra in ("id", "row", "shard", "slot", "at", "size", "part", "fp", "kept", "host", "leaf", "epoch", "of", "key", "path"):
            rows = rows.withColumn(extra, F.lit("x"))
        rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    count = plans.QUERIES[name](spark, str(tmp_path)).count()
    per_row = {"op1_url_filter": "pages", "op2_simhash": "documents", "op3_quality": "documents", "op5_sharding": "documents", "op9_html_text": "pages"}
    if name in per_row:
        assert count == spark.read.parquet(str(tmp_path / f"{per_row[name]}.parquet")).count()


def test_bit_arithmetic_of_the_fingerprint():
    assert np.bitwise_count(np.uint64(brute_fingerprint("a b c") ^ xxhash.xxh64_intdigest(b"a b c", 42))) == 0
