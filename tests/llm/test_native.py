"""URL reputation, sharding and mixing."""

import random
from collections import defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from rowmill.llm import plans
from rowmill.llm.mixing import leaf_budgets, mix
from rowmill.llm.sharding import row_bytes, shard_by_bytes
from rowmill.llm.url_reputation import domain_of, host_of, judge_urls, path_of, posteriors, suffix_of


def test_parts_of_urls(spark):
    urls = ["HTTPS://A.Example.ORG:80/x/Y?q#f", "http://h?x=/a", "no scheme/at all", None, "", "a://", "x://ÄB.com#/z", "p://q://r/s", "http://h\n/x\ny"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(host_of(F.col("u")), path_of(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == [
        ("a.example.org:80", "/x/Y"), ("h", ""), ("", ""), ("", ""), ("", ""), ("", ""), ("Äb.com", ""), ("q:", "//r/s"), ("h\n", "/x\ny"),
    ]
    hosts = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.y.example.com",), ("localhost",), ("",)], "h string")
    found = hosts.select(domain_of(F.col("h")), suffix_of(F.col("h"))).collect()
    assert [tuple(r) for r in found] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("example.com", "com"), ("localhost", "localhost"), ("", ""),
    ]


def test_rules_and_reputation(spark):
    urls = ["http://example.org/en/12", "http://www.example.org/en/2", "http://notexample.org/es/", "http://example.org/es", "http://x.com/de/1",
            "http://x.com/fr/1", "http://bad.net/1", "http://good.net/1", "http://new.net/1", None, "http://org/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.union(spark.createDataFrame([(100 + k, f"http://{h}.net/{k}") for h in ("bad", "good") for k in range(40)], pages.schema))
    labels = [(100 + k, h == "good") for h in ("bad", "good") for k in range(40)]
    labels = spark.createDataFrame(labels[:40] + [(i, g) for i, g in labels[40:]] + [(None, True), (3, None)], "id long, good boolean")
    # the ids of both hosts are the same forty, so give the good host others
    pages = pages.withColumn("page_id", F.when(F.col("url").startswith("http://good.net/") & (F.col("page_id") >= 100), F.col("page_id") + 100).otherwise(F.col("page_id")))
    labels = labels.withColumn("id", F.when(F.col("good"), F.col("id") + 100).otherwise(F.col("id")))
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(pages, labels, plans.URL_RULES, least=0.6).collect()}
    assert [found[k] for k in range(8)] == [
        ("example.org/en/1", "block"), ("org/", "allow"), ("org/", "allow"), ("org/", "allow"),
        ("com/de/", "block"), ("com/fr/", "allow"), (None, "block"), (None, "allow"),
    ]
    assert found[8][0] is None and found[9][0] is None and found[10] == ("org/", "allow")
    assert len(found) == len(urls) + 80


def test_shrinkage_follows_the_evidence(spark):
    hosts = [("a.one.com", 2, 0), ("b.one.com", 500, 0), ("c.two.com", 2, 2), ("d.two.com", 500, 500), ("e.two.com", 0, 0)]
    found = {r["host"]: r for r in posteriors(spark.createDataFrame(hosts, "host string, pages long, good long"), 1.645).collect()}
    assert found["b.one.com"]["mean"] < found["a.one.com"]["mean"] < found["c.two.com"]["mean"] < found["d.two.com"]["mean"]
    assert found["a.one.com"]["mean"] < found["e.two.com"]["mean"]  # an unlabelled host is judged by its domain
    assert found["d.two.com"]["bound"] > found["c.two.com"]["bound"] > found["e.two.com"]["bound"]
    assert posteriors(spark.createDataFrame([], "host string, pages long, good long"), 1.0).count() == 0


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_shards_are_contiguous_and_even(spark, shards):
    rng = random.Random(shards)
    rows = [(rng.choice([None, *range(50)]), "x" * rng.choice([0, 1, 10, 500]), "keep", k) for k in range(400)] + [(7, None, "keep", 1)] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, n long").repartition(5)
    out = shard_by_bytes(df, shards, row_bytes(F.col("text")), [F.col("doc_id"), F.col("n")])
    assert out.columns == ["doc_id", "text", "n", "shard", "slot"]
    found = [r.asDict() for r in out.collect()]
    assert len(found) == 600
    order = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    keys = [(-1 if r["doc_id"] is None else r["doc_id"], r["n"]) for r in order]
    assert keys == sorted(keys)
    sizes = defaultdict(list)
    for r in order:
        sizes[r["shard"]].append(len(r["text"] or "") + 16)
        assert r["slot"] == len(sizes[r["shard"]]) - 1
    target = sum(map(sum, sizes.values())) / shards
    assert all(abs(sum(s) - target) <= 516 for s in sizes.values())


def test_sizes_of_nothing(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    out = shard_by_bytes(rows, 4, F.lit(0), [F.col("id")]).collect()
    assert sorted((r["id"], r["shard"], r["slot"]) for r in out) == [(1, 0, 0), (2, 0, 1)]
    with pytest.raises(ValueError):
        shard_by_bytes(rows, 0, F.lit(1), [F.col("id")])


def share_out(budget, children):
    """Budgets by repeated sharing: whoever is full leaves, and what it does not take is shared again."""
    given, open_ = dict.fromkeys(children, 0.0), {c for c, (w, cap) in children.items() if w > 0 and cap > 0}
    while open_ and budget > 1e-9:
        total = sum(children[c][0] for c in open_)
        part = {c: min(budget * children[c][0] / total, children[c][1] - given[c]) for c in open_}
        for c, x in part.items():
            given[c] += x
        budget -= sum(part.values())
        open_ = {c for c in open_ if children[c][1] - given[c] > 1e-9}
    return given


@pytest.mark.parametrize("seed", range(6))
def test_budgets_against_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    leaves = [(d, lang, f"s{k}", rng.choice([0, 5, 100, 1000])) for d in "abc" for lang in ("x", None) for k in range(3)]
    weights = {("a",): 4, ("b",): 0 if seed == 1 else 2, ("a", "x"): 3, ("c", "x", "s1"): 5}
    budget = rng.choice([10, 500, 3000, 100000])
    frame = spark.createDataFrame(leaves, "d string, l string, s string, supply long")
    found = {(r["d"], r["l"], r["s"]): r["budget"] for r in leaf_budgets(frame, ["d", "l", "s"], weights, budget, 2).collect()}

    def walk(prefix, budget):
        below = [x for x in leaves if x[: len(prefix)] == prefix]
        if len(prefix) == 3:
            return {prefix: budget}
        names = {x[len(prefix)] for x in below}
        named = lambda n: weights.get(tuple("" if v is None else v for v in (*prefix, n)), 1.0)
        cap = lambda n: 2.0 * sum(x[3] for x in below if x[len(prefix)] == n)
        given = share_out(budget, {n: (named(n), cap(n)) for n in names})
        return {k: v for n in names for k, v in walk((*prefix, n), given[n]).items()}

    expected = walk((), float(budget))
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) <= 1 for k in expected)


def test_prefixes_of_seeded_epochs(spark):
    rows = [(k, "hot" if k % 3 else "cold", 10 if k % 7 else None) for k in range(300)] + [(None, None, 10)] * 3
    df = spark.createDataFrame(rows, "doc_id long, source string, tokens long").repartition(4)
    out = mix(df, {"s": F.col("source")}, {("cold",): 3, ("hot",): 1}, F.col("tokens"), F.col("doc_id"), 0.8, 2, 5)
    assert out.columns == ["doc_id", "source", "tokens", "epoch"]
    found = [tuple(r) for r in out.collect()]
    supply = defaultdict(int)
    for _, s, t in rows:
        supply[s] += t or 0
    budget = int(sum(supply.values()) * 0.8)
    given = {s: int(b) for s, b in share_out(budget, {"cold": (3, 2 * supply["cold"]), "hot": (1, 2 * supply["hot"]), None: (1, 2 * supply[None])}).items()}
    for source in ("cold", "hot"):
        whole, rest = divmod(given[source], supply[source])
        expected = [(i, source, t, e) for i, s, t in rows if s == source for e in range(whole)]
        stream = sorted((r for r in rows if r[1] == source), key=lambda r: md5(f"5:{whole}:{r[0]}".encode()).hexdigest())
        upto = 0
        for i, s, t in stream:
            upto += t or 0
            if upto > rest:
                break
            expected.append((i, s, t, whole))
        own = [r for r in found if r[1] == source]
        assert sorted(map(repr, own)) == sorted(map(repr, expected))
    assert len([r for r in found if r[1] is None]) == 6  # a small leaf gives both epochs
    tiny = spark.createDataFrame([(1, "s", None)], df.schema)
    assert mix(tiny, {"s": F.col("source")}, {}, F.col("tokens"), F.col("doc_id"), 0.5, 1, 5).count() == 0
