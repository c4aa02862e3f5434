import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.llm import simhash
from rowmill.llm.components import connected_components
from rowmill.llm.simhash import HammingHalves, fingerprint_links, near_duplicates, without_near_duplicates


def linked_by_brute_force(values: list[int], threshold: int) -> dict[int, int]:
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(values):
        for b in values[:k]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= threshold:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values if any(root(v) == root(w) for w in values if w != v)}


def crowded(seed: int, centres: int, around: int) -> list[int]:
    """Signed fingerprints in tight crowds, many of them at the threshold's edge."""
    rng = random.Random(seed)
    values = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(around):
            value = centre
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4, 6])):
                value ^= 1 << bit
            values.add(value)
    return sorted(v - 2**64 if v >= 2**63 else v for v in values)


@pytest.mark.parametrize("threshold, pieces, rows", [(3, 4096, 65536), (3, 2, 65536), (3, 2, 3), (3, 5, 4), (2, 4096, 65536), (1, 4096, 65536), (0, 4096, 65536)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, threshold, pieces, rows):
    monkeypatch.setattr(simhash, "HOMES_PER_PIECE", pieces)
    monkeypatch.setattr(simhash, "ROWS_PER_PIECE", rows)
    values = crowded(threshold, 12, 12) + [0, -1, 1]
    prints = spark.createDataFrame([(v, v) for v in values], "node long, f0 long")
    roots = connected_components(fingerprint_links(prints, HammingHalves(threshold))).collect()
    assert {r["node"]: r["root"] for r in roots} == linked_by_brute_force(values, threshold)


def test_every_pair_within_three_bits_meets():
    rng = np.random.default_rng(1)
    code = HammingHalves(3)
    one = rng.integers(0, 2**63, (3000, 1), dtype=np.uint64)
    other = one.copy()
    for k in range(3000):
        for bit in rng.choice(64, rng.integers(1, 4), replace=False):
            other[k, 0] ^= np.uint64(1 << int(bit))
    met = np.zeros(3000, dtype=bool)
    for (a, rows, home), (b, owners, _) in zip(code.anchors(one), code.anchors(other)):
        assert np.bincount(owners).max() <= 17
        reached = set(zip(b.tolist(), owners.tolist()))
        met |= np.array([(int(x), k) in reached for k, x in enumerate(a[home])])
    assert met.all()


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (4, " \t\n"), (7, "One two three four"), (6, "one TWO three four"), (None, "one two three four"), (7, "One two three four")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in found) == [(-1, 6), (3, 3), (4, 3), (5, 3), (6, 6), (7, 6), (7, 6)]
    assert {r["fingerprint"] for r in found if r["component_id"] == 3} == {"0" * 16}
    alone = near_duplicates(spark.createDataFrame([(None, "some text")], "doc_id long, text string")).collect()
    assert alone[0]["component_id"] is None


def test_one_row_of_each_group_stays(spark):
    """Mutants of a few texts on both sides of the distance, copies, and odd rows, against brute force."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows = []
    for group in range(12):
        words = [word() for _ in range(300)]
        for copy in range(12):
            own = list(words)
            for _ in range(rng.randint(0, 12)):
                own[rng.randrange(300)] = word()
            rows.append((group * 100 + copy, " ".join(own), "x"))
    rows += [rows[0], (None, rows[0][1], None), (5000, None, "y"), (5001, "", "y"), (None, "quite another text of its own here", None)]
    prints = [simhash.fingerprint_of(None if t is None else t.encode()) for _, t, _ in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    least = {}
    for g, (i, _, _) in zip(group, rows):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    kept = without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(least.values())
    assert 14 < len(least) < 140


def test_components_of_long_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (None, 7)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_crowded_anchor_in_many_pieces(spark):
    """Forty thousand fingerprints within three bits of zero, most of which meet at a few anchors."""
    values = [sum(1 << b for b in bits) for bits in itertools.combinations(range(64), 3)] + [0]
    values = [v - 2**64 if v >= 2**63 else v for v in values]
    assert len(values) == 41665
    prints = spark.createDataFrame([(v, v) for v in values], "node long, f0 long")
    roots = connected_components(fingerprint_links(prints, HammingHalves(3)))
    assert roots.agg(F.count("*"), F.min("root"), F.max("root")).first() == (41665, min(values), min(values))
