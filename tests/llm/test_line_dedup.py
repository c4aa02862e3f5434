"""Line dedup against a plain search."""

import random
from collections import defaultdict

import numpy as np
import pytest

from rowmill.llm.line_dedup import PIECE_BITS, Filters, digest, drop_shared_lines, holds, probes

BLANK = " \t\n\x0b\x0c\r"


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_force(rows, least_documents=3, least_length=20):
    held = defaultdict(set)
    rank = lambda i: (i is not None, i)
    for i, text in rows:
        for line in (text or "").split("\n"):
            held[lowered(line.strip(BLANK))].add(i)
    keep = {k: max(v, key=rank) for k, v in held.items() if len(v) >= least_documents and len(k) >= least_length}
    result = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keep.get(lowered(x.strip(BLANK)), i) == i]
        result.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(result, key=repr)


def random_rows(rng, n):
    pool = [f"{rng.choice('ABCdefÄß')}hared line number {k} " + "é" * (k % 3) for k in range(40)] + ["short", "", "  ", "x" * 19, "é" * 20]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"a line of document {i} alone, {rng.random()}" for _ in range(rng.randint(0, 12))]
        lines = [x.upper() if rng.random() < 0.2 else x for x in lines]
        lines = [rng.choice(["", " ", "\t\r", "\x0b"]) + x + rng.choice(["", "  ", "\x0c"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    return rows + [(n, None), (n + 1, ""), (None, rows[0][1]), (None, rows[1][1]), rows[2], (3, rows[4][1]), (n + 2, "\n\n"), (n + 3, pool[0] + "\n" + pool[0])]


@pytest.mark.parametrize("ids", ["long", "string"])
def test_by_brute_force(spark, ids):
    rng = random.Random(11)
    rows = random_rows(rng, 150)
    if ids == "string":
        rows = [(None if i is None else f"d{i}", t) for i, t in rows]
    docs = spark.createDataFrame(rows, f"doc_id {ids}, text string").repartition(7)
    found = drop_shared_lines(docs).select("doc_id", "kept_text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows)


def test_full_filters_change_nothing(spark, monkeypatch):
    from rowmill.llm import line_dedup

    monkeypatch.setattr(line_dedup, "PIECE_BITS", 64)
    rows = random_rows(random.Random(12), 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = drop_shared_lines(docs, most_bits=64, least_documents=2).select("doc_id", "kept_text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows, 2)


def test_the_second_filter_holds_all_repeats_and_few_others():
    rng = np.random.default_rng(13)
    keys = rng.integers(0, 2**63, (60_000, 2)).astype(np.uint64)
    repeats, single = keys[:20_000], keys[20_000:]
    filters = Filters(PIECE_BITS)
    for part in (repeats, single[:20_000], repeats, single[20_000:]):
        filters.add(part)
    assert holds(filters.twice, probes(repeats, filters.mask)).all()
    assert holds(filters.twice, probes(single, filters.mask)).mean() < 0.02


def test_length_counts_code_points():
    assert digest(("é" * 19).encode(), 20) is None and digest(("é" * 20).encode(), 20)
    assert digest(b"  A LINE OF TWENTY CHARS \r", 20) == digest(b"a line of twenty chars", 20)


def test_own_columns_and_no_rows(spark):
    long = "one line that is the same in all of them"
    docs = spark.createDataFrame([(k, long, "mine", "row") for k in range(4)], "key long, body string, id string, row string")
    found = drop_shared_lines(docs, "key", "body").orderBy("key").collect()
    assert [(r["key"], r["kept_text"], r["id"], r["row"]) for r in found] == [(k, long if k == 3 else "", "mine", "row") for k in range(4)]
    assert drop_shared_lines(docs.limit(0), "key", "body").collect() == []


def test_a_very_long_document(spark):
    lines = [f"line {k} of a document with very many lines" for k in range(60_000)]
    docs = spark.createDataFrame([(k, "\n".join(lines)) for k in range(3)], "doc_id long, text string")
    assert [r["n_dropped"] for r in drop_shared_lines(docs).orderBy("doc_id").collect()] == [60_000, 60_000, 0]
