"""The prefix trie against a plain one, at depths around the powers of two."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from rowmill.llm import plans
from rowmill.llm.prefix_trie import prefix_trie


def plain_trie(sequences):
    """``{(member, depth): (parent, n_members, n_children, n_leaves, saved)}`` from ``{member: [(item, size)]}``."""
    nodes = defaultdict(list)
    for member, items in sequences.items():
        for depth in range(len(items) + 1):
            nodes[tuple(items[:depth])].append(member)
    children = defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, members in nodes.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += path not in children
            saved[path[:depth]] += (len(members) - 1) * (path[-1][1] if path else 0)
    return {
        (min(m), len(p)): (min(nodes[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], sorted(x for x in m if len(sequences[x]) == len(p)))
        for p, m in nodes.items()
    }


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), len(text.encode())))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    head = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    base = lambda c: c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))  # noqa: E731  the remainder has the sign of c
    return {c: own.get(base(c), [])[: head[c]] + v[head[c] :] for c, v in own.items()}


def answer(spark, folder):
    rows = plans.QUERIES["op13_prefix_trie"](spark, folder).collect()
    found = {(r["conv_id"], r["depth"]): r for r in rows}
    assert len(found) == len(rows)
    return {k: (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for k, r in found.items()}


def hashed(nodes):
    return {k: (*v[:5], hashlib.sha256(",".join(map(str, v[5])).encode()).hexdigest()) for k, v in nodes.items()}


def test_query_by_brute_force(spark, tmp_path):
    rng = random.Random(31)
    rows = []
    for c in [*range(-12, 120), 7_000, 10_000_001, None]:
        for t in [*range(rng.choice([1, 1, 2, 5, 9, 20])), *rng.choice([[], [None]])]:
            rows.append((c, t, rng.choice(["user", "user", "assistant", None]), rng.choice(["one", "one", "two ü", "", None])))
    rows += [(c, t, "user", f"turn {t}") for c in (400, 401, 402) for t in range(90)]  # deep, with copies
    rows += [(403, 1, "user", "same")] * 3
    spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, member string, depth string").repartition(5).write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    assert answer(spark, str(tmp_path)) == hashed(plain_trie(rebuilt(rows)))


@pytest.mark.parametrize("longest", [1, 2, 3, 4, 5, 8, 9, 17])
def test_depths(spark, longest):
    rng = random.Random(longest)
    sequences = {m: [(rng.choice("ab"), 1) for _ in range(rng.randint(0, longest))] for m in range(40)}
    sequences[0] = [("a", 1)] * longest
    sequences = {m: [(item, ord(item)) for item, _ in s] for m, s in sequences.items()}
    paths = spark.createDataFrame([(m, d + 1, *x) for m, s in sequences.items() for d, x in enumerate(s)], "member long, depth long, item string, size long")
    members = spark.createDataFrame([(m, len(s)) for m, s in sequences.items()], "member long, length long")
    nodes, _ = prefix_trie(paths, members)
    found = {(r["member"], r["depth"]): (r["parent"], r["n_members"], r["n_children"], r["n_leaves"], r["saved"]) for r in nodes.collect()}
    assert found == {k: v[:5] for k, v in plain_trie(sequences).items()}


def test_empty_sequences_only(spark):
    paths = spark.createDataFrame([], "member long, depth long, item string, size long")
    members = spark.createDataFrame([(5, 0), (3, 0)], "member long, length long")
    assert [tuple(r) for r in prefix_trie(paths, members)[0].collect()] == [(3, 0, None, 2, 0, 1, 0)]
    assert prefix_trie(paths, members.limit(0))[0].collect() == []
