"""Exact top-k by inner product: every query against every row, term at a time."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.llm.common import written

#: Rows of one block on either side; a block pair's score arrays are filled for some queries at a time.
BLOCK_QUERIES = 4096
BLOCK_ROWS = 4096
SCORES_AT_ONCE = 1 << 18
#: From this share of a term's weights on, its postings are added as a whole instead of one by one.
DENSE = 0.2
#: What a block pair gives: query, key of its weights, row, score, and its order among scores that no long holds.
FOUND = ["query_id", "query_key", "id", "score", "beyond"]
_NINES = str.maketrans("0123456789", "9876543210")


def whole_weights(vector: str, scale: int = 64) -> Column:
    """Components scaled and rounded down, as doubles that hold whole numbers; null for a vector that is null or holds
    null or non-finite values. A finite component whose product with ``scale`` is beyond all doubles fails the job."""
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    fit = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    beyond = F.raise_error(F.lit(f"a component times {scale} is beyond all doubles")).cast("double")
    # from 2^52 on doubles are whole
    floor = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).when(F.abs(x) < float("inf"), x).otherwise(beyond)
    return F.when(fit, F.transform(F.col(f"`{vector}`"), lambda x: floor(scaled(x))))


def top_k(rows: DataFrame, queries: DataFrame, k: int, id_column: str, weights: str) -> DataFrame:
    """``(query_id, rank, id, score)``: each query's ``k`` largest inner products over all rows but those of its own id.

    ``rows`` and ``queries`` hold an id and an array of whole weights, one per term; terms beyond the shorter array's
    end weigh nothing. Ties go to the smaller id, equal ids with equal scores (repeated rows) all count. Rows with a
    null id or null weights take no part; repeated queries (same id and weights) are answered once. Fewer than ``k``
    rows give fewer results, an empty side gives none.

    Both sides are cut into blocks of bounded size; every block of queries meets every block of rows in a task of its
    own. There each query scatters its weighted postings, one term after the other, into dense arrays of scores, and a
    partition selection keeps what can still be among the first ``k``. The selections are merged per query.

    Scores are exact. Vectors with weights so large that a score might leave 64 bits are scored with whole numbers of any
    size, which is slower; ranks follow these, and a score that no long holds is given as the nearest long.
    """
    side = lambda df: df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{weights}`").alias("w")).where(
        "id is not null and w is not null"
    )
    rows = written(side(rows), "candidates")
    queries = written(side(queries).dropDuplicates(), "queries")
    row_blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    block = lambda n: F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "w", block(query_blocks).alias("qb"), every(row_blocks).alias("rb"))
    right = rows.select("id", "w", every(query_blocks).alias("qb"), block(row_blocks).alias("rb"))
    id_type = dict(rows.dtypes)["id"]

    def select(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if queries.num_rows and rows.num_rows:
            return _select(queries, rows, k)
        nothing = pa.array([], "int64")
        return pa.table([queries["id"][:0], nothing, rows["id"][:0], nothing, pa.array([], "string")], names=FOUND)

    cells = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb"))
    found = cells.applyInArrow(select, f"query_id {id_type}, query_key long, id {id_type}, score long, beyond string")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.desc("beyond"), F.asc("id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_column), "score")
    )


def _select(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best ``k`` rows of one block for each query of one block, or some more."""
    ids = rows["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], _dense(rows["w"])[order]
    query_ids, terms = queries["id"].to_numpy(), _dense(queries["w"])
    keys = np.array([xxhash.xxh64_intdigest(row.tobytes()) for row in terms], dtype=np.uint64).view(np.int64)
    width = min(terms.shape[1], vectors.shape[1])
    terms, vectors = terms[:, :width], vectors[:, :width]
    # of these weights no score leaves 64 bits
    limit = float(isqrt(((1 << 63) - 1) // max(1, width)))
    small = lambda w: np.abs(w.astype(np.float64)).max(axis=1, initial=0) <= limit
    few, many = small(terms), small(vectors)
    found = []
    if few.any() and many.any():
        found.append(_select_small(query_ids[few], keys[few], terms[few], ids[many], vectors[many], k))
    if few.any() and not many.all():
        found.append(_select_large(query_ids[few], keys[few], terms[few], ids[~many], vectors[~many], k))
    if not few.all():
        found.append(_select_large(query_ids[~few], keys[~few], terms[~few], ids, vectors, k))
    return pa.concat_tables(found)


def _select_large(query_ids: np.ndarray, keys: np.ndarray, terms: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pa.Table:
    """The same with whole numbers of any size."""
    whole = np.vectorize(int, otypes=[object])
    vectors = whole(vectors)
    out = []
    for own, key, weights in zip(query_ids, keys, terms):
        scores = vectors @ whole(weights)
        others = [i for i in range(len(ids)) if ids[i] != own]
        out += [(own, key, ids[i], int(scores[i])) for i in sorted(others, key=lambda i: (-scores[i], i))[:k]]
    clipped = [max(-(1 << 63), min((1 << 63) - 1, score)) for *_, score in out]
    beyond = [None if held == score > -(1 << 63) else _sortable(score) for held, (*_, score) in zip(clipped, out)]
    kind = pa.array(ids).type
    columns = [pa.array([r[0] for r in out], kind), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], kind)]
    return pa.table([*columns, pa.array(clipped, pa.int64()), pa.array(beyond, pa.string())], names=FOUND)


def _sortable(score: int) -> str:
    """A text that orders numbers beyond a long like the numbers themselves, among those of one sign."""
    digits = str(abs(score))
    text = f"{len(digits):05d}{digits}"
    return text if score > 0 else text.translate(_NINES)


def _select_small(query_ids: np.ndarray, keys: np.ndarray, terms: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pa.Table:
    """The same where all scores stay within 64 bits, and in 32 bits where they fit."""
    width = terms.shape[1]
    largest = int(np.abs(terms).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * width
    kind = np.int32 if largest < 1 << 31 and max(np.abs(terms).max(initial=0), np.abs(vectors).max(initial=0)) < 1 << 31 else np.int64
    postings = _postings(vectors.astype(kind))
    terms = np.ascontiguousarray(terms.T.astype(kind))
    step = max(1, SCORES_AT_ONCE // max(1, len(ids)))
    scores, scratch = np.zeros((step, len(ids)), dtype=kind), np.zeros((step, len(ids)), dtype=kind)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(query_ids), step):
        part = terms[:, start : start + step]
        found, product = scores[: part.shape[1]], scratch[: part.shape[1]]
        found[:] = 0
        for weights, (where, values, full) in zip(part, postings):
            who = np.flatnonzero(weights)
            if len(who) * len(where) >= DENSE * found.size:  # adding zeros costs less than scattering
                np.multiply(weights[:, None], full[None, :], out=product)
                found += product
            elif len(who) and len(where):
                found[np.ix_(who, where)] += weights[who, None] * values[None, :]
        for row, own in enumerate(query_ids[start : start + step]):
            where, best = _best(found[row], ids, own, k)
            out.append((np.full(len(where), start + row), where, best))
    owners, where, best = (np.concatenate(x) for x in zip(*out))
    columns = [pa.array(query_ids[owners]), pa.array(keys[owners]), pa.array(ids[where]), pa.array(best.astype(np.int64))]
    return pa.table([*columns, pa.nulls(len(best), pa.string())], names=FOUND)


def _dense(weights: pa.ChunkedArray) -> np.ndarray:
    """Arrays of weights as one matrix; terms that an array does not have weigh 0."""
    vectors = weights.combine_chunks()
    lengths, values = np.diff(vectors.offsets.to_numpy()), vectors.flatten().to_numpy()
    dense = np.zeros((len(vectors), int(lengths.max(initial=0))), dtype=values.dtype)
    dense[np.arange(dense.shape[1])[None, :] < lengths[:, None]] = values
    return dense + dense.dtype.type(0)  # no negative zeros


def _postings(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every term the positions and weights of the rows that have it, and the weights of all rows."""
    found = []
    for weights in np.ascontiguousarray(vectors.T):
        where = np.flatnonzero(weights)
        found.append((where, weights[where], weights))
    return found


def _best(scores: np.ndarray, ids: np.ndarray, own, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the ``k`` best rows with another id; positions follow the ids, so ties go to the smaller."""
    low, high = (int(np.searchsorted(ids, own, side)) for side in ("left", "right"))
    where = np.arange(len(ids)) if low == high else np.r_[0:low, high : len(ids)]
    own = scores[where] if len(where) < len(ids) else scores
    if len(where) <= k:
        return where, own
    least = np.partition(own, len(own) - k)[len(own) - k]
    good = np.flatnonzero(own >= least)
    good = good[np.argsort(-own[good].astype(np.int64), kind="stable")][:k]
    return where[good], own[good]
