"""Quality selection by importance resampling: hashed n-gram models of good and of all text, Gumbel top-k."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import packed, unpacked, utf8, written

#: The models' buckets: two to this power.
BUCKET_BITS = 14
#: Added to every bucket's count in the smaller model, and in proportion in the larger one.
SMOOTHING = 5.0
#: Most good labelled rows that the target model is fitted on, the ones with the smallest hashes of their ids.
TARGET_ROWS = 20_000
#: Weights are those of a passage of this many grams, so that long and short texts are judged by one measure.
PASSAGE = 400
#: The draw is as large as the number of rows whose log weight is at least this (0.15 less per gram than raw text has).
LEAST_LOG_WEIGHT = -60.0

_TOKENS = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\s\x80-\xff]+")
_FACTORS = np.array([0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_TWICE = np.uint64(0xA0761D6478BD642F)


def grams_of(text: bytes | None) -> np.ndarray:
    """Buckets of a text's unigrams and bigrams; words and runs of punctuation are tokens, A-Z lower-cased.

    Invented or rare words share buckets by chance. A word that follows itself is one bigram, whatever the word.
    """
    tokens = _TOKENS.findall((text or b"").lower())
    if not tokens:
        return np.zeros(0, dtype=np.int64)
    hashes = np.fromiter(map(zlib.crc32, tokens), dtype=np.uint64, count=len(tokens))
    pairs = hashes[:-1] * _FACTORS[1] + hashes[1:] * _FACTORS[2]
    pairs[hashes[:-1] == hashes[1:]] = _TWICE
    return (np.concatenate([hashes * _FACTORS[0], pairs]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def gram_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all of ``rows(text binary, target boolean)`` and over its target rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << BUCKET_BITS, dtype=np.int64), np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
                found = np.bincount(grams_of(text.as_py()), minlength=1 << BUCKET_BITS)
                raw += found
                if good:
                    target += found
        where = np.flatnonzero(raw)
        yield pa.record_batch(
            [pa.array(where), pa.array(raw[where]), pa.array(target[where])], names=["bucket", "raw", "target"]
        )

    counted = rows.mapInArrow(count, "bucket long, raw long, target long")
    raw, target = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    # one row per bucket: bounded by BUCKET_BITS
    for row in counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toLocalIterator():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    return raw, target


class Weights:
    """Log importance weights from the counts of both models; a row's own grams are taken out of them first.

    Without that, a row outside the target would look unlike it for its own rare grams, which the raw model has seen.
    The pseudo-counts are in proportion to the models' sizes, so a gram that neither has seen elsewhere says nothing.
    """

    def __init__(self, raw: np.ndarray, target: np.ndarray):
        self.raw, self.target = raw, target
        self.sizes = raw.sum(), target.sum()
        smallest = max(1.0, min(self.sizes))
        self.pseudo = [SMOOTHING * size / smallest for size in self.sizes]

    def of(self, text: bytes | None, in_target: bool) -> float:
        grams = grams_of(text)
        if not len(grams) or not self.sizes[1]:
            return 0.0
        buckets, own = np.unique(grams, return_counts=True)
        total = 0.0
        for counts, size, pseudo, mine, sign in (
            (self.target, self.sizes[1], self.pseudo[1], own if in_target else 0 * own, 1),
            (self.raw, self.sizes[0], self.pseudo[0], own, -1),
        ):
            rest = size - mine.sum()
            if rest <= 0:  # there is no other row to compare with
                return 0.0
            shares = (counts[buckets] - mine + pseudo) / (rest + pseudo * len(counts))
            total += sign * float((own * np.log(shares)).sum())
        return total * PASSAGE / len(grams)


def log_weight(text: Column, in_target: Column, weights: Weights) -> Column:
    """A text's log importance weight: its grams' mean log ratio, for a passage; 0 for a text without any."""

    @F.arrow_udf("double")
    def weigh(texts: pa.Array, targets: pa.Array) -> pa.Array:
        return pa.array([weights.of(t.as_py(), g) for t, g in zip(texts, targets.to_pylist())], pa.float64())

    return weigh(utf8(text), in_target)


def gumbel(seed: int, *keys: Column) -> Column:
    """Standard Gumbel noise that depends on seed and keys alone."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, column: str, k: int, buckets: int = 4096) -> float | None:
    """The ``k``-th largest value of a column without nulls; None for no rows or ``k`` below 1, the least for large ``k``.

    Each pass counts the values in equal ranges and goes on in the one that holds the ``k``-th, so that the driver sees
    ``buckets`` counts at most, however many rows there are and however they tie.
    """
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k < 1:
        return None
    if k >= n:
        return low
    left = k
    while low < high:
        width = (high - low) / buckets
        inside = values.where(F.col(column).between(low, high))
        part = F.least(F.lit(buckets - 1), F.floor((F.col(column) - low) / width)) if width else F.lit(0)
        counted = inside.groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(counted.collect(), key=lambda r: -r["part"]):  # at most `buckets` rows
            if left <= row["n"]:
                if (row["low"], row["high"]) == (low, high):
                    return _kth_by_value(inside, column, left)
                low, high = row["low"], row["high"]
                break
            left -= row["n"]
    return low


def _kth_by_value(values: DataFrame, column: str, k: int) -> float:
    """For a range too narrow to be cut further, which holds a handful of different doubles."""
    left = k
    for row in values.groupBy(column).count().orderBy(F.desc(column)).toLocalIterator():
        left -= row["count"]
        if left <= 0:
            return row[column]
    raise ValueError("k exceeds the number of values")


def resample(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 7,
    draw: int | None = None,
) -> DataFrame:
    """``df`` with ``log_weight``, ``draw_key`` and ``kept``: an importance sample without replacement.

    ``labels(id, good)`` names good rows. The target model counts hashed uni- and bigrams over at most ``TARGET_ROWS``
    of them, the raw model over all rows of ``df``. A row's weight is the ratio of its probabilities under both, for a
    passage of ``PASSAGE`` grams. Gumbel noise is added to the log weights, and the ``draw`` largest sums are kept,
    which draws rows in proportion to their weights. Without ``draw`` the draw is as large as the number of rows with a
    log weight of ``LEAST_LOG_WEIGHT`` or more, so rows that look like the target stay and rows that the raw model
    alone explains go.

    Noise depends on seed, id and text: repeated rows have the same sum, and rows that tie with the last one drawn are
    all kept. Null and empty texts have weight 1. Labels of null ids or of rows that are not there say nothing; an id
    is good if all its labels are. Without any good label all weights are 1. An empty table gives no rows. Columns of
    ``df`` named like the new ones give way. Scores alone are written to find
    the last one drawn, and computed again beside the rows, so texts are neither shuffled nor written.
    """
    ident, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    good = labels.where("id is not null").groupBy("id").agg(F.bool_and(F.coalesce("good", F.lit(False))).alias("all_good"))
    targets = good.where("all_good").orderBy(F.xxhash64("id"), "id").limit(TARGET_ROWS).select(F.col("id").alias("of"))
    marked = packed(df, id=ident, text=text.cast("string")).join(F.broadcast(targets), F.col("id") == F.col("of"), "left")
    marked = marked.withColumn("target", F.col("of").isNotNull())
    weights = Weights(*gram_counts(marked.select(utf8("text"), "target")))
    scored = marked.withColumn("log_weight", log_weight(F.col("text"), F.col("target"), weights))
    scored = scored.withColumn("draw_key", F.col("log_weight") + gumbel(seed, F.col("id"), F.xxhash64("text")))
    keys = written(scored.select("log_weight", "draw_key"), "scores")
    if draw is None:
        draw = keys.where(F.col("log_weight") >= LEAST_LOG_WEIGHT).count()
    least = kth_largest(keys.select("draw_key"), "draw_key", draw)
    kept = F.lit(False) if least is None else F.col("draw_key") >= least
    return unpacked(scored, df.columns, log_weight=F.col("log_weight"), draw_key=F.col("draw_key"), kept=kept)
