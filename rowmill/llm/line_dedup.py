"""Lines that several documents share stay in one of them: two Bloom filters find suspects, only those are shuffled."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import packed, unpacked, utf8, written

#: White space that is stripped from both ends of a line before lines are compared.
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bits of the filters for each key, and the bits that a key sets: one key in 400 is suspected wrongly.
BITS_PER_KEY, PROBES = 16, 4
#: Largest filter (64 MB). Beyond MOST_BITS / BITS_PER_KEY keys the filters fill up and more keys are suspected wrongly;
#: the result is the same, the suspects' shuffle comes nearer to that of all digests, at 16 bytes a key.
MOST_BITS = 1 << 29
#: Filters are merged in pieces of this size.
PIECE_BITS = 1 << 20
#: Entries that a task puts together before it hands on what it has.
ENTRIES = 200_000


def drop_shared_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_documents: int = 3,
    least_length: int = 20,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped``.

    Lines end at ``\\n``. Two lines are the same if they are equal without white space at their ends and with A-Z
    lower-cased. A line of at least ``least_length`` code points (after that) that ``least_documents`` documents hold is
    dropped everywhere but in the document of the largest id that holds it, where each repeat of it stays.

    Digests of the lines are stored once. Every task of the first job notes a digest in its filter of those seen and,
    when it is there already, in its filter of those seen again; merging keeps in the second what two of the first have
    in common, so a repeated line is always in it. Only digests found there are shuffled, reduced per task to the
    largest ids of each, and counted exactly. Each document that loses lines meets the list of them in a join; a third
    filter, of those documents' ids, lets the texts of nearly all others stay where they are.

    Digests are 128 bits of BLAKE2, so two lines never share one. A null or empty text is one empty line. Rows with the
    same id are one document and all keep or lose a line together; a null id is the smallest one. Columns of ``docs``
    named like the three new ones give way to them. No documents give no rows.
    """
    rows = packed(docs, id=docs[f"`{id_column}`"], text=utf8(docs[f"`{text_column}`"]))
    digests = written(_digests(rows.select("id", "text"), least_length), "line-digests")
    context = docs.sparkSession.sparkContext
    again = context.broadcast(_seen_again(digests, most_bits))
    repeats = written(_confirmed(_suspects(digests, again, least_documents), least_documents), "lines")
    dropped = written(_dropped(_suspects(digests, again, None), repeats), "dropped")
    losing = context.broadcast(_losing(dropped, most_bits))
    all_kept = F.struct(
        F.coalesce("text", F.lit("").cast("binary")).alias("kept"), _n_lines(F.col("text")).alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")
    )
    whole = rows.where(~_may_hold(losing, F.col("id"))).select("row", all_kept.alias("found"))
    cut = rows.where(_may_hold(losing, F.col("id"))).join(dropped, F.col("id").eqNullSafe(F.col("of")), "left")
    cut = cut.select("row", _without_listed(least_length)(F.col("text"), F.col("dropped")).alias("found"))
    return unpacked(
        whole.union(cut),
        docs.columns,
        kept_text=F.col("found.kept").cast("string"),
        n_lines=F.col("found.n_lines"),
        n_dropped=F.col("found.n_dropped"),
    )


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()


def digest(line: bytes, least_length: int) -> bytes | None:
    """16 bytes for a line that is long enough, in code points, to be compared."""
    key = line_key(line)
    if len(key) < least_length or (len(key) < 4 * least_length and len(key.decode("utf-8", "replace")) < least_length):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _digests(rows: DataFrame, least_length: int) -> DataFrame:
    """``(id, digests)``: the different digests of each text, one after the other."""

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                lines = (digest(line, least_length) for line in set((text.as_py() or b"").split(b"\n")))
                found.append(b"".join(dict.fromkeys(d for d in lines if d)))
            yield pa.record_batch([batch.column("id"), pa.array(found, pa.binary())], names=["id", "digests"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(of_texts, f"id {kind}, digests binary").where("octet_length(digests) > 0")


class Filters:
    """The pair of Bloom filters of one task."""

    def __init__(self, bits: int):
        self.mask = np.uint64(bits - 1)
        self.once = np.zeros(bits // 64, np.uint64)
        self.twice = np.zeros(bits // 64, np.uint64)

    def add(self, hashes: np.ndarray) -> None:
        """``hashes`` are pairs of 64-bit numbers; equal ones come from different documents."""
        hashes = hashes[np.lexsort((hashes[:, 1], hashes[:, 0]))]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        bits = probes(hashes[starts], self.mask)
        again = (np.diff(np.append(starts, len(hashes))) > 1) | holds(self.once, bits)
        put(self.twice, bits[again])
        put(self.once, bits)


def probes(hashes: np.ndarray, mask: np.uint64) -> np.ndarray:
    steps = np.arange(PROBES, dtype=np.uint64)
    return (hashes[:, :1] + steps * (hashes[:, 1:] | np.uint64(1))) & mask


def holds(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return ((words[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1)).all(axis=1)


def put(words: np.ndarray, bits: np.ndarray) -> None:
    bits = bits.ravel()
    np.bitwise_or.at(words, bits >> np.uint64(6), np.uint64(1) << (bits & np.uint64(63)))


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The digests of a batch as pairs of numbers, and the row of each."""
    values = column.to_pylist()
    sizes = [len(v) // 16 for v in values]
    return np.frombuffer(b"".join(values), "<u8").reshape(-1, 2), np.repeat(np.arange(len(values)), sizes)


def _filter_bits(keys: int, most_bits: int) -> int:
    bits = PIECE_BITS
    while bits < min(BITS_PER_KEY * keys, most_bits):
        bits *= 2
    return bits


def _seen_again(digests: DataFrame, most_bits: int) -> np.ndarray:
    """The merged filter of digests seen more than once."""
    keys = digests.agg(F.coalesce(F.sum(F.octet_length("digests")), F.lit(0))).first()[0] // 16
    return _merged(digests, lambda batch: _pairs(batch.column("digests"))[0], _filter_bits(keys, most_bits), True)


def _losing(dropped: DataFrame, most_bits: int) -> np.ndarray:
    """The filter of documents that lose lines."""
    ids = dropped.select(*_id_hashes(F.col("of")))
    return _merged(ids, lambda batch: _two_columns(*batch.columns), _filter_bits(ids.count(), most_bits), False)


def _id_hashes(own: Column) -> tuple[Column, Column]:
    return F.xxhash64(own).alias("one"), F.xxhash64(own, F.lit("again")).alias("two")


def _two_columns(one: pa.Array, two: pa.Array) -> np.ndarray:
    return np.stack([column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for column in (one, two)], axis=1)


def _may_hold(losing: Broadcast, own: Column) -> Column:
    @F.arrow_udf("boolean")
    def held(one: pa.Array, two: pa.Array) -> pa.Array:
        return pa.array(holds(losing.value, probes(_two_columns(one, two), np.uint64(64 * len(losing.value) - 1))))

    return held(*_id_hashes(own))


def _n_lines(text: Column) -> Column:
    """Line ends of a text in bytes, and one."""
    without = F.octet_length(F.replace(text.cast("string"), F.lit("\n"), F.lit("")))
    return F.coalesce(F.octet_length(text) - without + 1, F.lit(1)).cast("long")


def _merged(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int, repeats: bool) -> np.ndarray:
    """The second filter (``repeats``) or the first one over all rows; at most MOST_BITS come to the driver."""
    words = PIECE_BITS // 64

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(bits)
        for batch in batches:
            filters.add(hashes_of(batch))
        for piece in range(bits // PIECE_BITS):
            once, twice = (f[piece * words : (piece + 1) * words] for f in (filters.once, filters.twice))
            if once.any():
                yield pa.record_batch([pa.array([piece], pa.int32()), pa.array([once.tobytes()]), pa.array([twice.tobytes()])], names=["piece", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for piece, *pair in zip(*(column for column in batch.columns)):
                once, twice = (np.frombuffer(x.as_py(), np.uint64) for x in pair)
                own = merged.setdefault(piece.as_py(), [np.zeros(words, np.uint64), np.zeros(words, np.uint64)])
                own[1] |= twice | (own[0] & once)
                own[0] |= once
        for piece, pair in merged.items():
            yield pa.record_batch([pa.array([piece], pa.int32()), pa.array([pair[repeats].tobytes()])], names=["piece", "bits"])

    # few builders, whatever the number of partitions, since each hands on whole filters
    builders = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    pieces = builders.mapInArrow(build, "piece int, once binary, twice binary")
    merged = pieces.repartition(bits // PIECE_BITS, "piece").mapInArrow(merge, "piece int, bits binary")
    whole = np.zeros(bits // 64, np.uint64)
    for row in merged.collect():
        whole[row["piece"] * words : (row["piece"] + 1) * words] = np.frombuffer(row["bits"], np.uint64)
    return whole


def _suspects(digests: DataFrame, again: Broadcast, most_ids: int | None) -> DataFrame:
    """``(digest, id)`` of the suspected lines; with ``most_ids`` each task gives only so many of a line's largest ids."""
    id_type = digests.schema["id"].dataType.simpleString()

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list, pa.DataType]]:
        for batch in batches:
            hashes, rows = _pairs(batch.column("digests"))
            at = np.flatnonzero(holds(again.value, probes(hashes, np.uint64(64 * len(again.value) - 1))))
            flat, ids = hashes[at].tobytes(), batch.column("id").to_pylist()
            found = [flat[16 * k : 16 * k + 16] for k in range(len(at))]
            yield found, [ids[r] for r in rows[at]], batch.schema.field("id").type

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, ids, kind in suspected(batches):
            yield pa.record_batch([pa.array(found, pa.binary()), pa.array(ids, kind)], names=["digest", "id"])

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        kind = None

        def hand_on() -> pa.RecordBatch:
            flat = [(d, i) for d, ids in held.items() for i in ids]
            held.clear()
            return pa.record_batch([pa.array([d for d, _ in flat], pa.binary()), pa.array([i for _, i in flat], kind)], names=["digest", "id"])

        for found, ids, kind in suspected(batches):  # noqa: B020
            for one, own in zip(found, ids):
                known = held.setdefault(one, [])
                if own not in known:
                    known.append(own)
                    if len(known) > most_ids:
                        known.remove(min(known, key=lambda i: (i is not None, i)))
            if len(held) > ENTRIES:
                yield hand_on()
        if held:
            yield hand_on()

    return digests.mapInArrow(every if most_ids is None else largest, f"digest binary, id {id_type}")


def _confirmed(suspects: DataFrame, least_documents: int) -> DataFrame:
    """``(digest, keep)`` of the lines that enough documents hold, with the id that keeps the line."""
    held = suspects.distinct().groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("keep"))
    return held.where(F.col("n") >= least_documents).select("digest", "keep")


def _dropped(suspects: DataFrame, repeats: DataFrame) -> DataFrame:
    """``(of, dropped)``: for each document that loses lines their digests."""
    lost = suspects.join(repeats, "digest").where(~F.col("id").eqNullSafe(F.col("keep")))
    return lost.groupBy(F.col("id").alias("of")).agg(F.collect_set("digest").alias("dropped"))


def _without(text: bytes | None, is_dropped) -> tuple[bytes, int, int]:
    lines = (text or b"").split(b"\n")
    kept = [line for line in lines if not is_dropped(line)]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


_FOUND = "struct<kept:binary,n_lines:long,n_dropped:long>"


def _found(rows: list[tuple[bytes, int, int]]) -> pa.Array:
    kept, lines, dropped = zip(*rows) if rows else ((), (), ())
    arrays = [pa.array(kept, pa.binary()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
    return pa.StructArray.from_arrays(arrays, ["kept", "n_lines", "n_dropped"])


def _without_listed(least_length: int):
    @F.arrow_udf(_FOUND)
    def without(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        rows = []
        for text, own in zip(texts, dropped):
            lost = set(own.as_py() or ())
            rows.append(_without(text.as_py(), (lambda line: digest(line, least_length) in lost) if lost else (lambda line: False)))
        return _found(rows)

    return without
