"""Near-duplicate documents: SimHash fingerprints compared at the anchors of covering codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import packed, unpacked, utf8, written
from rowmill.llm.components import connected_components

SEED = 42
#: Homes of one anchor, and rows that come to it, in one piece; a hotter anchor is cut into pieces of about this size.
HOMES_PER_PIECE, ROWS_PER_PIECE = 4096, 65536

_U = np.uint64


def shingle_hashes(text: bytes | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, repeats included, in pieces; nothing for a text without words.

    Words are lower-cased (A-Z) and stand between ASCII white space; a text of fewer words is one shingle.
    """
    tokens = (text or b"").lower().split()  # for bytes: A-Z, and the six ASCII white spaces
    count = max(1, len(tokens) - words + 1) if tokens else 0
    for start in range(0, count, 65536):
        end = min(count, start + 65536)
        hashes = (xxhash.xxh64_intdigest(b" ".join(tokens[i : i + words]), SEED) for i in range(start, end))
        yield np.fromiter(hashes, dtype=_U, count=end - start)


def fingerprint_of(text: bytes | None, words: int = 3) -> int:
    """The 64-bit SimHash of one text (unsigned): bits set in over half of the shingle hashes; 0 without words."""
    ones, count = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, words):
        ones += _ones(hashes)
        count += len(hashes)
    return int(np.packbits(2 * ones > count, bitorder="little").view(_U)[0])


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


class HammingHalves:
    """Anchors for 64-bit fingerprints and up to three differing bits.

    The anchors of a 32-bit half are the words of the Hamming code of 31 bits with the 32nd bit beside them. Every half
    is within one bit (the covering radius) of exactly one, its home. Of two fingerprints within three bits, one half
    differs in at most one bit; so a half is replicated to all anchors within radius plus one, 17 at most.
    """

    words, longest = 1, 3

    def __init__(self, threshold: int):
        if not 0 <= threshold <= self.longest:
            raise ValueError(f"threshold must be 0 to {self.longest}")
        self.threshold = threshold
        self.checks = [_U(sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)) for k in range(5)]
        # words within two bits of the anchor: pairs of positions whose numbers give the syndrome
        self.flips = [
            np.array([(1 << (i - 1)) ^ (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < i ^ s], dtype=_U)
            for s in range(32)
        ]

    def anchors(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per half: anchors, the rows that they belong to, and whether they are the rows' homes."""
        spare_bit = _U(0x80000000)
        for half in (0, 1):
            word = (prints[:, 0] >> _U(32 * half)) & _U(0xFFFFFFFF)
            block, spare = word & _U(0x7FFFFFFF), word & spare_bit
            syndrome = np.zeros(len(word), dtype=_U)
            for k, check in enumerate(self.checks):
                syndrome |= (np.bitwise_count(block & check).astype(_U) & _U(1)) << _U(k)
            home = block ^ np.where(syndrome > 0, _U(1) << np.maximum(syndrome, _U(1)) - _U(1), _U(0))
            rows = np.arange(len(word))
            found, owners = [home | spare, home | (spare ^ spare_bit)], [rows, rows]
            for s in range(1, 32):
                chosen = np.flatnonzero(syndrome == s)
                found.append(((block[chosen, None] ^ self.flips[s][None, :]) | spare[chosen, None]).ravel())
                owners.append(np.repeat(chosen, len(self.flips[s])))
            anchors = np.concatenate(found) | _U(half << 32)
            yield anchors, np.concatenate(owners), np.arange(len(anchors)) < len(word)

    def pairs(self, anchor: int, prints: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each home of an anchor with all that came there, home by home."""
        others = np.arange(len(prints))
        for home in own:
            yield np.full(len(prints), home), others


def _bits_of(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(len(prints), -1), axis=1, bitorder="little")


def simhash(text: Column, words: int = 3) -> Column:
    """The 64-bit fingerprint of a text as a signed long; null and empty texts have fingerprint zero."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        values = (fingerprint_of(t.as_py(), words) for t in texts)
        return pa.array(np.fromiter(values, dtype=_U, count=len(texts)).view(np.int64))

    return fingerprints(utf8(text))


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, threshold: int = 3
) -> DataFrame:
    """One row ``(id, fingerprint, component_id)`` per row of ``df``; linked fingerprints share a component.

    Two 64-bit fingerprints link when they differ in at most ``threshold`` bits; the component's id is the smallest id
    that can be reached over links. Only distinct fingerprints are compared, so exact copies cost one row however many
    there are. Null ids take no part in the minimum; a component of null ids has a null id. Repeated rows are kept, an
    empty table gives none. Other columns of ``df`` are not looked at.
    """
    text = simhash(F.col(f"`{text_column}`"), words).alias("f0")
    prints = written(df.select(F.col(f"`{id_column}`").alias("id"), text), "prints")
    return grouped(prints, HammingHalves(threshold)).select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def without_near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, threshold: int = 3
) -> DataFrame:
    """``df`` with one row of each component of :func:`near_duplicates`: the one with the smallest id (null ids last).

    Of rows that share that id one stays. Texts without words are copies of each other. An empty table gives no rows.
    All columns of ``df`` are kept; rows are written once with their texts, and only numbers are compared.
    """
    rows = packed(df, id=F.col(f"`{id_column}`"), f0=simhash(F.col(f"`{text_column}`"), words), at=F.monotonically_increasing_id())
    rows = written(rows, "rows")
    # `at` tells repeated rows apart
    prints = rows.select(F.struct(F.col("id").isNull(), "id", "at").alias("id"), "f0")
    settled = grouped(prints, HammingHalves(threshold))
    others = settled.where(F.col("id") != F.col("component")).select(F.col("id.at").alias("at"))
    return unpacked(rows.join(others, "at", "left_anti"), df.columns)


def grouped(prints: DataFrame, code: HammingHalves) -> DataFrame:
    """``prints(id, f0..)`` with ``component``, the smallest id of the row's group."""
    names = [f"f{k}" for k in range(code.words)]
    node = F.monotonically_increasing_id() if code.words > 1 else F.col("f0")
    classes = prints.groupBy(*names).agg(F.min("id").alias("least")).withColumn("node", node)
    classes = written(classes, "classes")
    return components_of(prints, classes, names, fingerprint_links(classes.select("node", *names), code))


def components_of(prints: DataFrame, classes: DataFrame, names: list[str], links: DataFrame) -> DataFrame:
    """``prints(id, names..)`` with ``component``, the smallest id that links between ``classes(names.., least, node)`` reach."""
    roots = connected_components(links)
    linked = written(roots.join(classes, "node").select("node", "root", "least"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    components = linked.join(least, "root").select("node", "component")
    settled = classes.join(components, "node", "left").select(*names, F.coalesce("component", "least").alias("component"))
    return prints.join(settled, names)


def fingerprint_links(prints: DataFrame, code: HammingHalves) -> DataFrame:
    """Links ``(a, b)`` between nodes of ``prints(node, f0..)``, distinct fingerprints, by comparison at the anchors.

    Every fingerprint goes to its anchors as ``code`` says, and each anchor compares the ones whose home it is with what
    came there. An anchor gives at most as many links as it holds fingerprints (a forest), so near-copies do not
    multiply. Where an anchor is home to many, its homes and the rows that come there are both cut into parts, and each
    part of the one meets each part of the other in a piece of its own.
    """
    words = code.words
    prints = prints.select("node", *(f"f{k}" for k in range(words)))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "home", "node", *(f"f{k}" for k in range(words))]
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(words + 1)]
            own = np.stack(columns[1:], axis=1).view(_U)
            for anchors, owners, home in code.anchors(own):
                rows = [anchors.view(np.int64), home, *(c[owners] for c in columns)]
                yield pa.record_batch([pa.array(r) for r in rows], names=names)

    longs = "".join(f", f{k} long" for k in range(words))
    spread = prints.mapInArrow(replicate, f"anchor long, home boolean, node long{longs}")

    def count_homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, words + 1)]
            for anchors, _, home in code.anchors(np.stack(columns, axis=1).view(_U)):
                yield pa.record_batch([pa.array(anchors[home].view(np.int64))], names=["anchor"])

    homes = prints.mapInArrow(count_homes, "anchor long").groupBy("anchor").count()
    if homes.where(F.col("count") > HOMES_PER_PIECE).isEmpty():
        cells = spread.withColumn("piece", F.lit(0).cast("long"))
    else:
        met = spread.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
        hot = written(met.where((F.col("homes") > HOMES_PER_PIECE) | (F.col("n") > ROWS_PER_PIECE)), "hot")
        parts = lambda count, size: F.ceil(F.coalesce(count, F.lit(1)) / size).cast("long")
        marked = spread.join(hot, "anchor", "left").withColumns(
            {"for_homes": parts("homes", HOMES_PER_PIECE), "for_rows": parts("n", ROWS_PER_PIECE)}
        )
        place = lambda parts: F.pmod(F.xxhash64("node"), F.col(parts))
        every = lambda parts: F.sequence(F.lit(0).cast("long"), F.col(parts) - 1)
        cell = lambda mine, other, home: F.struct((mine * F.col("for_rows") + other).alias("piece"), F.lit(home).alias("at_home"))
        at_home = F.when(F.col("home"), F.transform(every("for_rows"), lambda q: cell(place("for_homes"), q, True))).otherwise(F.array())
        # a home lies in its own part of the rows as well, but not beside itself
        come = F.transform(every("for_homes"), lambda p: cell(p, place("for_rows"), False))
        come = F.filter(come, lambda c: ~F.col("home") | (F.floor(c["piece"] / F.col("for_rows")) != place("for_homes")))
        both = marked.withColumn("cell", F.explode(F.concat(at_home, come)))
        cells = both.select("anchor", F.col("cell.piece").alias("piece"), F.col("cell.at_home").alias("home"), "node", *(f"f{k}" for k in range(words)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # what has come of the cell that is open; rows are sorted by cell

        def whole() -> pa.RecordBatch:
            return _links_of([np.concatenate(parts) for parts in zip(*held)], code)

        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(words + 4)]
            if not len(columns[0]):
                continue
            last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
            cut = int(np.argmax(last))
            if cut:
                held.append([c[:cut] for c in columns])
            if held and (held[-1][0][-1], held[-1][1][-1]) != (columns[0][-1], columns[1][-1]):
                yield whole()
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            yield whole()

    order = ["anchor", "piece"]
    cells = cells.select(*order, "home", "node", *(f"f{k}" for k in range(words)))
    return cells.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "a long, b long")


def _links_of(columns: list[np.ndarray], code: HammingHalves) -> pa.RecordBatch:
    """Links of complete cells, whose rows lie together."""
    anchor, piece, home, node = columns[:4]
    prints = np.stack(columns[4:], axis=1).view(_U)
    home = home.astype(bool)
    starts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])])
    ends = np.r_[starts[1:], len(anchor)]
    homes = np.add.reduceat(home.astype(np.int64), starts)
    links: list[tuple[int, int]] = []
    for k in np.flatnonzero((homes > 0) & (ends - starts > 1)):
        cell = slice(starts[k], ends[k])
        links += _forest(int(anchor[starts[k]]), node[cell], prints[cell], home[cell], code)
    a, b = np.array(links, dtype=np.int64).reshape(-1, 2).T
    return pa.record_batch([pa.array(a.copy()), pa.array(b.copy())], names=["a", "b"])


def _forest(
    anchor: int, node: np.ndarray, prints: np.ndarray, home: np.ndarray, code: HammingHalves
) -> list[tuple[int, int]]:
    """A forest with the components that the homes and all others of a cell have by their links, home by home."""
    links: list[tuple[int, int]] = []
    group = None
    for mine, others in code.pairs(anchor, prints, np.flatnonzero(home)):
        apart = np.bitwise_count(prints[mine] ^ prints[others]).sum(axis=1, dtype=np.int64)
        near = others[apart <= code.threshold]
        if len(near) > 1:  # itself is always there
            group = np.arange(len(node)) if group is None else group
            met = np.unique(group[near])
            if len(met) > 1:
                links += [(int(node[met[0]]), int(node[k])) for k in met[1:]]
                group[np.isin(group, met)] = met[0]
    return links
