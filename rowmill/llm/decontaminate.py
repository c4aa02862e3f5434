"""Benchmark passages in documents by spaced seeds: hashes that ignore some token positions."""

from __future__ import annotations

import unicodedata
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import remembered, utf8
from rowmill.llm.sharding import shard_by_bytes

#: Tokens of the shortest overlap, the share of them that must be equal, and the shortest item that is looked for.
WINDOW, LEAST_EQUAL, LEAST_ITEM = 13, 0.8, 5
#: The window's blocks; a mask ignores two of them, so any two substituted tokens in a window are ignored by some mask.
BLOCKS = ((0, 3), (3, 6), (6, 9), (9, 11), (11, 13))
MASKS = tuple(tuple(b for b in range(len(BLOCKS)) if b not in pair) for pair in combinations(range(len(BLOCKS)), 2))
#: Bytes of benchmark text that are sent to the executors at once; more is worked off slice by slice.
SLICE_BYTES = 1 << 20
#: Bytes of documents that one piece of work holds (one document at least).
PIECE_BYTES = 2 << 20
#: A seed's first look-up is in a table of two to this power entries per mask.
FILTER_BITS = 20

# letters and digits are kept and lower-cased, other ASCII characters separate tokens
_SEPARATE = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256)).lower()


@remembered
def _instead(character: str) -> str | None:
    """What stands for a character beyond ASCII: a blank for punctuation, symbols and blanks of all scripts, a token of
    its own for writing without blanks between words; None for the others, which stay."""
    if unicodedata.category(character)[0] in "PSZC":
        return " "
    return f" {character} " if unicodedata.name(character, "").startswith(_UNSPACED) else None


#: How the names of characters begin in writing that has no blanks between words.
_UNSPACED = ("CJK UNIFIED", "CJK COMPAT", "HIRAGANA", "KATAKANA", "THAI CHAR")
_SPREAD = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(WINDOW)], dtype=np.uint64)


def tokens_of(text: bytes | None) -> np.ndarray:
    """Hashes of a text's lower-cased words, in order; of Chinese, Japanese and Thai writing each character is one."""
    text = text or b""
    if not text.isascii():
        decoded = text.decode("utf-8", "replace").lower()
        others = {c: new for c in set(decoded) if c > "\x7f" and (new := _instead(c))}
        if len(others) < 20:
            for character, new in others.items():
                decoded = decoded.replace(character, new)
        else:
            decoded = decoded.translate(str.maketrans(others))
        text = decoded.encode()
    words = text.translate(_SEPARATE).split()
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


def seeds_of(tokens: np.ndarray) -> list[np.ndarray]:
    """For every mask the seeds of all windows of a token sequence."""
    count = len(tokens) - WINDOW + 1
    if count <= 0:
        return [np.zeros(0, dtype=np.uint64)] * len(MASKS)
    blocks = []
    for start, end in BLOCKS:
        total = np.zeros(count, dtype=np.uint64)
        for i in range(start, end):
            total += tokens[i : i + count] * _SPREAD[i]
        blocks.append(total)
    return [np.sum([blocks[b] for b in mask], axis=0, dtype=np.uint64) for mask in MASKS]


class Slice:
    """Benchmark items with the sorted seeds of their windows, of bounded size."""

    def __init__(self, items: list[tuple]):
        self.ids = [item for item, _ in items]
        tokens = [tokens_of(text) for _, text in items]
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.tokens = np.concatenate([*tokens, np.zeros(0, dtype=np.uint64)])
        self.masks = []
        seeds = [seeds_of(t) for t in tokens]
        places = [s + np.arange(max(0, n - WINDOW + 1)) for s, n in zip(self.starts, self.lengths)]
        owners = [np.full(len(p), i) for i, p in enumerate(places)]
        place, owner = (np.concatenate([*x, np.zeros(0, dtype=np.int64)]).astype(np.int64) for x in (places, owners))
        for m in range(len(MASKS)):
            own = np.concatenate([*(s[m] for s in seeds), np.zeros(0, dtype=np.uint64)])
            order = np.argsort(own, kind="stable")
            some = np.zeros(1 << FILTER_BITS, dtype=bool)
            some[own >> np.uint64(64 - FILTER_BITS)] = True
            self.masks.append((own[order], place[order], owner[order], some))
        # items shorter than a window are looked for as a whole, without substitutions
        self.short: dict[int, dict[bytes, list[int]]] = {}
        for i, t in enumerate(tokens):
            if LEAST_ITEM <= len(t) < WINDOW:
                self.short.setdefault(len(t), {}).setdefault(t.tobytes(), []).append(i)

    def hits(self, tokens: np.ndarray) -> np.ndarray:
        """Distinct (token position less item position, item) of all equal seeds; positions in the given sequence."""
        found = [np.zeros((0, 2), dtype=np.int64)]
        for (seeds, place, owner, some), own in zip(self.masks, seeds_of(tokens)):
            where = np.flatnonzero(some[own >> np.uint64(64 - FILTER_BITS)])
            low = np.searchsorted(seeds, own[where], "left")
            count = np.searchsorted(seeds, own[where], "right") - low
            if count.any():
                index = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                items = owner[index]
                shift = np.repeat(where, count) - (place[index] - self.starts[items])
                found.append(np.unique(np.stack([shift, items], axis=1), axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def overlaps(self, tokens: np.ndarray, hits: np.ndarray) -> list[tuple]:
        """Verified overlaps ``(id, doc_start, item_start, n_tokens, n_equal)`` of one document."""
        out = []
        for shift, item in hits.tolist():
            first, length = max(0, -shift), int(self.lengths[item])
            last = min(length, len(tokens) - shift)
            own = self.tokens[self.starts[item] + first : self.starts[item] + last]
            for start, size, equal in all_overlaps(tokens[shift + first : shift + last] == own):
                out.append((self.ids[item], shift + first + start, first + start, size, equal))
        for length, sequences in self.short.items():
            if len(tokens) >= length:
                windows = np.lib.stride_tricks.sliding_window_view(tokens, length)
                heads = np.array([np.frombuffer(s, dtype=np.uint64)[0] for s in sequences])
                for at in np.flatnonzero(np.isin(windows[:, 0], heads)).tolist():
                    for item in sequences.get(windows[at].tobytes(), ()):
                        out.append((self.ids[item], at, 0, length, length))
        return out


def best_overlap(equal: np.ndarray) -> tuple[int, int, int] | None:
    """Start, length and equal tokens of the best stretch of at least ``WINDOW`` tokens, or None if none is good enough.

    An equal token scores ``1 - LEAST_EQUAL``, another costs ``LEAST_EQUAL``, so a score of 0 or more is a share of at
    least ``LEAST_EQUAL``; the highest score is best, of equal ones the first that ends.
    """
    if len(equal) < WINDOW:
        return None
    # in fifths, so that the sums are exact
    gain, cost = round(5 * (1 - LEAST_EQUAL)), round(5 * LEAST_EQUAL)
    sums = np.concatenate([[0], np.cumsum(np.where(equal, gain, -cost))])
    lowest = np.minimum.accumulate(sums[: len(sums) - WINDOW])
    scores = sums[WINDOW:] - lowest
    end = int(np.argmax(scores))
    if scores[end] < 0:
        return None
    start = int(np.argmin(sums[: end + 1]))
    return start, end + WINDOW - start, int(equal[start : end + WINDOW].sum())


def all_overlaps(equal: np.ndarray) -> list[tuple[int, int, int]]:
    """All stretches of an alignment, in order: the best one, and those of what lies before and behind it."""
    found, open_parts = [], [(0, len(equal))]
    while open_parts:
        low, high = open_parts.pop()
        best = best_overlap(equal[low:high])
        if best:
            start, size, same = best
            found.append((low + start, size, same))
            open_parts += [(low, low + start), (low + start + size, high)]
    return sorted(found)


def overlaps_in(text: Column, piece: Slice, item_type: str) -> Column:
    """The verified overlaps of a text with a slice of the benchmark, as an array of structs."""
    fields = ("item_id", "doc_start", "item_start", "n_tokens", "n_equal")

    @F.arrow_udf(f"array<struct<item_id:{item_type},doc_start:int,item_start:int,n_tokens:int,n_equal:int>>")
    def find(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        group: list[np.ndarray] = []
        size = 0

        def flush() -> None:
            nonlocal size
            # documents end to end, with room between them that no item's window can match
            gap = np.arange(WINDOW, dtype=np.uint64) + np.uint64(1 << 40)
            joined = np.concatenate([x for tokens in group for x in (tokens, gap)] or [gap])
            starts = np.concatenate([[0], np.cumsum([len(t) + WINDOW for t in group])])[: len(group)].astype(np.int64)
            hits = piece.hits(joined)
            # an alignment may begin before the document's first token, where the item's start is cut off
            reach = hits[:, 0] + piece.lengths[hits[:, 1]] - 1 if len(hits) else hits[:, 0]
            for k, tokens in enumerate(group):
                begin, end = starts[k], starts[k] + len(tokens)
                own = hits[(reach >= begin) & (hits[:, 0] < end)]
                own = np.stack([own[:, 0] - begin, own[:, 1]], axis=1)
                out.append([dict(zip(fields, o)) for o in piece.overlaps(tokens, own)])
            group.clear()
            size = 0

        for text in texts:
            value = text.as_py()
            group.append(tokens_of(value))
            size += len(value or b"")
            if size >= PIECE_BYTES:
                flush()
        if group:
            flush()
        return pa.array(out, kind)

    kind = pa.list_(
        pa.struct([("item_id", _ARROW[item_type])] + [(name, pa.int32()) for name in fields[1:]])
    )
    return find(utf8(text))


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def benchmark_slices(benchmark: DataFrame, item_column: str, text_column: str) -> list[Slice]:
    """The benchmark in slices of at most ``SLICE_BYTES`` and one item; each is small enough for driver and executors."""
    text = F.col(f"`{text_column}`")
    items = benchmark.select(F.col(f"`{item_column}`").alias("item"), text.cast("binary").alias("text")).where(
        "text is not null"
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = -(-total // SLICE_BYTES)
    if count <= 1:
        return [Slice([(r["item"], bytes(r["text"])) for r in items.collect()])]
    cut = shard_by_bytes(items, count, F.octet_length("text"), [F.col("item"), F.xxhash64("text")])
    parts = (cut.where(F.col("shard") == n).select("item", "text").collect() for n in range(count))
    return [Slice([(r["item"], bytes(r["text"])) for r in rows]) for rows in parts]


def overlaps(
    df: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> Column:
    """A column for ``df``: all overlaps of its text with benchmark items, an array of
    ``(item_id, doc_start, item_start, n_tokens, n_equal)`` with positions in tokens.

    Both sides' texts are lower-cased and cut into words at everything but letters and digits, in all scripts; where
    words are written without blanks between them, each character is one. Every window of 13 tokens
    gives a seed per mask, a hash that ignores two of the window's five blocks; documents and benchmark are joined on
    them. Around a hit the two are aligned and compared token by token: an overlap is an aligned stretch of at least 13
    tokens of which 80 % are equal. So every overlap in which some 13 tokens have at most two substitutions is found.
    Items of 5 to 12 tokens are found as a whole, shorter ones say too little and are not looked for. A document may hold
    an item more than once and in parts: of each alignment the best stretch is given, then the best of what lies before
    and behind it, and so on.

    Null and empty texts have no overlaps, null items none either; repeated items are found under each of their ids.
    The benchmark is sent to the executors in slices of bounded size, so documents are never shuffled.
    """
    text, kind = F.col(f"`{text_column}`"), dict(benchmark.dtypes)[item_column]
    found = [overlaps_in(text, piece, kind) for piece in benchmark_slices(benchmark, item_column, item_text)]
    return found[0] if len(found) == 1 else F.concat(*found)
