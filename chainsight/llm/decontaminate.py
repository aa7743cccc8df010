"""Benchmark decontamination by SimHash over item-sized windows.

Every benchmark item of n words is compared with every window of n words of
every document.  A window is reported when its weighted 5-word-shingle
similarity to the item (sum of minimal over sum of maximal multiplicities) is
``THRESHOLD`` or more.  Steps, all inside one pass over the documents without a
shuffle:

1. Counting bound, which loses nothing: of the m shingles of such a window at
   least ``2 * t * m / (1 + t)`` occur in the item.  Windows without so many that
   occur in any item are not fingerprinted; for the others an inverted index from
   shingles to items gives the items that each of them holds so many of, whatever the
   number of items.
2. The window's SimHash, from prefix sums of the shingles' bits.
3. Multi-index Hamming blocks: the 64 bits are cut into ``BLOCKS`` blocks, and an item
   within ``RADIUS`` bits has a block within ``RADIUS // BLOCKS`` bits; a pair without such
   a block is out, the others are compared by all bits.  Where a window repeats a
   shingle, or some item of its size does, bits are no guide (see below) and this
   step is left out.
4. Exact weighted-shingle similarity, on the words themselves, of the pairs that remain.

The SimHash radius: where neither side repeats a shingle, the angle between the
two shingle vectors is at most 0.48 at similarity 0.8, so 9.7 bits differ on
average, with a standard deviation of 2.9; the radius lies more than four
deviations above.  Repeats weigh more in the angle than in the similarity (1000
shingles of which 111 are one repeated shingle: about 27 bits), hence the exception in step 3.

The benchmark goes to the tasks in blocks of at most ``BLOCK_WORDS`` words; the
documents are read once for each block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 22
BLOCKS = 4
BLOCK_WORDS = 1_000_000  # words of benchmark items that a task holds
PART = 8192              # window starts that are fingerprinted together
KNOWN = 500_000          # word hashes that a task remembers

WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORD.findall((text or "").lower())


def word_hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    if len(known) > KNOWN:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.array([known[w] for w in words], np.uint64)


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Well-mixed hashes of all runs of k words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    for shift in (33, 29):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(0xFF51AFD7ED558CCD)
    return out ^ (out >> np.uint64(32))


def bit_sums(shingles: np.ndarray) -> np.ndarray:
    """Prefix sums, with a leading zero row, of +1 for a set bit and -1 for others."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, out=sums[1:])
    return sums


def repeats_within(shingles: np.ndarray) -> np.ndarray:
    """For each place the latest start of a window that ends there and repeats a shingle; -1: none."""
    order = np.argsort(shingles, kind="stable")
    same = shingles[order[1:]] == shingles[order[:-1]]
    earlier = np.full(len(shingles), -1)
    earlier[order[1:][same]] = order[:-1][same]
    return np.maximum.accumulate(earlier)


def pack_bits(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    shared = sum((a & b).values())
    return shared / (a.total() + b.total() - shared)


def shingle_counts(words: list[str], k: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(k))))


class Items:
    """Search structure over one block of benchmark items."""

    def __init__(self, items: list[tuple[object, list[str]]]):
        known: dict[str, int] = {}
        self.items = items
        self.by_size: dict[int, dict] = {}
        shingles: dict[int, list[np.ndarray]] = {}
        for at, (_, words) in enumerate(items):
            k = min(SHINGLE, len(words))
            own = shingle_hashes(word_hashes(words, known), k)
            shingles.setdefault(k, []).append(own)
            group = self.by_size.setdefault(len(words), {"k": k, "at": [], "code": [], "own": [], "repeats": False})
            group["own"].append(np.unique(own))
            group["repeats"] |= len(group["own"][-1]) < len(own)
            group["at"].append(at)
            group["code"].append(pack_bits(bit_sums(own)[-1:])[0])
        self.tables = {}  # shingle length -> sorted shingles of all items, and a bit table over them
        for k, parts in shingles.items():
            every = np.unique(np.concatenate(parts))
            bits = np.zeros(1 << max(16, math.ceil(math.log2(16 * len(every)))), bool)
            bits[every & np.uint64(len(bits) - 1)] = True
            self.tables[k] = every, bits
        for group in self.by_size.values():
            group["code"], group["at"] = np.array(group["code"], np.uint64), np.array(group["at"])
            own = group.pop("own")
            holder = np.repeat(np.arange(len(own)), [len(x) for x in own])
            own = np.concatenate(own)
            order = np.argsort(own, kind="stable")
            group["shingles"], group["holder"] = own[order], holder[order]  # and the items that hold them

    def within(self, size: int, codes: np.ndarray, window: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which pairs (window, place in the size's group) lie within the radius."""
        apart = codes[window] ^ self.by_size[size]["code"][item]
        width = 64 // BLOCKS
        near = np.zeros(len(apart), bool)
        for b in range(BLOCKS):
            block = (apart >> np.uint64(b * width)) & np.uint64((1 << width) - 1)
            near |= np.bitwise_count(block) <= RADIUS // BLOCKS
        near[near] = np.bitwise_count(apart[near]) <= RADIUS
        return near

    def sharing(self, size: int, shingles: np.ndarray, starts: np.ndarray, span: int, need: int):
        """(window, place in the size's group) of all windows with ``need`` or more
        shingles that occur in that item."""
        group = self.by_size[size]
        low = np.searchsorted(group["shingles"], shingles, "left")
        many = np.searchsorted(group["shingles"], shingles, "right") - low
        total = np.concatenate(([0], np.cumsum(many > 0)))
        for window in np.flatnonzero(total[starts + span] - total[starts] >= need).tolist():
            at = slice(int(starts[window]), int(starts[window]) + span)
            first, n = low[at], many[at]
            every = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
            places, count = np.unique(group["holder"][every], return_counts=True)
            for place in places[count >= need].tolist():
                yield window, place

    def hits(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """Which shingles occur in some item."""
        every, bits = self.tables[k]
        hit = bits[shingles & np.uint64(len(bits) - 1)]
        some = np.flatnonzero(hit)
        at = np.searchsorted(every, shingles[some])
        at[at == len(every)] = 0
        hit[some] = every[at] == shingles[some]
        return hit

    def find(self, text: str | None, known: dict[str, int]) -> list[dict]:
        """Best window of each item that the text holds."""
        words = words_of(text)
        if not words:
            return []
        hashes = word_hashes(words, known)
        best: dict[int, tuple] = {}
        for k in self.tables:
            shingles = shingle_hashes(hashes, k)
            hit = self.hits(shingles, k) if len(shingles) else shingles.astype(bool)
            if not hit.any():
                continue
            total = np.concatenate(([0], np.cumsum(hit)))
            repeats = None
            for size, group in self.by_size.items():
                if group["k"] != k:
                    continue
                m = size - k + 1
                span = min(m, len(shingles))  # a shorter text is one window
                need = math.ceil(THRESHOLD * (m + span) / (1 + THRESHOLD) - 1e-9)
                starts = np.flatnonzero(total[span:] - total[:-span] >= need)
                if not len(starts):
                    continue
                repeats = repeats_within(shingles) if repeats is None else repeats
                # a window of the same shingles as the one before it can't be better
                old = (starts > 0) & (shingles[starts - 1] == shingles[starts + span - 1])
                starts = starts[~old]
                again = (repeats[starts + span - 1] >= starts) | group["repeats"]
                self.compare(words, shingles, size, k, span, need, starts[~again], True, best)
                self.compare(words, shingles, size, k, span, need, starts[again], False, best)
        return [{"item": self.items[i][0], "similarity": -s, "start": start, "words": n, "bits": bits}
                for i, (s, start, n, bits) in sorted(best.items())]

    def compare(self, words, shingles, size, k, span, need, starts, by_bits, best) -> None:
        """Exact similarity of the windows to the items of which they hold ``need`` shingles and,
        ``by_bits``, whose fingerprints lie within the radius."""
        group = self.by_size[size]
        at = 0
        while at < len(starts):
            end = int(np.searchsorted(starts, starts[at] + PART))
            some, at = starts[at:end], end
            low = int(some[0])
            sums = bit_sums(shingles[low:int(some[-1]) + span])
            codes = pack_bits(sums[some - low + span] - sums[some - low])
            pairs = np.array(list(self.sharing(size, shingles[low:int(some[-1]) + span], some - low, span, need)),
                             np.int64).reshape(-1, 2)
            if by_bits:
                pairs = pairs[self.within(size, codes, pairs[:, 0], pairs[:, 1])]
            for window, place in pairs.tolist():
                item, start = int(group["at"][place]), int(some[window])
                n = min(size, len(words))
                score = similarity(shingle_counts(words[start:start + n], k),
                                   shingle_counts(self.items[item][1], k))
                if score >= THRESHOLD:
                    bits = int(np.bitwise_count(codes[window] ^ group["code"][place]))
                    best[item] = min(best.get(item, (0.0,)), (-score, start, n, bits))


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str,
                block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[object, list[str]]]]:
    """Benchmark items with their words, in blocks; items without words are none."""
    held, size = [], 0
    for row in benchmark.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).toLocalIterator():
        words = words_of(row[1])
        if not words:
            continue
        if held and size + len(words) > block_words:
            yield held
            held, size = [], 0
        held.append((row[0], words))
        size += len(words)
    if held:
        yield held


def leak_column(text: Column, items: list[tuple[object, list[str]]], id_type: T.DataType) -> Column:
    """array<struct(item, similarity, start, words, bits)> of a text column."""
    kind = T.ArrayType(T.StructType([
        T.StructField("item", id_type), T.StructField("similarity", T.DoubleType()),
        T.StructField("start", T.IntegerType()), T.StructField("words", T.IntegerType()),
        T.StructField("bits", T.IntegerType())]))
    index, arrow = Items(items), to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}
        for texts in batches:
            yield pa.array([index.find(t.as_py(), known) for t in texts], arrow)
    return run(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(``id_col``, ``item_col``, similarity, start_word, n_words, bits): for each
    document and benchmark item the most similar window of that item's size
    (ties: the first one), where the similarity is 0.8 or more.

    Items of fewer than five words have one shingle, all their words; items
    without words match nothing.  A document with fewer words than an item is
    one window.  Null or empty texts hold nothing; null ids are kept; repeated
    documents or items are matched each for itself; an empty table on either
    side gives no rows.  Other columns are not read."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    id_type = benchmark.schema[item_col].dataType
    found, several = None, None
    for block in item_blocks(benchmark, item_col, item_text_col):
        part = rows.select("doc", F.explode(leak_column(F.col("text"), block, id_type)).alias("m"))
        several = found is not None
        if several:  # hold one block at a time
            part = materialize(part)
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.where("false").select("doc", F.lit(None).cast(
            T.StructType([T.StructField("item", id_type), T.StructField("similarity", T.DoubleType()),
                          T.StructField("start", T.IntegerType()), T.StructField("words", T.IntegerType()),
                          T.StructField("bits", T.IntegerType())])).alias("m"))
    return found.select(F.col("doc").alias(id_col), F.col("m.item").alias(item_col), "m.similarity",
                        F.col("m.start").alias("start_word"), F.col("m.words").alias("n_words"), "m.bits")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    id_type = benchmark.schema[item_col].dataType
    for n, block in enumerate(item_blocks(benchmark, item_col, item_text_col)):
        docs = materialize(docs) if n else docs
        docs = docs.where(F.size(leak_column(F.col(f"`{text_col}`"), block, id_type)) == 0)
    return docs
