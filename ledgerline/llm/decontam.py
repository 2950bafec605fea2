"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming lookup, exact check.

Every benchmark item of n words has a 64-bit SimHash of its words, weighted by
how rare they are among all items of the benchmark, whatever slice they are in.  A document's windows of n words are
fingerprinted alike, at every position, from prefix sums over the words.  The
fingerprint is cut into four blocks of 16 bits; a pair within 15 bits has, by
the pigeonhole principle, a block with at most three wrong bits, so items are
listed under all values that near each of their blocks and no pair within the
radius is missed.  The lists also hold most pairs somewhat farther apart, which
short items with words changed at their ends may be; pairs within 24 bits are
confirmed by the exact weighted similarity of their five-word shingles.

An item of fewer than five words is one shingle, its whole word sequence, and
is found where these words stand.

Windows without any five-word shingle of an item have a similarity of zero and
are skipped; this loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import int_ranges, map_arrow, text_hash
from .shingles import hash_shingles, hash_words, mix, text_slices

WIDTH = 5
BLOCKS, BLOCK_BITS, BLOCK_ERRORS = 4, 16, 3
RADIUS = BLOCKS * (BLOCK_ERRORS + 1) - 1  # no pair within it is missed
REACH = 24  # pairs up to it that the index lists are verified too
SIMILARITY = 0.8
ITEMS_PER_SLICE = 2000
_BITS = np.arange(64, dtype=np.uint64)
_FILTER_SHIFT = np.uint64(44)


def signs(words: np.ndarray) -> np.ndarray:
    """+1 or -1 for each word and each of 64 bits."""
    bits = (mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5))[:, None] >> _BITS) & np.uint64(1)
    return bits.astype(np.int64) * 2 - 1


def to_fingerprints(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each row of bit sums: a bit is set where its sum is positive."""
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def near_values(errors: int, bits: int) -> np.ndarray:
    """All masks with at most ``errors`` bits set."""
    return np.array([sum(1 << b for b in c) for k in range(errors + 1) for c in combinations(range(bits), k)], np.uint32)


def item_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(words, number of items with each, number of items) of a text column's items that have words."""
    seen, n = [np.zeros(0, np.uint64)], 0
    for _, _, data, offsets in text_slices(column):
        words, bounds = hash_words(data, offsets)
        for i in np.flatnonzero(np.diff(bounds) > 0):
            seen.append(np.unique(words[bounds[i]:bounds[i + 1]]))
            n += 1
    return *np.unique(np.concatenate(seen), return_counts=True), n


@dataclass
class WordWeights:
    """Weight of each word: rarer among the items is heavier; a word of one item or of none is heaviest.

    Only words of two items or more are listed: the others all have the weight ``rare``.
    """

    words: np.ndarray
    weights: np.ndarray
    rare: int

    @staticmethod
    def of(words: np.ndarray, per_word: np.ndarray, items: int) -> WordWeights:
        many = np.flatnonzero(per_word > 1)
        many = many[np.argsort(words[many])]
        weights = np.rint(16 * np.log2(1 + items / per_word[many])).astype(np.int64)
        return WordWeights(words[many], weights, int(np.rint(16 * np.log2(1 + max(1, items)))))

    def weigh(self, words: np.ndarray) -> np.ndarray:
        """Weight of each word."""
        if not len(self.words):
            return np.full(len(words), self.rare, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.weights[at], self.rare)


def word_weights(items: DataFrame) -> WordWeights:
    """Weights by how many of all ``items`` (text) have each word, counted by one groupBy; the words of two or more reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, per_word, n = item_words(batch.column(0))
            # the row without a word has the number of items
            yield pa.RecordBatch.from_arrays([pa.array([*words.view(np.int64).tolist(), None], pa.int64()),
                                              pa.array([*per_word.tolist(), n], pa.int64())], names=["word", "n"])

    counts = map_arrow(items.select("text"), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = counts.where("word is null or n > 1").toArrow()
    listed = found.filter(found.column("word").is_valid())
    n = found.filter(found.column("word").is_null()).column("n").to_pylist()
    return WordWeights.of(listed.column("word").to_numpy().astype(np.int64).view(np.uint64), listed.column("n").to_numpy().astype(np.int64), sum(n))


@dataclass
class ItemIndex:
    """A slice of the benchmark items, made for lookups by numpy."""

    ids: list[int | None]
    sizes: np.ndarray
    prints: np.ndarray
    starts: list[np.ndarray]
    listed: list[np.ndarray]
    weights: WordWeights | None
    shingles: list[np.ndarray]
    shingle_counts: list[np.ndarray]
    shingle_weights: list[np.ndarray]
    totals: np.ndarray
    all_shingles: np.ndarray
    filter: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def build(ids: list[int | None], texts: list[str], weights: WordWeights | None = None) -> ItemIndex:
        """Index of all items that have words.

        ``short`` has, for each size under five words, the sorted shingles of such items and their places.
        ``weights`` are those of the whole benchmark; without them, these items are all of it.
        """
        words, bounds = [], [0]
        for _, _, data, offsets in text_slices(pa.array(texts, pa.string())):
            w, b = hash_words(data, offsets)
            words.append(w)
            bounds += (b[1:] + bounds[-1]).tolist()
        words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        bounds = np.array(bounds, np.int64)
        long, few = np.flatnonzero(np.diff(bounds) >= WIDTH), np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < WIDTH))
        lists = [words[bounds[i]:bounds[i + 1]] for i in long]
        if weights is None:
            weights = WordWeights.of(*item_words(pa.array(texts, pa.string())))
        out = ItemIndex([ids[i] for i in [*long, *few]], np.array([len(w) for w in lists], np.int64), np.zeros(0, np.uint64),
                        [], [], weights, [], [], [], np.zeros(len(lists), np.int64), np.zeros(0, np.uint64), np.zeros(1 << 20, bool), {})
        for size in range(1, WIDTH):
            own = [(hash_shingles(words[bounds[i]:bounds[i + 1]], np.array([0, size]), size)[0][0], len(long) + k)
                   for k, i in enumerate(few) if bounds[i + 1] - bounds[i] == size]
            if own:
                own.sort()
                out.short[size] = np.array([h for h, _ in own], np.uint64), np.array([k for _, k in own], np.int64)
        prints = []
        for k, w in enumerate(lists):
            weight = weights.weigh(w)
            prints.append(to_fingerprints((signs(w) * weight[:, None]).sum(axis=0)[None, :])[0])
            values, _ = hash_shingles(w, np.array([0, len(w)]), WIDTH)
            each, first, count = np.unique(values, return_index=True, return_counts=True)
            by_shingle = np.convolve(weight, np.ones(WIDTH, np.int64), "valid")
            out.shingles.append(each)
            out.shingle_counts.append(count)
            out.shingle_weights.append(by_shingle[first])
            out.totals[k] = by_shingle.sum()
        out.prints = np.array(prints, np.uint64)
        masks = near_values(BLOCK_ERRORS, BLOCK_BITS)
        for b in range(BLOCKS):
            block = ((out.prints >> np.uint64(BLOCK_BITS * b)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint32)
            value = (block[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(value, kind="stable")
            out.starts.append(np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1)))
            out.listed.append((order // len(masks)).astype(np.int32))
        out.all_shingles = np.unique(np.concatenate(out.shingles)) if lists else np.zeros(0, np.uint64)
        out.filter[(out.all_shingles >> _FILTER_SHIFT).astype(np.int64)] = True
        return out

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Places of shingles that some item has."""
        at = np.flatnonzero(self.filter[(shingles >> _FILTER_SHIFT).astype(np.int64)])
        if not len(at) or not len(self.all_shingles):
            return at[:0]
        found = np.minimum(np.searchsorted(self.all_shingles, shingles[at]), len(self.all_shingles) - 1)
        return at[self.all_shingles[found] == shingles[at]]

    def near(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of pairs of windows and items of ``size`` words: all within RADIUS, and those up to REACH that share a listed block."""
        windows, items = [], []
        for b in range(BLOCKS):
            value = ((prints >> np.uint64(BLOCK_BITS * b)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            lo, hi = self.starts[b][value], self.starts[b][value + 1]
            w = np.repeat(np.arange(len(prints)), hi - lo)
            i = self.listed[b][int_ranges(lo, hi - lo)].astype(np.int64)
            keep = self.sizes[i] == size
            w, i = w[keep], i[keep]
            keep = np.bitwise_count(prints[w] ^ self.prints[i]) <= REACH
            windows.append(w[keep])
            items.append(i[keep])
        pairs = np.unique(np.concatenate(windows) * len(self.ids) + np.concatenate(items))
        return pairs // len(self.ids), pairs % len(self.ids)

    def similarity(self, shingles: np.ndarray, weights: np.ndarray, item: int) -> float:
        """Weight of shared shingles (as often as both have them) over the mean weight of window and item."""
        known = self.shingles[item]
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        at = at[known[at] == shingles]
        both = np.minimum(np.bincount(at, minlength=len(known)), self.shingle_counts[item])
        return float(2 * (both * self.shingle_weights[item]).sum() / (self.totals[item] + weights.sum()))

    def search_column(self, column: pa.Array) -> Iterator[tuple[int, dict[int, tuple[float, int, int]]]]:
        """(row, items found) of the rows of a text column that share a shingle with an item."""
        for lo, _, data, offsets in text_slices(column):
            words, bounds = hash_words(data, offsets)
            shingles, at = hash_shingles(words, bounds, WIDTH)
            found = self.search_short(words, bounds)
            for d in np.unique(np.searchsorted(at, self.hits(shingles), side="right") - 1).tolist():
                found.setdefault(d, {}).update(self.search(words[bounds[d]:bounds[d + 1]], shingles[at[d]:at[d + 1]]))
            yield from ((lo + d, found[d]) for d in sorted(found))

    def search_short(self, words: np.ndarray, bounds: np.ndarray) -> dict[int, dict[int, tuple[float, int, int]]]:
        """By row, the items of fewer than five words whose words stand in it, at their first place."""
        out: dict[int, dict[int, tuple[float, int, int]]] = {}
        for size, (known, items) in self.short.items():
            runs, at = hash_shingles(words, bounds, size)
            place = np.flatnonzero(known[np.minimum(np.searchsorted(known, runs), len(known) - 1)] == runs)
            rows = np.searchsorted(at, place, side="right") - 1
            whole = np.diff(bounds)[rows] >= size  # a shorter text is a shingle of its own
            for p, d in zip(place[whole].tolist(), rows[whole].tolist()):
                for k in range(np.searchsorted(known, runs[p]), np.searchsorted(known, runs[p], side="right")):
                    out.setdefault(d, {}).setdefault(int(items[k]), (1.0, p - int(at[d]), size))
        return out

    def search(self, words: np.ndarray, shingles: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Best (similarity, first word, words) of each item found in a document's words."""
        hits = self.hits(shingles)
        best: dict[int, tuple[float, int, int]] = {}
        if not len(hits) or len(words) < WIDTH:
            return best
        weight = self.weights.weigh(words)
        by_shingle = np.convolve(weight, np.ones(WIDTH, np.int64), "valid")
        widest = int(self.sizes.max())
        cuts = np.flatnonzero(np.diff(hits) > widest) + 1
        for part in np.split(hits, cuts):
            base = max(0, int(part[0]) - widest)
            end = min(len(words), int(part[-1]) + widest + WIDTH)
            sums = np.zeros((end - base + 1, 64), np.int64)
            np.cumsum(signs(words[base:end]) * weight[base:end, None], axis=0, out=sums[1:])
            for size in np.unique(self.sizes).tolist():
                span = min(size, len(words))
                starts = np.unique((part[:, None] - np.arange(span - WIDTH + 1)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts <= len(words) - span)]
                if not len(starts):
                    continue
                prints = to_fingerprints(sums[starts + span - base] - sums[starts - base])
                for w, i in zip(*(x.tolist() for x in self.near(prints, size))):
                    lo = int(starts[w])
                    inner = slice(lo, lo + span - WIDTH + 1)
                    s = self.similarity(shingles[inner], by_shingle[inner], i)
                    if s >= SIMILARITY and (i not in best or s > best[i][0]):
                        best[i] = (s, lo, span)
        return best


def item_slices(benchmark: DataFrame, item_col: str, item_text_col: str) -> Iterator[Callable[[], ItemIndex]]:
    """For all tasks, indexes of the items in slices of bounded size, one by one; all have the weights of the whole benchmark."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null")
    parts = max(1, -(-items.count() // ITEMS_PER_SLICE))
    weights = word_weights(items)
    sc = benchmark.sparkSession.sparkContext
    shared_weights = sc.broadcast(weights)
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").collect()
        index = ItemIndex.build([r["item_id"] for r in rows], [r["text"] for r in rows], weights)
        shared = sc.broadcast(replace(index, weights=None))  # the weights go to each task's machine once, not with each slice
        yield lambda shared=shared: replace(shared.value, weights=shared_weights.value)


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold a benchmark item: doc_id, row (``text_hash``), item_id, first_word, n_words, similarity.

    One row per document row and item, for the window of the highest
    similarity (0.8 or more), the first among equals; words are runs without
    ASCII white space, A-Z lower-cased.  A document shorter than an item is one
    window.  An item of fewer than five words is found where exactly these words
    stand side by side.  Null and empty texts and items, and those without words,
    match nothing.  Texts of any length are searched whole, stretch by stretch
    around shared shingles.  Null ids are kept; repeated rows and items give
    repeated rows.  Other columns are not read.  Empty tables give an empty table.

    The items are read in slices of about 2,000 (by a hash), each of which goes
    to all tasks; documents are never shuffled.  Words are weighted over all
    items, so the result does not depend on the slices.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    schema = "doc_id long, row long, item_id long, first_word long, n_words long, similarity double"
    out = None
    for index_of in item_slices(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], index_of=index_of) -> Iterator[pa.RecordBatch]:
            index = index_of()
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            names = ["doc_id", "row", "item_id", "first_word", "n_words", "similarity"]
            for batch in batches:
                rows = []
                for d, found in index.search_column(batch.column("text")):
                    where = batch.column("doc_id")[d].as_py(), batch.column("row")[d].as_py()
                    rows += [(*where, index.ids[i], first, n, s) for i, (s, first, n) in sorted(found.items())]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=names)

        part = map_arrow(source, run, schema)
        out = part if out is None else out.union(part)
    return out


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, in which ``find_passages`` finds no benchmark item; no shuffle."""
    at = docs.columns.index(text_col)
    for index_of in item_slices(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], index_of=index_of) -> Iterator[pa.RecordBatch]:
            index = index_of()
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, found in index.search_column(batch.column(at)) if found]] = False
                yield batch.filter(pa.array(keep))

        docs = map_arrow(docs, run, docs.schema)
    return docs
