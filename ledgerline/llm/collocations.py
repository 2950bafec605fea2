"""Phrase collocations: contiguous phrases of two to four words that occur together more than their parts suggest.

Texts become streams of word numbers: a slice of texts is split by numpy on its
bytes, its different words are looked up in the table of frequent words, and
words that are too rare, and breaks between pieces, become 0.  By the Apriori rule no frequent phrase holds a rare word or
a rare shorter phrase, so candidates of one more word are looked for only
where both shorter phrases are frequent.

The frequent shorter phrases stand in a double-array trie (``base`` and
``check``; a state is a place of the arrays) that is broadcast; numpy advances
the states of positions of a stream by one word at a time and counts accepting
states with the word behind them, all occurrences of each; the counts of all
tasks are summed, which gives the candidates and their exact occurrences in
one pass.  A trie holds about ``TRIE_PHRASES`` phrases; more are dealt over
several tries by their first two words, so what the driver holds and
broadcasts stays bounded, and each position is walked in one trie only.  That
a candidate's last words are frequent too is looked up in a broadcast bitmap
of hashes; a false hit there only costs a row that the threshold drops.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batched, map_arrow, slices, stored, totals_before

LEAST = 30
LONGEST = 4
INSIDE_PERCENT = 80
REPORTED = 2000
SCALE = 2_000_000
SLICE = 2 << 20  # bytes of text split at a time
ROW_IDS = 1 << 15  # word numbers in a row of a stream
HELD = 1 << 18  # word numbers worked on at a time
TRIE_PHRASES = 125_000
PAIR_PASSES = 4  # over the streams for pairs, so that a task sums a part of its pairs at a time
FILTER_BITS = 1 << 26  # of the bitmap of shorter phrases, at most
FOLD, PRIME = 1_000_003_579, (1 << 31) - 1
VOCABULARY_WORDS, VOCABULARY_BYTES = 500_000, 16 << 20
ROOT = -1
WORDS = [f"w{i + 1}" for i in range(LONGEST)]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_KIND = np.zeros(256, np.uint8)  # 0 word, 1 space, 2 break
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, row of each word, piece of each word) of texts without nulls, A-Z lower-cased; piece numbers differ where a break lies between."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    size = int(ends[-1] - ends[0])
    if not size:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8, size, int(ends[0]))]
    ends = ends - ends[0]
    kind = _KIND[data]
    solid = kind == 0
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = ends[:-1][ends[:-1] < size]
    begins[first] = solid[first]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(ends[1:], starts, "right")
    pieces = np.cumsum(kind == 2, dtype=np.int32)[starts] + rows
    letters = data[solid]
    at = np.append(np.cumsum(solid, dtype=np.int32)[starts] - 1, len(letters)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters)), rows, pieces


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]:
    """For each slice of texts (columns text, lang): language and word of each different key, its count, and codes.

    ``codes`` holds 1 + the place of each word among the keys, and 0 at breaks.
    """
    for batch in batches:
        text, lang = batch.column("text"), batch.column("lang").dictionary_encode()
        codes_of, names = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), lang.dictionary
        for lo, hi in slices(pc.binary_length(text).to_pylist(), SLICE):
            words, rows, pieces = split_words(text.slice(lo, hi - lo))
            if not len(words):
                continue
            words = words.dictionary_encode()
            both = codes_of[lo:hi][rows] * len(words.dictionary) + words.indices.to_numpy()
            found, places, counts = np.unique(both, return_inverse=True, return_counts=True)
            lang_no, word_no = np.divmod(found, len(words.dictionary))
            moved = np.append(0, np.cumsum(pieces[1:] != pieces[:-1]))
            codes = np.zeros(len(places) + int(moved[-1]), np.int32)
            codes[np.arange(len(places)) + moved] = places + 1
            yield names.take(pa.array(lang_no)), words.dictionary.cast(pa.string()).take(pa.array(word_no)), counts, codes


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Null texts are empty, a null language is ``und``."""
    return docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, f over all texts; a task counts up to ``HELD`` different words before it hands them on."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> Iterator[pa.RecordBatch]:
            for part in batched(iter(held.items()), 1 << 14):
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in part], pa.string()), pa.array([k[1] for k, _ in part], pa.string()),
                                                  pa.array([n for _, n in part], pa.int64())], schema=schema)

        for langs, words, counts, _ in _split(batches):
            for key, n in zip(zip(langs.to_pylist(), words.to_pylist()), counts.tolist()):
                held[key] += n
            if len(held) > HELD // 2:
                yield from handed()
                held.clear()
        yield from handed()

    return stored(map_arrow(texts, run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")


def text_slices(texts: DataFrame) -> DataFrame:
    """Texts as numbered words, one row per slice: slice (id), keys (lang, word of each different word), codes (little-endian 32-bit)."""
    key = pa.struct([("lang", pa.string()), ("word", pa.string())])
    schema = pa.schema([("keys", pa.list_(key)), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, words, _, codes in _split(batches):
            keys = pa.StructArray.from_arrays([langs, words], fields=list(key))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), pa.array([codes.tobytes()], pa.binary())], schema=schema)

    split = map_arrow(texts, run, "keys array<struct<lang:string, word:string>>, codes binary")
    return stored(split.select(F.monotonically_increasing_id().alias("slice"), "keys", "codes"), "slices")


def _stream(ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A stream of word numbers in rows of about ``ROW_IDS``, cut at breaks; of several 0 in a row only the first is kept."""
    kept = ids[(ids > 0) | np.append(True, ids[:-1] > 0)]
    breaks, lo = np.flatnonzero(kept == 0), 0
    while lo < len(kept):
        k = int(np.searchsorted(breaks, lo + ROW_IDS))
        hi = int(breaks[k]) + 1 if k < len(breaks) else len(kept)
        yield pa.RecordBatch.from_arrays([pa.array([kept[lo:hi].tobytes()], pa.binary())], ["ids"])
        lo = hi


def numbered(texts: DataFrame, words: DataFrame) -> DataFrame:
    """``ids`` (binary, 32-bit): the words' numbers from ``words`` (lang, word, id), 0 for others and breaks, no two 0 in a row.

    Frequent words within ``VOCABULARY_WORDS`` and ``VOCABULARY_BYTES`` are
    broadcast; beyond them the texts' words are joined with the table.
    """
    size = words.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("word") + F.octet_length("lang")), F.lit(0)).alias("bytes")).first()
    if size["n"] > VOCABULARY_WORDS or size["bytes"] > VOCABULARY_BYTES:
        return stored(_numbered_by_join(text_slices(texts), words), "streams")
    found = words.select("lang", "word", "id").toArrow().combine_chunks()
    names = _named(found.column("lang").cast(pa.string()), found.column("word").cast(pa.string()))
    known = texts.sparkSession.sparkContext.broadcast((names, found.column("id").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ids = known.value
        for langs, words, _, codes in _split(batches):
            place = pc.index_in(_named(langs, words), value_set=names).fill_null(-1).to_numpy()
            table = np.append(0, np.where(place >= 0, ids[place], 0)).astype(np.int32) if len(ids) else np.zeros(len(place) + 1, np.int32)
            yield from _stream(table[codes])

    return stored(map_arrow(texts, run, "ids binary"), "streams")


def _named(lang, word) -> pa.Array:
    """Language and word as one text each; a language's name may hold anything, so its length stands before it."""
    lang = lang.combine_chunks() if isinstance(lang, pa.ChunkedArray) else lang
    word = word.combine_chunks() if isinstance(word, pa.ChunkedArray) else word
    return pc.binary_join_element_wise(pc.binary_length(lang).cast(pa.string()), lang, word, " ")


def _numbered_by_join(split: DataFrame, words: DataFrame) -> DataFrame:
    """``numbered`` for any number of words, by a join.

    A slice's codes and the numbers of its words are sorted side by side and
    streamed, so a task holds one slice at a time.
    """
    keys = split.select("slice", F.posexplode("keys").alias("place", "key")).select("slice", "place", "key.lang", "key.word")
    names = keys.join(words.select("lang", "word", "id"), ["lang", "word"]).select("slice", (F.col("place") + 1).alias("place"), "id", F.lit(None).cast("binary").alias("codes"))
    both = names.unionByName(split.select("slice", F.lit(0).alias("place"), F.lit(0).alias("id"), "codes"))
    rows = both.repartition("slice").sortWithinPartitions("slice", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, table = None, None

        for batch in batches:
            places, ids = (batch.column(k).to_numpy() for k in (1, 2))
            heads = np.flatnonzero(places == 0)  # a slice's codes come before its words
            for lo, hi in zip([0, *heads], [*heads, len(places)]):
                if lo == hi:
                    continue
                if places[lo] == 0:
                    if codes is not None:
                        yield from _stream(table[codes])
                    codes = np.frombuffer(batch.column(3)[int(lo)].as_py(), np.int32)
                    table = np.zeros(int(codes.max()) + 1, np.int32)
                    lo += 1
                table[places[lo:hi]] = ids[lo:hi]
        if codes is not None:
            yield from _stream(table[codes])

    return map_arrow(rows, run, "ids binary")


class DoubleArray:
    """Trie of word sequences (rows of ``phrases``, 0 behind the last word) in two arrays.

    The child of state ``s`` by word ``w`` is ``base[s] + w`` if ``check`` there
    is ``s``.  First words are their own states.  All children of a state are
    placed at once, large families first, at a base where they are free.
    """

    def __init__(self, phrases: np.ndarray):
        self.phrases = phrases.astype(np.int32)
        top = int(self.phrases.max(initial=0)) + 1
        total = top + np.count_nonzero(self.phrases[:, 1:])  # at least the number of states
        self.rng = np.random.default_rng(len(phrases))
        self.base, self.check = np.zeros(top, np.int32), np.zeros(2 * top + 2 * total, np.int32)
        self.check[np.unique(self.phrases[:, 0])] = ROOT
        self.check[0] = ROOT
        state = self.phrases[:, 0].astype(np.int64)
        for n in range(1, self.phrases.shape[1]):
            more = self.phrases[:, n] > 0
            if more.any():
                state[more] = self._place(state[more], self.phrases[more, n], top)
        self.base = np.append(self.base, np.zeros(len(self.check) - len(self.base), np.int32))
        self.accepts = state

    def _place(self, parents: np.ndarray, words: np.ndarray, top: int) -> np.ndarray:
        """States of the children, placed family by family."""
        pairs, inverse = np.unique(parents << 32 | words.astype(np.int64), return_inverse=True)
        pairs = np.stack([pairs >> 32, pairs & 0xFFFFFFFF])
        family, begin, size = np.unique(pairs[0], return_index=True, return_counts=True)
        bases = np.full(len(family), -1, np.int64)
        ranks = np.floor(np.log2(size)).astype(int)
        for rank in sorted(set(ranks.tolist()), reverse=True):
            open_ = np.flatnonzero(ranks == rank)
            tries = 0
            while len(open_):
                tried = self.rng.integers(0, len(self.check) - top, len(open_))
                owner = np.repeat(np.arange(len(open_)), size[open_])
                inside = np.arange(len(owner)) - np.repeat(np.cumsum(size[open_]) - size[open_], size[open_])
                slots = tried[owner] + pairs[1][begin[open_][owner] + inside]
                once = np.zeros(len(slots), bool)
                once[np.unique(slots, return_index=True)[1]] = True
                bad = np.zeros(len(open_), bool)
                bad[owner[(self.check[slots] != 0) | ~once]] = True
                good = ~bad[owner]
                self.check[slots[good]] = family[open_][owner[good]]
                bases[open_[~bad]] = tried[~bad]
                tries += 1
                if tries % 16 == 0:
                    self.check = np.append(self.check, np.zeros(len(self.check) // 2, np.int32))
                open_ = open_[bad]
        if len(self.base) < len(self.check):
            self.base = np.append(self.base, np.zeros(len(self.check) - len(self.base), np.int32))
        self.base[family] = bases
        place = np.searchsorted(family, pairs[0])
        return (bases[place] + pairs[1])[inverse]

    def walk(self, stream: np.ndarray, levels: int, at: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """For 1 to ``levels`` words, the state reached from each position of ``stream``, or each of ``at`` (0: none)."""
        at = np.arange(len(stream)) if at is None else at
        stream = np.append(stream, np.zeros(levels, stream.dtype))
        state = stream[at]
        state = np.where(state < len(self.check), state, 0)
        state = np.where(self.check[state] == ROOT, state, 0)
        yield state
        for n in range(1, levels):
            state = self.follow(state, stream[at + n])
            yield state

    def follow(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """States after one more word each."""
        to = np.minimum(self.base[state].astype(np.int64) + word, len(self.check) - 1)
        return np.where((state > 0) & (word > 0) & (self.check[to] == state), to, 0)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Word numbers of some rows at a time, a 0 between rows."""
    parts, total, gap = [], 0, np.zeros(1, np.int32)
    for batch in batches:
        for ids in batch.column(0):
            part = np.frombuffer(ids.as_py(), np.int32)
            parts += [part, gap]
            total += len(part) + 1
            if total >= HELD:
                yield np.concatenate(parts)
                parts, total = [], 0
    if parts:
        yield np.concatenate(parts)


def _gathered(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Consecutive arrays joined to at least ``HELD`` values each, but for the last."""
    held, total = [], 0
    for part in parts:
        held.append(part)
        total += len(part)
        if total >= HELD:
            yield np.concatenate(held)
            held, total = [], 0
    if held:
        yield np.concatenate(held)


def _fold(words: list):
    """A number under ``PRIME`` for some words, the same for numpy arrays and for columns of 64-bit numbers; no product passes 64 bits."""
    total = words[0]
    for word in words[1:]:
        total = (total * FOLD + word) % PRIME
    return total


def _longs(words: list[str]) -> list[Column]:
    return [F.col(w).cast("long") for w in words]


def _tries(phrases: DataFrame) -> Iterator[tuple]:
    """Broadcast tries of the rows of ``phrases`` (w1..w4), each of about TRIE_PHRASES, and which first two words are in it; bounded rows come to the driver."""
    spark = phrases.sparkSession
    count = max(1, -(-phrases.count() // TRIE_PHRASES))
    for k in range(count):
        part = phrases.where(_fold(_longs(WORDS[:2])) % F.lit(count) == k) if count > 1 else phrases
        found = part.select(*WORDS).toArrow()
        if found.num_rows:
            trie = DoubleArray(np.stack([c.to_numpy() for c in found.columns], axis=1))
            yield spark.sparkContext.broadcast(trie), k, count


def _bitmap(phrases: DataFrame, size: int):
    """Broadcast bits, of which those of the rows of ``phrases`` (of ``size`` words) are set; at most FILTER_BITS reach the driver."""
    bits = min(FILTER_BITS, max(64, 1 << (16 * phrases.count()).bit_length()))
    at = phrases.select((_fold(_longs(WORDS[:size])) % F.lit(bits)).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    rows = at.groupBy(F.call_function("shiftright", "at", F.lit(6)).alias("place")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return phrases.sparkSession.sparkContext.broadcast(out)


def _columns(rows: np.ndarray, n: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in rows.T], pa.array(n.astype(np.int64))], schema=schema)


_SCHEMA = pa.schema([*[(w, pa.int32()) for w in WORDS], ("f", pa.int64())])
_DDL = ", ".join(f"{w} int" for w in WORDS) + ", f long"


def frequent_phrases(streams: DataFrame, shorter: DataFrame | None, size: int, least: int) -> DataFrame:
    """w1..w4, f: phrases of ``size`` words with at least ``least`` occurrences, overlaps included, and their exact number.

    ``shorter`` are those of one word less (none for pairs).  A candidate is
    one number, its state before the last word and that word; only positions
    whose first and last ``size - 1`` words may be frequent give one.
    """
    def pass_over(trie, bitmap, k: int, count: int):
        schema = pa.schema([("code", pa.int64()), ("n", pa.int32())])

        def candidates(stream: np.ndarray) -> np.ndarray:
            fit = stream[:max(len(stream) - size + 1, 0)] > 0
            for i in range(1, size):
                fit &= stream[i:len(fit) + i] > 0
            at = np.flatnonzero(fit)
            if count > 1:
                at = at[_fold([stream[at].astype(np.int64), stream[at + 1]]) % count == k]
            if trie is None:
                state = stream[at]
            else:
                *_, state = trie.value.walk(stream, size - 1, at)
                at, state = at[state > 0], state[state > 0]
                place = _fold([stream[at + i].astype(np.int64) for i in range(1, size)]) % (64 * len(bitmap.value))
                likely = bitmap.value[place >> 6] >> (place & 63) & 1 > 0
                at, state = at[likely], state[likely]
            return state.astype(np.int64) << 32 | stream[at + size - 1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for codes in _gathered(map(candidates, _streams(batches))):
                codes, n = np.unique(codes, return_counts=True)
                n = n.astype(np.int32)
                for lo in range(0, len(codes), 1 << 14):
                    yield pa.RecordBatch.from_arrays([pa.array(codes[lo:lo + (1 << 14)]), pa.array(n[lo:lo + (1 << 14)])], schema=schema)

        return run

    def written_out(trie):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            accepts = trie.value.accepts
            order = np.argsort(accepts)
            for batch in batches:
                codes, n = (batch.column(c).to_numpy() for c in ("code", "f"))
                rows = trie.value.phrases[order[np.searchsorted(accepts, codes >> 32, sorter=order)]].copy()
                rows[:, size - 1] = codes & 0xFFFFFFFF
                yield _columns(rows, n, _SCHEMA)

        return run

    found = streams.sparkSession.createDataFrame([], _DDL)
    bitmap = None if shorter is None else _bitmap(shorter, size - 1)
    for trie, k, count in ([(None, k, PAIR_PASSES) for k in range(PAIR_PASSES)] if shorter is None else _tries(shorter)):
        codes = map_arrow(streams, pass_over(trie, bitmap, k, count), "code long, n int")
        kept = codes.groupBy("code").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        if trie is None:
            first, last = F.call_function("shiftright", F.col("code"), F.lit(32)), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))
            part = kept.select(first.cast("int").alias("w1"), last.cast("int").alias("w2"), *[F.lit(0).alias(w) for w in WORDS[2:]], "f")
        else:
            part = map_arrow(kept, written_out(trie), _DDL)
        found = found.unionByName(part)
    return stored(found, f"phrases{size}")


def _size(words: list[Column]) -> Column:
    return sum((F.when(w > 0, 1).otherwise(0) for w in words[1:]), F.lit(1))


def _part(size: Column, begin: Column, length: Column) -> list[Column]:
    """``length`` words of a phrase from its word ``begin`` (from 0), as the four word columns."""
    words = F.array(*WORDS, *[F.lit(0)] * LONGEST)
    return [F.when(F.lit(i) < length, F.get(words, begin + i)).otherwise(0).alias(w) for i, w in enumerate(WORDS)]


def collocations(docs: DataFrame, least: int = LEAST, inside_percent: int = INSIDE_PERCENT, reported: int = REPORTED,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``reported`` best phrases.

    ``a``, ``l`` and ``r`` are the occurrences of the phrase and of its two
    parts at the cut of the lowest score, ``n`` all words of the language.
    Phrases that mostly stand inside a longer candidate are left out.  Sums and
    products are decimals, so they do not overflow.

    Null texts are empty and a null language is ``und``; repeated rows count
    as often as they stand there; ties go by score, ``a`` and the phrase's
    bytes.  Texts are taken whole.  Other columns are not read; a language
    without phrases has no rows, no rows give no rows.
    """
    texts = _source(docs, text_col, lang_col)
    words = word_counts(texts)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = stored(totals_before(words.where(F.col("f") >= least), [F.col("lang"), F.col("word")], {"before": F.lit(1).cast("long")})
                      .select("lang", "word", "f", (F.col("before") + 1).cast("int").alias("id")), "vocabulary")
    streams = numbered(texts, frequent)
    levels = []
    for size in range(2, LONGEST + 1):
        levels.append(frequent_phrases(streams, levels[-1] if levels else None, size, least))
    counted = levels[0]
    for level in levels[1:]:
        counted = counted.unionByName(level)
    single = frequent.select(F.col("id").alias("w1"), *[F.lit(0).alias(w) for w in WORDS[1:]], "f")
    known = single.unionByName(counted)
    exact = "decimal(30,0)"

    size = _size([F.col(w) for w in WORDS])
    cuts = counted.select(F.struct(*WORDS).alias("p"), *WORDS, F.col("f").alias("a"), size.alias("size")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left = cuts.select("p", "a", "k", F.struct(*_part(F.col("size"), F.lit(0), F.col("k"))).alias("part"),
                       F.struct(*_part(F.col("size"), F.col("k"), F.col("size") - F.col("k"))).alias("rest"))
    sought = known.select(F.struct(*WORDS).alias("part"), "f")
    halves = (left.join(sought.withColumnRenamed("f", "l"), "part")
              .join(sought.select(F.col("part").alias("rest"), F.col("f").alias("r")), "rest"))
    score = F.call_function("div", F.lit(SCALE).cast("decimal(8,0)") * F.col("a").cast("decimal(29,0)"), F.col("l").cast(exact) + F.col("r").cast(exact))
    scored = halves.groupBy("p", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    longer = counted.select(*WORDS, "f", size.alias("size")).where("size > 2")
    inner = longer.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("length"))))
    within = inner.select(F.struct(*_part(F.col("size"), F.col("begin"), F.col("length"))).alias("p"), "f").groupBy("p").agg(F.max("f").alias("most"))
    mostly = F.lit(100).cast("decimal(3,0)") * F.col("most").cast(exact) >= F.lit(inside_percent).cast("decimal(3,0)") * F.col("a").cast(exact)
    kept = scored.join(within, "p", "left").where(F.col("most").isNull() | ~mostly).select("p.*", "a", "cut.score", "cut.l", "cut.r")
    named = kept
    for w in WORDS:
        names = frequent.select(F.col("id").alias(w), F.col("word").alias(f"{w}_word"), *([F.col("lang")] if w == "w1" else []))
        named = named.join(names, w, "inner" if w in WORDS[:2] else "left")
    phrases = named.select("lang", F.concat_ws(" ", *[f"{w}_word" for w in WORDS]).alias("phrase"), "a", "l", "r", "score")

    # a language may hold a third of all phrases: the best of each part of it first
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    dealt = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= reported)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= reported)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
