"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces of the
product of the pieces' probabilities, by the forward algorithm; a text's is
the product over its words.  Piece probabilities are learned by expectation
maximisation: expected piece counts over all segmentations (forward and
backward sums), starting from equal probabilities.

Words are the lower-cased runs of letters of the whole text.  What is learned
has one number per language and piece, whatever the size of the corpus.
"""

from __future__ import annotations

import math
import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordCache, keep_where, map_arrow, stored, take_turn, text_hash, text_lists

START = "▁"
UNKNOWN = "und"
DOCS_PER_LANGUAGE = 400
ROUNDS = 2
SMOOTHING = 0.05
_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    runs = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    return "".join(c if c.isalpha() else " " for c in " ".join(runs)).split()


def pieces_of(path: str) -> list[str]:
    """The pieces of a public piece vocabulary that can stand in a lower-case word."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    plain = [p.piece for p in model.pieces if p.type == 1]
    return [p for p in plain if p == START or (p.removeprefix(START).isalpha() and p == p.lower())]


LONG_WORD = 1000  # letters from which sums are held for the longest piece only


@dataclass
class PieceModel:
    """Piece probabilities: ``table[piece]`` has one value per language; ``unseen`` is for other characters."""

    languages: list[str]
    table: dict[str, tuple[float, ...]]
    unseen: float

    def __post_init__(self):
        # every beginning of a piece; None where it is no piece itself
        self.steps = {p[:k]: None for p in self.table for k in range(1, len(p))} | self.table
        self.longest = max(map(len, self.table), default=1)

    def edges(self, word: str) -> list[list[tuple[int, tuple[float, ...]]]]:
        """For each end position, the (start, probabilities) of the pieces that end there."""
        n, steps = len(word), self.steps
        none = (self.unseen,) * len(self.languages)
        out = [[] for _ in range(n)]
        for start in range(n):
            p = steps.get(word[start])
            out[start].append((start, none if p is None else p))
            for end in range(start + 2, n + 1):
                p = steps.get(word[start:end], 0)
                if p == 0:
                    break
                if p is not None:
                    out[end - 1].append((start, p))
        return out

    def log_likelihoods(self, word: str) -> list[float]:
        """Log of the sum over all segmentations, per language; sums are rescaled, so no length underflows."""
        if len(word) > LONG_WORD:
            return self._long_word(START + word)
        edges = self.edges(START + word)
        out = []
        for k in range(len(self.languages)):
            sums, log = [1.0], 0.0
            for end, found in enumerate(edges, 1):
                s = 0.0
                for start, p in found:
                    s += sums[start] * p[k]
                if s < 1e-200:
                    sums = [x * 1e200 for x in sums]
                    s *= 1e200
                    log -= 200 * math.log(10)
                sums.append(s)
            out.append(math.log(sums[-1]) + log)
        return out

    def _long_word(self, text: str) -> list[float]:
        """``log_likelihoods`` for words of any length in linear time: only the sums that the longest piece reaches are held."""
        size, languages, steps = self.longest + 1, range(len(self.languages)), self.steps
        none = (self.unseen,) * len(self.languages)
        ring = [[0.0] * len(self.languages) for _ in range(size)]
        ring[0] = [1.0] * len(self.languages)
        logs = [0.0] * len(self.languages)

        def rescale(here: list[float]) -> None:
            for k in languages:
                if here[k] < 1e-200:
                    for sums in ring:
                        sums[k] *= 1e200
                    logs[k] -= 200 * math.log(10)

        for start, letter in enumerate(text):
            here = ring[start % size]
            rescale(here)
            end, p = start + 1, steps.get(letter)
            found = none if p is None else p
            while True:
                if found is not None:
                    sums = ring[end % size]
                    for k in languages:
                        sums[k] += here[k] * found[k]
                end += 1
                if end > len(text):
                    break
                found = steps.get(text[start:end], 0)
                if found == 0:
                    break
            ring[start % size] = [0.0] * len(self.languages)
        last = ring[len(text) % size]
        rescale(last)
        return [math.log(s) + log for s, log in zip(last, logs)]

    def expected(self, word: str, weight: float, k: int, into: Counter) -> None:
        """Add the expected counts of the pieces of ``word`` in language ``k`` to ``into``."""
        s = START + word
        edges = self.edges(s)
        n = len(s)
        forward = [1.0]
        for found in edges:
            forward.append(sum(forward[start] * p[k] for start, p in found))
            if forward[-1] < 1e-150:
                return self._expected_by_logs(s, edges, weight, k, into)
        backward = [0.0] * n + [1.0]
        for end in range(n, 0, -1):
            for start, p in edges[end - 1]:
                backward[start] += p[k] * backward[end]
        scale = weight / forward[n]
        for end in range(1, n + 1):
            for start, p in edges[end - 1]:
                into[s[start:end]] += forward[start] * p[k] * backward[end] * scale

    @staticmethod
    def _expected_by_logs(s: str, edges: list, weight: float, k: int, into: Counter) -> None:
        """As ``expected``, by logarithms: for words whose sums are too small."""
        n = len(s)
        edges = [[(start, math.log(p[k])) for start, p in found if p[k] > 0] for found in edges]
        forward = [0.0]
        for found in edges:
            forward.append(float(np.logaddexp.reduce([forward[start] + p for start, p in found])))
        if forward[n] == -math.inf:
            return
        backward = [-math.inf] * n + [0.0]
        for end in range(n, 0, -1):
            for start, p in edges[end - 1]:
                backward[start] = float(np.logaddexp(backward[start], p + backward[end]))
        for end in range(1, n + 1):
            for start, p in edges[end - 1]:
                into[s[start:end]] += weight * math.exp(forward[start] + p + backward[end] - forward[n])


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is never learned from: crc32 of its id as text leaves no remainder by 5, or the id is null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in text_lists(batch.column("text")):
            counts: Counter = Counter()
            for lang, text in zip(batch.column("lang").slice(lo, hi - lo).to_pylist(), texts):
                counts.update((lang, w) for w in letter_words(text))
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"])


def train(docs: DataFrame, path: str, docs_per_language: int = DOCS_PER_LANGUAGE, rounds: int = ROUNDS) -> PieceModel:
    """Learn piece probabilities from ``docs`` (doc_id, text, lang) that are not held out and have a language.

    About ``docs_per_language`` documents of each language are learned from,
    chosen by a hash of the id; their texts are read whole.  Word counts and
    expected counts are summed by Spark; the driver gets one number per
    language and piece.  Without labelled documents the model has no languages.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    pieces = pieces_of(path)
    start = 1 / max(1, len(pieces))
    model = PieceModel(languages, {p: (start,) * len(languages) for p in pieces}, start)
    if not languages:
        return model
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, docs_per_language / n))])
    place = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1_000_003)) / 1_000_003
    sample = known.where(place < share[F.col("lang")]).select("lang", "text")
    words = map_arrow(sample, _word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stored(words.repartition("word"), "langid-words")
    sc = docs.sparkSession.sparkContext
    for _ in range(rounds):
        shared = sc.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = shared.value
            at = {lang: k for k, lang in enumerate(model.languages)}
            sums = [Counter() for _ in at]
            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    model.expected(word, n, at[lang], sums[at[lang]])
            for lang, k in at.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(sums[k]), pa.string()), pa.array(sums[k].keys(), pa.string()),
                    pa.array(sums[k].values(), pa.float64())], names=["lang", "piece", "n"])

        totals = map_arrow(words, expect, "lang string, piece string, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        counts = [dict.fromkeys(pieces, SMOOTHING) for _ in languages]
        for row in totals.collect():
            of = counts[languages.index(row["lang"])]
            if row["piece"] in of:
                of[row["piece"]] += row["n"]
        shared.unpersist()
        whole = [sum(c.values()) for c in counts]
        table = {p: tuple(c[p] / w for c, w in zip(counts, whole)) for p in pieces}
        model = PieceModel(languages, table, SMOOTHING / max(whole))
    return model


class Scorer:
    """Languages of texts; likelihoods of frequent words are remembered within bounds."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.pack = struct.Struct(f"{len(model.languages) + 1}d").pack
        self.none = self.pack(*[0.0] * (len(model.languages) + 1))
        self.words = WordCache(lambda w: self.pack(*model.log_likelihoods(w), 1.0), 200_000)
        self.parts = WordCache(self._part, 200_000)

    def _part(self, part: str) -> bytes:
        low = part.lower()
        if low.isalpha():
            return self.words[low]
        if low[-1:] in ".,;:!?" and low[:-1].isalpha():
            return self.words[low[:-1]]
        words = letter_words(part)
        if len(words) < 2:
            return self.words[words[0]] if words else self.none
        return np.frombuffer(b"".join(map(self.words.__getitem__, words))).reshape(len(words), -1).sum(axis=0).tobytes()

    def predict(self, text: str) -> tuple[str, float]:
        """(language, its probability among the languages); ``und`` and 0 without letters or languages."""
        parts = text.split()
        if not parts or not self.model.languages:
            return UNKNOWN, 0.0
        sums = np.frombuffer(b"".join(map(self.parts.__getitem__, parts))).reshape(len(parts), -1).sum(axis=0)
        if sums[-1] == 0:
            return UNKNOWN, 0.0
        logs = sums[:-1]
        best = int(np.argmax(logs))
        return self.model.languages[best], float(1 / np.exp(logs - logs[best]).sum())


_LAST: list[Scorer] = []


def scorer_of(model: PieceModel) -> Scorer:
    """The scorer of a model, kept by a worker until another model comes."""
    if not _LAST or _LAST[0].model is not model:
        _LAST[:] = [Scorer(model)]
    return take_turn(_LAST[0])


def predict(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, row (``text_hash``), held_out, lang_pred, score (0 to 1), from the text alone.

    Null texts and texts without letters are ``und`` with score 0; so is
    every text if nothing was learned.  Equal scores go to the first language
    in order of name.  Ids may repeat or be null; other columns are not read;
    an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column("text")):
                out = [scorer.predict(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "row", "held_out")],
                    pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                    names=["doc_id", "row", "held_out", "lang_pred", "score"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("row"),
                         held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return map_arrow(source, run, "doc_id long, row long, held_out boolean, lang_pred string, score double", words=True)


def keep_recognised(docs: DataFrame, model: PieceModel, least: float, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose language is not ``und`` and has a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide():
        scorer = scorer_of(shared.value)
        return lambda texts: [lang != UNKNOWN and score >= least for lang, score in map(scorer.predict, texts)]

    return keep_where(docs, decide, text_col)
