"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

A source's documents are put in a fixed shuffled order (by a digest of id and
text) and laid end to end, as often as the mix may repeat them: its tape.  The
tape is cut into blocks of equally many words.  The mix is a sequence of slots,
each of which takes the next block of one source.

The schedule is the van der Corput sequence over a grid of ``2**k`` points: the
point of slot ``i`` is ``i`` with its binary digits reversed.  Each source owns
an interval of the grid as wide as its number of blocks, so the intervals are
the cumulative weights in whole blocks, every source gets exactly its blocks
and, at any place of the mix, its share is within a few blocks of its weight.
Points beyond the last interval belong to no slot.  A slot's rank among those
of its source, which is the block it takes, is counted in closed form from the
digits, so no window runs over the slots.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, totals_before

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST = 2
BLOCK_WORDS = 2048
CHUNK = 1 << 14  # grid points made by one row at a time
BUCKET_DIGITS = 3  # hexadecimal digits of the order digest that split a source


def entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, key and copies: one row per different (source, id, text); equal rows are counted together.

    The key gives the shuffled order.  Counting combines before the shuffle,
    so one row repeated any number of times is no hot group.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))).alias("key"))
    return rows.groupBy("source", "key", "doc_id", "size").agg(F.count("*").alias("copies"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, target (double) and words (long), the target rounded.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share_percent`` of all words, each at most ``most`` times its own.
    Sources whose bound is met have the least words by weight, so with sources
    in that order the shares are found by running totals: a source is at its
    bound as long as giving all later ones the same multiple of their weight
    would not use up the share.
    """
    grouped = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = totals_before(grouped, [F.col("source").asc_nulls_last()], {"place": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    # words by weight over one common denominator, so that the order is exact
    common = math.prod(weights)
    parts = F.element_at(F.array(*[F.lit(common // w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ratio = F.col("source_size").cast("decimal(38,0)") * parts.cast("decimal(18,0)")
    ordered = stored(totals_before(placed.select("source", "source_size", weight.alias("weight"), ratio.alias("ratio")), [F.col("ratio").asc(), F.col("source").asc_nulls_last()],
                             {"words_before": F.col("source_size"), "weight_before": F.col("weight")}), "sources")
    total = ordered.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all_words"), F.coalesce(F.sum("weight"), F.lit(0)).alias("all_weight")).first()
    d = "decimal(38,0)"
    budget = F.lit(share_percent * total.all_words).cast(d)  # in hundredths of words
    left = budget - F.lit(100 * most).cast(d) * F.col("words_before").cast(d)
    rest = F.lit(total.all_weight).cast("long") - F.col("weight_before")
    bounded = F.lit(100 * most).cast(d) * F.col("source_size").cast(d) * rest.cast(d) <= left * F.col("weight").cast(d)
    marked = ordered.withColumn("bounded", bounded)
    # the first source that is not at its bound fixes the multiple for all later ones
    free = marked.where(~F.col("bounded")).agg(F.min(F.struct("weight_before", "words_before")).alias("f")).select("f.*").first()
    if free is None or free.words_before is None:
        target = F.lit(float(most)) * F.col("source_size").cast("double")
    else:
        spare = share_percent * total.all_words - 100 * most * free.words_before
        open_weight = total.all_weight - free.weight_before
        target = F.when(F.col("weight_before") < free.weight_before, F.lit(float(most)) * F.col("source_size").cast("double")).otherwise(
            (F.lit(spare).cast(d) * F.col("weight").cast(d)).cast("double") / F.lit(100 * open_weight).cast("double"))
    return marked.select("source", "source_size", target.alias("target"), F.floor(target + 0.5).cast("long").alias("words"))


def _count_below(point: Column, digits: int, bound: Column) -> Column:
    """Points below ``bound`` of the slots before the one whose point is ``point``.

    The slots before split by the highest digit in which they differ; those of
    one part have all points of one residue.
    """
    def part(total: Column, t: Column) -> Column:
        # digit t of the slot is digit (digits - 1 - t) of its point; later digits agree, earlier ones are free
        step = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(digits) - t)
        low = point % (step / 2).cast("long")
        free = F.call_function("shiftleft", F.lit(1).cast("long"), t)
        hits = F.floor((bound - low + step - 1) / step).cast("long")
        isset = F.call_function("shiftright", point, F.lit(digits - 1) - t) % 2 == 1
        return total + F.when(isset, F.greatest(F.lit(0).cast("long"), F.least(free, hits))).otherwise(F.lit(0).cast("long"))

    if digits == 0:
        return F.lit(0).cast("long")
    return F.aggregate(F.sequence(F.lit(0), F.lit(digits - 1)), F.lit(0).cast("long"), part)


def schedule(wanted: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, source, block of the mix for the sources of ``wanted`` (source, words): as many blocks as their words fill.

    Slots ascend in the order of the mix; numbers of the grid that belong to
    no source are left out.
    """
    blocks = F.floor((F.col("words") + F.lit(block_words - 1)) / F.lit(block_words)).cast("long")
    owned = stored(totals_before(wanted.select("source", blocks.alias("blocks")).where("blocks > 0"), [F.col("source").asc_nulls_last()],
                           {"first": F.col("blocks")}), "intervals")
    count = owned.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    digits = max(count - 1, 0).bit_length()
    last = F.col("first") + F.col("blocks")
    chunks = owned.select("source", "first", last.alias("last"),
                          F.explode(F.sequence(F.floor(F.col("first") / CHUNK), F.floor((last - 1) / CHUNK))).alias("chunk"))
    points = chunks.repartition("source", "chunk").select("source", "first", "last", F.explode(F.sequence(
        F.greatest(F.col("first"), F.col("chunk") * CHUNK), F.least(F.col("last"), (F.col("chunk") + 1) * CHUNK) - 1)).alias("point"))
    slot = (F.conv(F.reverse(F.lpad(F.bin("point"), digits, "0")), 2, 10).cast("long") if digits else F.lit(0).cast("long"))
    rank = _count_below(F.col("point"), digits, F.col("last")) - _count_below(F.col("point"), digits, F.col("first"))
    return points.select(slot.alias("slot"), "source", rank.alias("block"))


def tapes(rows: DataFrame) -> DataFrame:
    """``rows`` of ``entries`` with ``start``, the words of their source that come before them.

    A source is split by the first digits of the order key: totals of these
    buckets are summed first, so no window takes a whole source.
    """
    rows = rows.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    words = F.col("size") * F.col("copies")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("source", "bucket").agg(F.sum(words).alias("n"))
    starts = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    joined = placed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.select("source", "key", "doc_id", "size", "copies", (F.col("bucket_start") + F.col("inside")).alias("start"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST,
        block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix: one row per piece of a document that a slot takes, and one with null slot for what no slot takes.

    source, doc_id, key (digest of id and text), copy (of equal rows, from 1),
    size, source_size, target, slot (order of the mix), round (from 0; a second
    one repeats the tape), first_word and n_words of the piece in its document.
    Read in the order (slot, round, key, copy), it is the mix.

    Sources without words take none.  Null texts are empty; a null source is a
    source, the last one.  Rows of equal id, text and source stand next to each
    other.  A very long text gives one row per block it covers.  Other columns
    are not read; an empty table gives an empty mix.  Everything depends on
    the rows alone, so reruns agree.
    """
    rows = stored(entries(docs, id_col, text_col, source_col), "entries")
    wanted = stored(targets(rows.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, share_percent, most), "targets")
    slots = schedule(wanted, block_words)
    named = wanted.select(F.col("source").alias("s"), "source_size", "target", "words")
    tape = tapes(rows).join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    each = (tape.select("*", F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth", "copy"))
            .select("source", "doc_id", "key", "copy", "size", "source_size", "target", "words", (F.col("start") + F.col("nth") * F.col("size")).alias("start")))
    rounds = each.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("round"))
    begin = F.col("start") + F.col("round") * F.col("source_size")
    spans = rounds.select("*", begin.alias("begin"), F.least(begin + F.col("size"), F.col("words")).alias("end"))
    some = F.col("end") > F.col("begin")
    covered = F.when(some, F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words)))
    pieces = spans.select("*", F.explode_outer(covered).alias("block"))
    first = F.greatest(F.col("begin"), F.col("block") * block_words)
    end = F.least(F.col("end"), (F.col("block") + 1) * block_words)
    taken = slots.select("slot", F.col("source").alias("s"), F.col("block").alias("b"))
    joined = pieces.join(taken, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    return joined.select("source", "doc_id", "key", "copy", "size", "source_size", "target", "slot", "round",
                         F.when(F.col("slot").isNotNull(), first - F.col("begin")).alias("first_word"),
                         F.when(F.col("slot").isNotNull(), end - first).alias("n_words"))


def document_totals(mixed: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes of the row, repeats counted) per row of the mixed table."""
    return (mixed.groupBy("source", "key", "copy", "doc_id", "size", "source_size", "target")
            .agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("taken")).select("doc_id", "size", "source_size", "target", "taken"))
