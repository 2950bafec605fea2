"""Near-duplicate documents: MinHash signatures joined by a multi-index Hamming join, links confirmed on full sets.

A document's set holds its distinct word shingles.  Its signature is ``5 * m``
MinHash values of 16 bits.  Two signatures are compared by the number of
values that differ.  The values are split into ``m`` chunks of five: a pair
with at most ``2m - 1`` differing values has, by the pigeonhole principle, a
chunk with at most one differing value.  Each chunk is therefore indexed under
its five patterns that leave out one value, and documents that share a pattern
are candidates: no pair within that distance is missed, and most pairs beyond
it are found too.  ``m`` is the smallest number for which a pair at the
similarity threshold shares no pattern with a chance under 1 in 100,000;
candidates farther apart than such a pair is with a chance of one in a million
are dropped, all others are confirmed on their full sets.

Documents with equal sets form one class and are compared once.  In a bucket,
members are first compared with one pivot.  Classes in one component after
that need no further comparison; pairs of different components are compared
by signature, in blocks of bounded size.  Of those near enough, only pairs are
written out and confirmed whose sets can be similar enough by the sum of the
smaller counts of two histograms of their hashes, which no intersection
exceeds.  A first round writes only as many pairs of a block as may join its
components.  If all of them are links, nothing is left to join; else a second
round writes all pairs of different components that are left.  So a large
group of copies costs its size and not its square, no link between components
is lost, and pairs that only share a common passage, or are copies with too
many changes, are never written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_tables, map_arrow, stored, text_hash, whole_rows
from .components import connected_components
from .shingles import distinct_by_text, hash_shingles, hash_words, mix, text_slices

CHUNK = 5
BLOCK = 256
BINS = 1024
_rng = np.random.Generator(np.random.PCG64(7919))
_XOR = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def plan(percent: int, unshared: float = 1e-5, beyond: float = 1e-6) -> tuple[int, int]:
    """(number of chunks, largest distance of a candidate) for links at ``percent`` similarity."""
    p = 1 - percent / 100
    chunk_fails = 1 - (1 - p) ** CHUNK - CHUNK * p * (1 - p) ** (CHUNK - 1)
    for m in range(2, 256 // CHUNK + 1):
        if chunk_fails**m < unshared:
            n = CHUNK * m
            tail = lambda r: sum(comb(n, d) * p**d * (1 - p) ** (n - d) for d in range(r + 1, n + 1))
            return m, next(r for r in range(2 * m - 1, n + 1) if tail(r) < beyond)
    raise ValueError(f"a similarity of {percent} percent is too low for a signature of 256 values")


def signatures(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """16-bit MinHash values, one row of ``size`` per text; a text without shingles has zeros."""
    out = np.zeros((len(bounds) - 1, size), np.uint16)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        at = bounds[some]
        for j in range(size):
            least = np.minimum.reduceat((values ^ _XOR[j]) * _MUL[j], at)
            out[some, j] = (mix(least) >> np.uint64(48)).astype(np.uint16)
    return out


def _sign(size: int, width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("c1", pa.int64()),
                        ("c2", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                values, bounds = hash_shingles(*hash_words(data, offsets), width)
                sig = signatures(values, bounds, size)
                sets = list(distinct_by_text(values, bounds))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), batch.column("row").slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                    pa.array(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                    pa.array([s.tobytes() for s in sig], pa.binary()),
                ], schema=schema)

    return run


def _index(m: int):
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(len(nodes), m, CHUNK)
            for chunk in range(m):
                for out in range(CHUNK):
                    key = np.full(len(nodes), chunk * CHUNK + out + 1, np.uint64)
                    for k in range(CHUNK):
                        if k != out:
                            key = mix(key + sig[:, chunk, k])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(nodes)], schema=schema)

    return run


def histogram(values: np.ndarray) -> np.ndarray:
    """Counts of hashes by their low bits, up to 255."""
    return np.minimum(np.bincount((values & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8)


def may_share(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Upper bound of the number of values that a set shares with each of others, from histograms."""
    least = np.minimum(others, x)
    return np.where((least == 255).any(axis=1), np.iinfo(np.int64).max // 1000, least.sum(axis=1, dtype=np.int64))


def _full_sets(width: int):
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("members", pa.binary()), ("bins", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                values, bounds = hash_shingles(*hash_words(data, offsets), width)
                sets = list(distinct_by_text(values, bounds))
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").slice(lo, hi - lo), batch.column("n").slice(lo, hi - lo),
                    batch.column("sig").slice(lo, hi - lo),
                    pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([histogram(s).tobytes() for s in sets], pa.binary()),
                ], schema=schema)

    return run


def _near_in_blocks(percent: int, radius: int, every: bool):
    """Pairs of one bucket's block pair in different components, within the radius, whose sets can be similar enough.

    ``every`` gives all of them, else only pairs that would join components not
    yet joined by the pairs before.  Rows come sorted by ``key``, ``i``, ``j``;
    one group is held at a time, and it has at most the members of two blocks.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "block", "node", "root", "n")]
            cols.append(np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(batch.num_rows, -1))
            cols.append(np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            if rest is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(rest, cols)]
            key, i, j = cols[:3]
            cut = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *cut.tolist()]
            for lo, hi in zip(bounds, bounds[1:]):
                yield [c[lo:hi] for c in cols]
            rest = [c[bounds[-1]:] for c in cols]
        if rest is not None:
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        count = 0
        for _, i, j, block, node, root, n, sig, bins in groups(batches):
            left = np.flatnonzero(block == i[0])
            right = np.flatnonzero(block == j[0])
            root = root.copy()
            for x in left.tolist():
                other = right[(root[right] != root[x]) & ((node[right] > node[x]) | (i[0] != j[0]))]
                if len(other):
                    near = other[np.count_nonzero(sig[other] != sig[x], axis=1) <= radius]
                    most = may_share(bins[x], bins[near])
                    near = near[100 * most >= percent * (n[x] + n[near] - most)]
                    if len(near) and not every:
                        near = near[np.unique(root[near], return_index=True)[1]]
                        root[np.isin(root, root[near])] = root[x]
                    if len(near):
                        pair = np.stack([np.full(len(near), node[x]), node[near]])
                        found.append(np.sort(pair, axis=0))
                        count += len(near)
            if count > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.unique(np.concatenate(found, axis=1), axis=1)], schema=schema)
                found, count = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.unique(np.concatenate(found, axis=1), axis=1)], schema=schema)

    return run


def shared_count(a: np.ndarray, b: np.ndarray) -> int:
    """Number of values in both of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _confirm(percent: int, radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near_a, near_b = [], []
            cols = [batch.column(c) for c in ("a", "b", "sig_a", "sig_b", "members_a", "members_b")]
            for i in range(batch.num_rows):
                a, b, sig_a, sig_b, set_a, set_b = (c[i] for c in cols)
                x, y = (np.frombuffer(s.as_buffer(), np.uint16) for s in (sig_a, sig_b))
                if np.count_nonzero(x != y) > radius:
                    continue
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (set_a, set_b))
                both = shared_count(x, y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    near_a.append(a.as_py())
                    near_b.append(b.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(near_a, pa.int64()), pa.array(near_b, pa.int64())], schema=schema)

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int, radius: int) -> DataFrame:
    """Those of ``pairs`` (a, b) within the radius whose full sets are similar enough."""
    side = lambda s: sets.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "sig", "members")])
    ratio = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    both = pairs.join(side("b"), "b").join(side("a"), "a").where(ratio)
    return map_arrow(both, _confirm(percent, radius), "a long, b long")


def _roots(source: DataFrame, classes: DataFrame, percent: int, width: int, m: int, radius: int, hold: Callable) -> DataFrame:
    """(node, root) of the classes that are not their component's root; ``hold`` holds tables while they are in use."""
    keys = map_arrow(classes.select("node", "sig"), _index(m), "key long, node long")
    buckets = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last").select("key", "pivot")
    members = hold(keys.join(buckets, "key"))
    near = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    pairs = near.distinct()
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "n", "sig", "rep_id", "rep_row")
    texts = source.join(wanted, (source["row"] == wanted["rep_row"]) & source["doc_id"].eqNullSafe(wanted["rep_id"]))
    texts = texts.select("node", "n", "sig", "text").dropDuplicates(["node"])
    sets = stored(map_arrow(texts, _full_sets(width), "node long, n long, sig binary, members binary, bins binary"), "sets")

    links = stored(_links(pairs, sets, percent, radius), "links")
    # classes that are linked to one and the same pivot are in one component
    roots = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    for every in (False, True):
        labelled = hold(members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")))
        mixed = (labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
                 .where("lo < hi").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
        left = (labelled.join(mixed, "key").join(sets.select("node", "n", "sig", "bins"), "node")
                .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
                .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
                .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
        blocks = (left.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")  # the same pairs each time
                  .select("key", "i", "j", "block", "node", "root", "n", "sig", "bins"))
        near = map_arrow(blocks, _near_in_blocks(percent, radius, every), "a long, b long").distinct()
        near = stored(near.join(pairs, ["a", "b"], "left_anti") if every else near, "pairs")
        more = stored(_links(near, sets, percent, radius), "links")
        found = more.count()
        if found:
            links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more) if every else links.union(more)
        if found or not every:
            roots = connected_components(links)
        if near.count() == found:
            break
        pairs = pairs.union(near)
    return roots


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, row, n_shingles, component_id, kept.

    Rows are linked when 100 * intersection >= ``percent`` * union of their
    sets of distinct ``width``-word shingles (words: runs without ASCII white
    space, A-Z lower-cased; a text of fewer words is one shingle).  ``row`` is
    ``text_hash(text)``, which tells apart rows of one id.  ``component_id`` is
    the smallest id reachable over links; ``kept`` says that it is the row's own.

    Null and empty texts and texts without words have an empty set, link with
    nothing and are kept.  Null ids take part and are smallest only if no other
    id is in the component.  Repeated rows are equal sets and share a component.
    An empty table gives an empty table; other columns of ``docs`` are not read.
    Texts are taken whole, whatever their length.
    """
    return _grouped(docs, percent, width, id_col, text_col).drop("group")


def _grouped(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with ``group``: a struct that the rows of one component, and only these, have in common."""
    m, radius = plan(percent)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("row"),
                         F.col(text_col).alias("text"))
    signed = stored(map_arrow(source, _sign(CHUNK * m, width), "doc_id long, row long, n long, c1 long, c2 long, sig binary"), "signed")
    classes = stored(
        signed.where("n > 0").groupBy("c1", "c2", "n", "sig")
        .agg(F.min("doc_id").alias("min_id"), F.min(F.struct("doc_id", "row")).alias("rep"))
        .select("c1", "c2", "n", "sig", "min_id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.row").alias("rep_row"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    with held_tables() as hold:
        roots = _roots(source, classes, percent, width, m, radius, hold)
        placed = stored(classes.join(roots, "node", "left").select("c1", "c2", "n", "min_id", F.coalesce("root", "node").alias("root")), "placed")
    least = placed.groupBy("root").agg(F.min("min_id").alias("component_id"))
    placed = placed.join(least, "root").select("c1", "c2", "n", "component_id", "root", F.lit(True).alias("linked"))
    out = signed.select("doc_id", "row", "n", "c1", "c2").join(placed, ["c1", "c2", "n"], "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id"))
    alone = F.col("root").isNull()  # a class that links with nothing is its own group
    group = F.struct("root", *[F.when(alone, F.col(c)).alias(c) for c in ("c1", "c2", "n")])
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), group.alias("group"))


def keep_one(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns: one of each group of near duplicates, that of the smallest id.

    Null ids come last; among rows of one id the smallest hash of the text is
    taken, so near duplicates under one id, or without any, leave one row too.
    Rows equal in id and text are duplicates: one stays.  Rows without words all stay.
    """
    found = _grouped(docs, percent, width, id_col, text_col).where("n_shingles > 0")
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    keys = first.select(F.col("first.doc_id").alias("d"), F.col("first.row").alias("r"), F.lit(True).alias("chosen")).distinct()
    whole = whole_rows(docs, id_col, text_col).withColumn("solid", F.col("text").rlike("[^\\x20\\x09-\\x0D]")).drop("text")
    chosen = whole.join(keys, F.col("row").eqNullSafe(F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    solid = F.coalesce("solid", F.lit(False))
    kept = chosen.where(~solid | F.col("chosen"))
    place = F.when(solid, F.lit(-1)).otherwise(F.monotonically_increasing_id())
    kept = kept.withColumn("place", place).dropDuplicates(["doc_id", "row", "place"])
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
