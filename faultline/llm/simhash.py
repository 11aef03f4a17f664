"""SimHash near-dedup: a binary trie self-join finds fingerprints that differ in few bits."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import connected_components, fresh, saved, table

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
# A subtrie is meant to hold no more fingerprints than this on average; the number of blocks follows from it.
SUBTRIE = 2048
# A trie is walked over at most two chunks of this many fingerprints; a prefix that holds more is cut into chunks, and
# each pair of chunks is a task's work of its own.
CHUNK = 2048
# Node pairs that are expanded at a time, which bounds memory.
FRONTIER = 500_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64 values; no words give zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], dtype=">u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(values)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp, h1, h2): the fingerprint of each row's whole text as a signed long, and 128 bits of hash of id and text.

    Null text is empty to the fingerprint, but another text to the hash. Repeated rows give a row each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, shingle) for t in batch.column(3).cast(pa.binary()).to_pylist()]
            signed = pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), signed, *batch.columns[1:3]], names=["doc_id", "fp", "h1", "h2"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_row_hashes(), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, fp long, h1 long, h2 long")


def _row_hashes() -> list[Column]:
    text = F.col("text").cast("string")
    return [F.xxhash64("doc_id", text, text.isNull()), F.xxhash64(F.lit("row"), text.isNull(), text, "doc_id")]


def trie_pairs(group: np.ndarray, fps: np.ndarray, max_bits: int = MAX_BITS, frontier: int = FRONTIER) -> Iterator[tuple]:
    """Index pairs of equal ``group`` whose ``fps`` differ in at most ``max_bits`` bits.

    ``group`` and ``fps`` are sorted by both. A trie node is a range of that order. Pairs of nodes walk down one bit at a
    time, starting with every group against itself; a step that takes different branches costs one bit, and a pair whose
    bits exceed the budget is dropped with all below it.
    """
    if not len(fps):
        return
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    lo, hi = cuts, np.r_[cuts[1:], len(fps)]
    stack = [(BITS - 1, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, al, ah, bl, bh, d = stack.pop()
        if len(al) > frontier:
            half = len(al) // 2
            stack += [(bit, *(x[half:] for x in (al, ah, bl, bh, d))), (bit, *(x[:half] for x in (al, ah, bl, bh, d)))]
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():  # what is left of two single paths is compared at once
            i, j = al[single], bl[single]
            near = (i != j) & (np.bitwise_count(fps[i] ^ fps[j]) <= max_bits)
            if near.any():
                yield i[near], j[near]
            al, ah, bl, bh, d = (x[~single] for x in (al, ah, bl, bh, d))
        if not len(al):
            continue
        if bit < 0:  # equal paths to the end: nodes hold copies of one fingerprint each
            for a, b, c, e in zip(al, ah, bl, bh, strict=True):
                i, j = (x.ravel() for x in np.meshgrid(np.arange(a, b), np.arange(c, e), indexing="ij"))
                if a == c:
                    i, j = i[i < j], j[i < j]
                yield i, j
            continue
        below = np.r_[0, np.cumsum((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)]
        am, bm = ah - (below[ah] - below[al]), bh - (below[bh] - below[bl])
        cross = al != bl
        parts = [
            (al, am, bl, bm, d, None),
            (am, ah, bm, bh, d, None),
            (al, am, bm, bh, d + 1, None),
            (am, ah, bl, bm, d + 1, cross),  # a node against itself takes its two branches once
        ]
        found = []
        for a0, a1, b0, b1, cost, only in parts:
            keep = (a1 > a0) & (b1 > b0) & (cost <= max_bits) & ~((a0 == b0) & (a1 - a0 == 1))
            if only is not None:
                keep &= only
            found.append(tuple(x[keep] for x in (a0, a1, b0, b1, cost)))
        stack.append((bit - 1, *(np.concatenate(x) for x in zip(*found, strict=True))))


def forest(n: int, pairs: Iterator[tuple]) -> np.ndarray:
    """For each of ``n`` items the smallest item it is joined to by ``pairs``."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            low = np.minimum(a, b)
            if (a == b).all():
                break
            np.minimum.at(root, np.maximum(a, b), low)
            while (root != root[root]).any():
                root = root[root]
    return root


def blocks_for(n: int, max_bits: int = MAX_BITS, subtrie: int = SUBTRIE) -> tuple[int, int]:
    """(blocks, shared): how many blocks to cut the bits into, and how many of them a subtrie fixes.

    Two fingerprints that differ in ``max_bits`` bits share at least ``blocks - max_bits`` blocks. The fewest blocks are
    taken for which subtries of ``n`` even fingerprints hold at most ``subtrie``; each fingerprint then goes to
    ``comb(blocks, shared)`` of them: 5, 15, 35 or 70 for 4 bits, whatever ``n``.
    """
    choices = [(max_bits + shared, shared) for shared in range(1, max(2, max_bits + 1))]
    fitting = [(b, s) for b, s in choices if n / 2 ** (BITS * s // b) <= subtrie]
    return (fitting or choices[-1:])[0]


def subtries(classes: DataFrame, blocks: int, shared: int) -> DataFrame:
    """Rows (fp, rep) of ``classes`` dealt to the subtries (block, bits) of every choice of ``shared`` blocks."""
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    parts = []
    for number, chosen in enumerate(itertools.combinations(range(blocks), shared)):
        bits, width = F.lit(0).cast("long"), 0
        for k in chosen:
            part = F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1).cast("long"))
            bits, width = bits.bitwiseOR(F.shiftleft(part, width)), width + cuts[k + 1] - cuts[k]
        parts.append(F.struct(F.lit(number).alias("block"), bits.alias("bits")))
    return classes.select("fp", "rep", F.inline(F.array(*parts)))


def near_edges(classes: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK, subtrie: int = SUBTRIE) -> DataFrame:
    """Edges (a, b) between ids of ``classes`` (fp, rep; fingerprints distinct) that connect all pairs within ``max_bits``.

    Near fingerprints share some blocks of bits whole, so the trie is dealt out by every choice of such blocks and their bits,
    and each near pair meets in one of these subtries. How many copies of a fingerprint that makes follows from
    ``blocks_for``. A subtrie that is crowded nevertheless is cut into chunks by hash, and each pair of chunks is walked on
    its own. A task gives back a forest of what it linked, not all pairs.
    """
    dealt = subtries(classes, *blocks_for(classes.count(), max_bits, subtrie))
    sizes = dealt.groupBy("block", "bits").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"), F.count("*").alias("n")).where("n > 1")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cells = dealt.join(sizes, ["block", "bits"]).select(
        "block", "bits", "fp", "rep", mine.alias("c"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o")
    )
    cells = cells.select("block", "bits", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"), "fp", "rep")
    key = F.xxhash64("block", "bits", "x", "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, fps, reps in whole_groups(batches):
            order = np.lexsort((fps, cell))
            cell, fps, reps = cell[order], fps[order], reps[order]
            root = forest(len(fps), trie_pairs(cell, fps, max_bits))
            linked = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(reps[linked]), pa.array(reps[root[linked]])], names=["a", "b"])

    # two cells of equal hash only meet in one walk, which still compares fingerprints
    ready = cells.select(key.alias("cell"), "fp", "rep").repartition("cell").sortWithinPartitions("cell")
    return ready.mapInArrow(work, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[tuple]:
    """Batches sorted by their first column, joined and cut so that no group is divided; at least ``rows`` at a time."""
    held, count = [], 0
    for batch in batches:
        cell, fps, reps = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        held.append((cell, fps.view(np.uint64), reps))
        count += len(cell)
        if count < rows:
            continue
        cell, fps, reps = (np.concatenate(x) for x in zip(*held, strict=True))
        cut = int(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[-1])
        if cut:
            yield cell[:cut], fps[:cut], reps[:cut]
        held, count = [(cell[cut:], fps[cut:], reps[cut:])], len(cell) - cut
    if count:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first) per fingerprint: the first row of its group, as a struct (no id, doc_id, h1, h2); rows without id come last.

    Rows are first reduced to one per fingerprint, so groups are made of fingerprints however many rows these have.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2"))
    classes = saved(prints.groupBy("fp").agg(first.alias("own")))
    groups = connected_components(near_edges(classes.select("fp", F.col("fp").alias("rep")), max_bits))
    groups = groups.select(F.col("node").alias("_fp"), "component")
    named = saved(classes.join(groups, F.col("fp") == F.col("_fp"), "left").select("fp", "own", F.coalesce("component", "fp").alias("component")))
    firsts = saved(named.groupBy(F.col("component").alias("_c")).agg(F.min("own").alias("first")))
    return saved(named.join(firsts, F.col("component") == F.col("_c")).select("fp", "first"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Rows of one fingerprint form a class before anything is compared, so copies cost nothing. Null text is empty; texts
    without words have fingerprint zero and are linked like any other. Every row is a document of its own, also where it
    repeats an id; a row with a null id is a member of its group but never its name, and a group of such rows has none.
    An empty table gives an empty result. Other columns are ignored.
    """
    prints = saved(fingerprints(docs, shingle))
    named = _grouped(prints, max_bits).select(F.col("fp").alias("_fp"), F.col("first.doc_id").alias("component_id"))
    return prints.join(named, F.col("fp") == F.col("_fp")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near copies: one of smallest id, all columns kept.

    Rows are told apart by id and text, not by id alone: of rows with null or repeated ids each group keeps one. Null ids come
    last. Rows that repeat id and text are in one group, so one of them stays. An empty table stays empty; columns of
    any name are carried along.
    """
    keep = _grouped(saved(fingerprints(docs, shingle)), max_bits).select("first.h1", "first.h2").distinct()
    h1, h2, k1, k2 = fresh(docs, "_h1", "_h2", "_k1", "_k2")
    keep = saved(keep.toDF(k1, k2))
    marked = docs.withColumns(dict(zip((h1, h2), _row_hashes(), strict=True)))
    met = marked.join(keep, (F.col(h1) == F.col(k1)) & (F.col(h2) == F.col(k2)), "left_semi")
    return met.dropDuplicates([h1, h2]).drop(h1, h2)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
