"""Embedding near-dedup: sorted projection passes compare neighbours in the order of random hashes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import connected_components, saved, table
from faultline.llm.simhash import forest

COSINE = 0.9
# Share of the pairs at just COSINE that some pass is to bring together; passes and window follow from it and the row count.
RECALL = 0.97
LEAST_PASSES = 12
LEAST_WINDOW = 48
HASHES = 48
SEED = 23
# What a task orders and compares: its vectors in double precision, and about 52 bytes a row beside them.
TASK_BYTES = 56_000_000
ROW_BYTES = 52


def search_size(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(passes, window) that bring a pair at ``cosine`` together with a chance of about ``recall``, among ``rows`` evenly spread vectors.

    Two vectors agree in a random sign with the chance p = 1 - angle / pi, and in all of the first log2(rows / window)
    signs, after which no more than a window of rows is left between them, with that power of p. The window grows with the cube
    root of the rows, which holds the number of passes down.
    """
    window = max(LEAST_WINDOW, math.ceil(max(rows, 1) ** (1 / 3)))
    agree = 1 - math.acos(min(max(cosine, -1.0), 1.0)) / math.pi
    once = agree ** max(0.0, math.log2(max(rows, 1) / window))
    passes = LEAST_PASSES if once > 1 - 1e-9 else math.ceil(math.log(1 - recall) / math.log(1 - once))
    return max(LEAST_PASSES, passes), window


def sort_keys(vectors: np.ndarray, passes: int, hashes: int = HASHES, seed: int = SEED) -> np.ndarray:
    """Per vector and pass, ``hashes`` signs of random projections, concatenated to one integer; depends on the dimension."""
    keys = np.zeros((len(vectors), passes), np.int64)
    for p in range(passes):
        planes = np.random.default_rng((seed, p, vectors.shape[1])).normal(size=(vectors.shape[1], hashes))
        for bit in (vectors @ planes > 0).T:
            keys[:, p] = keys[:, p] << 1 | bit
    return keys


def valid_unit(vector: list | None) -> np.ndarray | None:
    """The vector scaled to length one in double precision; None if it is null, empty or zero or holds null or non-finite values."""
    if not vector or any(v is None for v in vector):
        return None
    x = np.asarray(vector, np.float64)
    if not np.isfinite(x).all():
        return None
    x = x / (np.abs(x).max() or 1.0)
    length = np.sqrt(x @ x)
    return x / length if length > 0 else None


def window_links(units: np.ndarray, window: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows, in their order, whose cosine is at least ``cosine``.

    Each row is compared with the ``window`` rows after it, and goes on as long as one of the last ``window`` was linked:
    the bound is on misses, so a dense run is compared to its end however long it is.
    """
    n = len(units)
    last = np.zeros(n, np.int64)
    rows = np.arange(n)
    step = 0
    while len(rows):
        step += 1
        rows = rows[(rows + step < n) & (step - last[rows] <= window)]
        for at in range(0, len(rows), 1 << 15):
            i = rows[at : at + (1 << 15)]
            near = np.einsum("ij,ij->i", units[i], units[i + step]) >= cosine
            if near.any():
                last[i[near]] = step
                yield i[near], i[near] + step


_LINK = ["a", "b", "na", "nb"]
_ROW = ["border", "side", "dim", "pass", "rep", "n", "vector"]


def near_links(classes: DataFrame, cosine: float = COSINE, recall: float = RECALL, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(a, b, na, nb), a < b: pairs of ids of ``classes`` (rep, n, embedding) found in some pass and verified, each once, with their n.

    Every pass orders all vectors by its own hashes. The passes are one range partitioning by (pass, key, hash of the
    id) into tasks of about ``task_bytes``, however long the vectors are, so vectors of one key can be split. Tasks hand on
    the window at either end, and neighbouring windows are compared with each other. Pairs whose hashes differ early in
    every pass are missed; ``search_size`` chooses passes and window by the number of rows.
    """
    passes, window = search_size(classes.count(), cosine, recall)
    kind = classes.schema["embedding"].dataType.elementType.simpleString()
    arrow = pa.float32() if kind == "float" else pa.float64()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [valid_unit(v) for v in batch.column(2).to_pylist()]
            ids = np.array([k for k, u in enumerate(units) if u is not None], np.int64)
            for size in sorted({len(units[k]) for k in ids}):
                own = np.array([k for k in ids if len(units[k]) == size])
                keys = sort_keys(np.array([units[k] for k in own]), passes)
                chosen = [c.take(pa.array(own)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*chosen[:2], pa.array([size] * len(own), pa.int32()), chosen[2], pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["rep", "n", "dim", "vector", "keys"],
                )

    rows = classes.select("rep", "n", "embedding").mapInArrow(keyed, f"rep long, n long, dim int, vector array<{kind}>, keys array<long>")
    rows = saved(rows)
    size = rows.agg(F.sum(F.col("dim").cast("long") * 8 + ROW_BYTES)).first()[0] or 0
    tasks = max(1, -(-size * passes // task_bytes))
    spread = rows.select("rep", "n", "dim", "vector", F.posexplode("keys").alias("pass", "key")).withColumn("salt", F.xxhash64("rep"))
    order = ["dim", "pass", "key", "salt"]
    spread = spread.repartitionByRange(max(tasks, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *order).sortWithinPartitions(*order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            dims, turns = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            cuts = np.flatnonzero(np.r_[True, (dims[1:] != dims[:-1]) | (turns[1:] != turns[:-1]), True])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.column(4).slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, -1)
                group = held.setdefault((int(dims[lo]), int(turns[lo])), [])
                group.append((batch.column(0).slice(lo, hi - lo).to_numpy(), batch.column(1).slice(lo, hi - lo).to_numpy(), part))
        found = []
        task = TaskContext.get().partitionId()
        for number, (name, parts) in enumerate(held.items()):
            reps, counts, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
            units = unit_rows(vectors)
            for i, j in window_links(units, window, cosine):
                found.append(_ordered(reps[i], reps[j], counts[i], counts[j]))
                if sum(map(len, found)) > 2_000_000:
                    found = [np.unique(np.concatenate(found), axis=0)]
                    if len(found[0]) > 1_000_000:
                        yield _links(found.pop(), arrow)
            if number == len(held) - 1:
                yield _border(task, 0, name, reps[-window:], counts[-window:], vectors[-window:], arrow)
            if number == 0:
                yield _border(task - 1, 1, name, reps[:window], counts[:window], vectors[:window], arrow)
        if found:
            yield _links(np.unique(np.concatenate(found), axis=0), arrow)

    kinds = f"a long, b long, na long, nb long, border int, side int, dim int, pass int, rep long, n long, vector array<{kind}>"
    out = saved(spread.select("rep", "n", "dim", "pass", "vector").mapInArrow(compare, kinds))

    def across(table: pa.Table) -> pa.Table:
        sides = []
        for side in (0, 1):
            own = table.filter(pc.equal(table.column("side"), side))
            if not len(own):
                return pa.table([pa.array([], pa.int64())] * 4, names=_LINK)
            vectors = own.column("vector").combine_chunks().flatten().to_numpy().reshape(len(own), -1)
            sides.append((own.column("rep").to_numpy(), own.column("n").to_numpy(), unit_rows(vectors)))
        (reps, counts, units), (other_reps, other_counts, other_units) = sides
        i, j = np.nonzero(units @ other_units.T >= cosine)
        pairs = _ordered(reps[i], other_reps[j], counts[i], other_counts[j])
        return pa.table([pa.array(c.copy()) for c in pairs.T], names=_LINK)

    borders = out.where("border IS NOT NULL").select(*_ROW).groupBy("border", "dim", "pass").applyInArrow(across, "a long, b long, na long, nb long")
    return out.where("border IS NULL").select(*_LINK).unionByName(borders).distinct()


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of valid vectors scaled to length one in double precision."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _ordered(a, b, na, nb) -> np.ndarray:
    swap = a > b
    return np.stack([np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)], axis=1)


def _links(found: np.ndarray, arrow: pa.DataType) -> pa.RecordBatch:
    n = len(found)
    nothing = [pa.nulls(n, pa.int32())] * 4 + [pa.nulls(n, pa.int64())] * 2 + [pa.nulls(n, pa.list_(arrow))]
    return pa.RecordBatch.from_arrays([*[pa.array(c.copy()) for c in found.T], *nothing], names=_LINK + _ROW)


def _border(border: int, side: int, name: tuple[int, int], reps, counts, vectors, arrow: pa.DataType) -> pa.RecordBatch:
    n = len(reps)
    same = [pa.array(np.full(n, x, np.int32)) for x in (border, side, *name)]
    own = [pa.array(reps), pa.array(counts), pa.array(list(vectors), pa.list_(arrow))]
    return pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 4, *same, *own], names=_LINK + _ROW)


def embedding_components(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id (smallest vec_id reachable), kept.

    Equal vectors form a class before anything is compared and link with each other, so copies cost nothing. Links
    between classes are pairs met in some pass with a cosine, in double precision, of at least ``cosine``; a class counts
    as many links as it has rows. Vectors of different lengths never link. Vectors that are null, empty or zero or hold
    null or non-finite values link with nothing, equal ones included. Other columns, labels too, are ignored. A repeated id is one row
    per repetition; its equal vectors link like others. Null ids never name a component.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _plain(vectors).alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda v: v != 0)
    rows = rows.withColumn("part", F.when(F.coalesce(good, F.lit(False)), F.sha2(F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ","), 256)))
    classes = saved(rows.where("part IS NOT NULL").groupBy("part", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    links = saved(near_links(classes.where("rep IS NOT NULL"), cosine, recall))
    both = links.select("a", F.col("nb").alias("n")).unionByName(links.select(F.col("b").alias("a"), F.col("na").alias("n")))
    counted = both.groupBy("a").agg(F.sum("n").alias("more")).withColumnRenamed("a", "_a")
    groups = connected_components(spanning(links))
    named = classes.join(counted, F.col("rep") == F.col("_a"), "left").join(groups, F.col("rep") == F.col("node"), "left")
    named = named.select(
        F.col("part").alias("_part"), (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    met = rows.select("vec_id", "part").join(named, F.col("part") == F.col("_part"), "left")
    component = F.coalesce("component_id", "vec_id")
    return met.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def spanning(links: DataFrame, most: int = 500_000) -> DataFrame:
    """Edges (a, b) that connect what ``links`` connect: each task gives back a forest of its links, so a dense group sheds most."""

    def reduced(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = forest(len(nodes), iter([(place[: len(a)], place[len(a) :])]))
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        return nodes[linked], nodes[root[linked]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            held = tuple(np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True))
            if len(held[0]) > most:
                held = reduced(*held)
                if len(held[0]) > most // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["a", "b"])
                    held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in reduced(*held)], names=["a", "b"])

    return links.select("a", "b").mapInArrow(work, "a long, b long")


def _plain(vectors: DataFrame) -> Column:
    """Vectors of floats travel as such; others in double precision."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    return F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")


def op2_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))
