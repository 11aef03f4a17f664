"""Toxicity: a factorization machine over hashed terms, trained here, scores every document."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import fresh, saved, table

# The model is fitted on at most this many labelled rows, chosen by the hash of their id.
TRAIN_ROWS = 20_000
BUCKETS = 1 << 18
# Terms the model knows: those whose share of toxic documents departs most from the average.
TERMS = 1024
LEAST_ROWS = 4
FACTORS = 8
EPOCHS = 25
BATCH = 512
# Few rows are gone through more often, until so many steps are taken.
LEAST_STEPS = 150
PENALTY = 1e-4
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MEMO = 300_000


def word_buckets(word: str) -> list[int]:
    """Hash buckets of a word's terms: the word, and its beginnings, which inflected forms share."""
    terms = [word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]
    return [zlib.crc32(t.encode()) % BUCKETS for t in terms]


def words_of(text: str | None) -> set[str]:
    """Distinct words of a whole text, letters lower-cased; null has none."""
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Machine:
    """sigmoid(bias + sum w_i + sum over pairs of v_i * v_j) over the terms present."""

    buckets: np.ndarray  # sorted
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, present: np.ndarray) -> float:
        """Of a row of sorted positions of terms."""
        v = self.factors[present]
        total = v.sum(axis=0)
        z = self.bias + self.weights[present].sum() + 0.5 * float((total * total).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(rows: list[np.ndarray], labels: np.ndarray, buckets: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Adam over mini-batches of the rows' log loss with small penalties. Without rows nothing is known to be toxic: scores are near 0."""
    n, m = len(rows), len(buckets)
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(m), rng.normal(0, 0.02, (m, factors)), -40.0
    if n:
        rate = (labels.sum() + 0.5) / (n + 1)
        b = float(np.log(rate / (1 - rate)))
    steps = [np.zeros_like(x) for x in (w, v, np.zeros(1))]
    squares = [np.zeros_like(x) for x in (w, v, np.zeros(1))]
    t = 0
    rounds = max(epochs, -(-LEAST_STEPS // -(-n // BATCH))) if n and m else 0
    for _ in range(rounds):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            chosen = order[at : at + BATCH]
            x = np.zeros((len(chosen), m))
            for k, r in enumerate(chosen):
                x[k, rows[r]] = 1
            s = x @ v
            z = b + x @ w + 0.5 * ((s * s).sum(axis=1) - x @ (v * v).sum(axis=1))
            e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[chosen]) / len(chosen)
            grads = (
                x.T @ e + PENALTY * w,
                x.T @ (e[:, None] * s) - v * (x.T @ e)[:, None] + 1e-4 * v,
                np.array([e.sum()]),
            )
            t += 1
            moves = []
            for k, g in enumerate(grads):
                steps[k] = 0.9 * steps[k] + 0.1 * g
                squares[k] = 0.999 * squares[k] + 0.001 * g * g
                moves.append(0.02 * (steps[k] / (1 - 0.9**t)) / (np.sqrt(squares[k] / (1 - 0.999**t)) + 1e-8))
            w, v, b = w - moves[0], v - moves[1], b - float(moves[2][0])
    return Machine(buckets, b, w, v)


def held_out(doc_id):
    """Rows whose labels are never learnt: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, terms: int = TERMS) -> Machine:
    """Fit on at most ``rows`` labelled documents that are not held out.

    The driver sees the ids of these rows, the counts of the best ``terms`` buckets and, per row, which of those it
    holds. A document with several labels counts as toxic if one says so, and one with several texts shows the least of them, so no
    id gives two rows; labels without a document are ignored. Terms seen in fewer than ``LEAST_ROWS`` of these rows are left
    out, and few rows are gone through until ``LEAST_STEPS`` steps are taken, at every size of the tables.
    """
    known = labels.where(labels["toxic"].isNotNull() & ~held_out(labels["doc_id"])).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("_id"), "_toxic")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    texts = texts.groupBy("doc_id", "_toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({b for w in words_of(t) for b in word_buckets(w)}) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "toxic", "terms"]
            )

    rows_of = saved(texts.select("doc_id", "_toxic", "text").mapInArrow(hashed, "doc_id long, toxic int, terms array<int>"))
    n, toxic = rows_of.agg(F.count("*"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    rate = toxic / n if n else 0.0
    spread = F.sqrt(F.greatest(F.col("n") * (rate * (1 - rate)), F.lit(1e-9)))
    best = (
        rows_of.select("toxic", F.explode("terms").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
        .where(F.col("n") >= LEAST_ROWS)
        .orderBy(F.abs((F.col("t") - F.col("n") * rate) / spread).desc(), "bucket")
        .limit(terms)
    )
    buckets = np.array(sorted(r.bucket for r in best.collect()), np.int64)

    def known_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.flatnonzero(np.isin(buckets, t)).astype(np.int32) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "toxic", "at"])

    read = sorted((r.doc_id, r.toxic, tuple(r["at"])) for r in rows_of.mapInArrow(known_only, "doc_id long, toxic int, at array<int>").collect())
    return fit([np.array(r[2], np.int64) for r in read], np.array([r[1] for r in read], float), buckets)


def score_texts(machine: Machine, texts: list[str | None], memo: dict) -> list[float]:
    where = {int(b): k for k, b in enumerate(machine.buckets)}
    scores = []
    for text in texts:
        present: set[int] = set()
        for word in words_of(text):
            found = memo.get(word)
            if found is None:
                if len(memo) >= _MEMO:
                    memo.clear()
                found = memo[word] = tuple(where[b] for b in word_buckets(word) if b in where)
            if found:
                present.update(found)
        scores.append(machine.score(np.array(sorted(present), np.int64)))
    return scores


def with_scores(docs: DataFrame, machine: Machine, keep: list[str], score: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` and a double ``score`` of each row's whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            scores = score_texts(machine, batch.column(batch.num_columns - 1).to_pylist(), memo)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*keep, score])

    columns = docs.select(*[docs[c] for c in keep], docs["text"].cast("string").alias(fresh(docs, "_text")[0]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return columns.mapInArrow(work, f"{fields}, `{score}` double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    A score depends on the text alone. Null text is empty and scores like any text without known terms; without labels
    every document scores near 0. Repeated rows and ids are scored row by row; other columns are ignored.
    """
    scored = with_scores(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, all columns kept: those that ``toxicity_scores`` does not predict toxic."""
    score = fresh(docs, "_score")[0]
    return with_scores(docs, train(docs, labels), docs.columns, score).where(F.col(score) < threshold).drop(score)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
