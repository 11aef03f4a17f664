"""Mixing, packing, the pipeline, and registered queries against their SQL."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from faultline.llm import exact_dedup, mixing, packing, queries, simhash, toxicity
from faultline.llm.common import table


def brute_targets(sizes, weights=(5, 2, 1)):
    """Deal, stop at twice the size, deal the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * share >= 2 * sizes[s]}
        for s in full or free:
            target[s] = 2.0 * sizes[s] if full else weight[s] * share
        left -= sum(target[s] for s in full)
        free = free - full if full else set()
    return target


def mix_rows():
    rng = random.Random(8)
    rows = [(k, "w " * int(rng.expovariate(0.02)), rng.choice(["a", "a", "a", "a", "b", "é", "Z", None])) for k in range(500)]
    return [*rows, (600, None, "b"), (601, "", "empty"), (602, "x " * 20_000, "b"), *[(700 + k, "same text here", "a") for k in range(60)], (5, *rows[5][1:])]


def test_mix(documents):
    rows = mix_rows()
    found = mixing.mix(documents(rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = brute_targets(sizes)
    assert len(found) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], rel=1e-9) and 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 2, s
    again = sorted(((r.doc_id, r.size, r.copies) for r in mixing.mix(documents(rows[::-1])).collect()))
    assert again == sorted((r.doc_id, r.size, r.copies) for r in found)


def test_rates_are_the_entropy_balancing_solution(spark):
    """Exponential in size below the bound, and the words meet the target."""
    hist = spark.createDataFrame([(1, s, s % 7 + 1) for s in range(1, 60)] + [(2, 10, 5)], "k int, size long, n long")
    total = sum(s * (s % 7 + 1) for s in range(1, 60))
    targets = spark.createDataFrame([(1, total, total * 1.3), (2, 50, 100.0)], "k int, source_size long, target double")
    rates = {(r.k, r["size"]): r.rate for r in mixing.balanced_rates(hist, targets).collect()}
    assert sum(s * (s % 7 + 1) * rates[1, s] for s in range(1, 60)) == pytest.approx(total * 1.3, rel=1e-8) and rates[2, 10] == 2
    free = np.array([(s, np.log(rates[1, s])) for s in range(1, 60) if rates[1, s] < 2])
    assert np.allclose(free[:, 1] / free[:, 0], free[0, 1] / free[0, 0])


def test_apply_mix(documents):
    docs = documents([r for r in mix_rows() if r[0] != 5])
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    counts = {r.doc_id: r["count"] for r in mixing.apply_mix(docs).groupBy("doc_id").count().collect()}
    assert counts == {i: c for i, c in copies.items() if c} and mixing.apply_mix(docs).columns == docs.columns
    assert mixing.mix(documents([])).count() == 0 and mixing.apply_mix(documents([])).count() == 0
    assert [r.copies for r in mixing.mix(documents([(1, None, None), (2, "", "b")])).collect()] == [0, 0]


def test_mix_of_rows_without_and_with_one_id(documents):
    for rows in ([(None, "w w w")] * 100, [(k // 10, "w w w") for k in range(100)], [(7, f"w w {k}") for k in range(100)]):
        found = mixing.mix(documents(rows)).collect()
        # one source: its target is 150 % of its size
        assert sum(r["size"] * r.copies for r in found) == 450 and max(r.copies for r in found) <= 2
        docs = documents(rows).withColumns({"_copy": F.lit(1), "_copies": F.lit("x"), "_id": F.lit(2), "_number": F.lit(0)})
        taken = mixing.apply_mix(docs)
        assert taken.columns == docs.columns and taken.count() == 150
        assert {(r.doc_id, r.text) for r in taken.collect()} <= set(rows)


def plain_best_fit(sizes, capacities, bound, cost):
    """The same rule with lists, and what it costs."""
    bins, placed, left = [], [], sum(sizes)
    for size in sizes:
        fitting = [b for b in bins if b[1] - b[0] >= size]
        if fitting:
            chosen = min(fitting, key=lambda b: b[1] - b[0])
        else:
            least = min(c for c in capacities if c >= size)
            allowed = [c for c in capacities if c == least or size <= c <= bound]
            chosen = [0, min(allowed, key=lambda c: (cost.of(c) / min(c, left), c))]
            bins.append(chosen)
        placed.append(chosen)
        chosen[0] += size
        left -= size
    return sum(cost.of(min(c for c in capacities if c >= used)) for used, _ in bins)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_costs_what_the_plain_rule_does(seed):
    rng = random.Random(seed)
    capacities, cost = (16, 32, 64, 128), packing.Cost(4.0, 200.0)
    sizes = sorted((min(128, 1 + int(rng.expovariate(0.04))) for _ in range(rng.choice([1, 30, 400]))), reverse=True)
    placed, lengths = packing.best_fit(sizes, capacities, cost)
    assert sum(map(cost.of, lengths)) == pytest.approx(min(plain_best_fit(sizes, capacities, b, cost) for b in capacities))
    filled = [0] * len(lengths)
    for (b, offset), size in zip(placed, sizes, strict=True):
        assert offset == filled[b]
        filled[b] += size
    assert all(0 < f <= c == next(x for x in capacities if x >= f) for f, c in zip(filled, lengths, strict=True))


@pytest.mark.parametrize("shard_rows", [packing.SHARD_ROWS, 20])
def test_pack(documents, shard_rows):
    rng = random.Random(4)
    rows = [(k, "w " * int(rng.expovariate(0.01))) for k in range(150)] + [(200, None), (201, ""), (202, "w " * 3000), (202, "w " * 3000), (203, "w " * 1024), (None, "w w"), (2**53 + 1, "w w w")]
    sized = documents(rows).select("doc_id", F.coalesce(F.size(F.expr("filter(split(text, ' '), w -> w <> '')")), F.lit(0)).alias("size"), "score")
    sized = sized.withColumn("size", F.when(F.col("size") < 0, 0).otherwise(F.col("size")))
    found = packing.pack(sized, (128, 256, 512), shard_rows=shard_rows).collect()
    words, bins, pieces = {}, {}, {}
    for r in found:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.n_words
        pieces.setdefault(r.doc_id, []).append((r.piece_start, r.piece_start + r.n_words))
        if r.bin_id is None:
            assert r.n_words == 0
        else:
            bins.setdefault((r.bin_id, r.bin_capacity), []).append((r.bin_offset, r.n_words))
    expected = {}
    for i, t in rows:
        expected[i] = expected.get(i, 0) + len((t or "").split())
    assert words == expected and len({b for b, _ in bins}) == len(bins)
    for (_, capacity), held in bins.items():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity and (capacity == 128 or at > capacity // 2)
    assert all(sorted(p)[0][0] == 0 and all(a[1] == b[0] for a, b in zip(sorted(p), sorted(p)[1:], strict=False)) for i, p in pieces.items() if i != 202)
    assert packing.pack(sized.limit(0)).count() == 0 and packing.pack_documents(documents([])).count() == 0


def test_pipeline_stages_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, folder).cache()
        out[name] = new
        if name != "packing":
            assert new.columns == docs.columns and [f.dataType for f in new.schema] == [f.dataType for f in docs.schema]
            docs = new
    first = table(spark, folder, "documents")
    ids = {name: sorted(r.doc_id for r in frame.collect()) for name, frame in out.items()}
    scores = toxicity.toxicity_scores(first, table(spark, folder, "labels")).collect()
    assert ids["toxicity"] == sorted(r.doc_id for r in scores if not r.predicted)
    newest = {}
    for r in out["toxicity"].collect():
        newest[r.text or ""] = max(r.doc_id, newest.get(r.text or "", -1))
    assert ids["exact_dedup"] == sorted(newest.values())
    prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in out["exact_dedup"].collect()}
    root = {i: i for i in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if b > a and (prints[a] ^ prints[b]).bit_count() <= 4 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert ids["simhash_dedup"] == sorted(set(root.values()))
    copies = [i for r in mixing.mix(out["simhash_dedup"]).collect() for i in [r.doc_id] * r.copies]
    assert ids["mixing"] == sorted(copies)
    assert out["packing"].agg(F.sum("n_words")).first()[0] == sum(len((r.text or "").encode().split()) for r in out["mixing"].collect())
    run = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in run.collect()) == ids["packing"] and exact_dedup.drop_exact_copies(out["mixing"]).count() == len(set(ids["mixing"]))


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for t in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    frame = entry_points.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry_points.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, frame.select(*columns).collect()), key=repr) == sorted(result, key=repr)


def test_all_queries_are_registered():
    names = set(entry_points.queries())
    assert {*queries.QUERIES, "pipeline"} <= names and {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
