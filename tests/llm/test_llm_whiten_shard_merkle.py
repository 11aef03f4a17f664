"""Whitening, sharding and the Merkle manifest against plain computations and their contracts' conditions."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm.common import numbered
from faultline.llm.merkle import manifest
from faultline.llm.queries import QUERIES
from faultline.llm.sharding import admitted, seeded, shard_documents
from faultline.llm.whitening import Space, eigen, polar, whiten

SMALL = "/root/testdata/sf0.001"


# -- numbering ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_numbered_has_no_gaps_over_tasks(spark, parts):
    keys = [None, None, "a", "a", *["b"] * 300, "c", "d", *["e"] * 40]
    rows = spark.createDataFrame([(k, (i * 37) % 101, i) for i, k in enumerate(keys)], "k string, o int, i int").repartition(parts)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts * 2))
    try:
        found = numbered(rows, "k", ["o"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == len(keys)
    by = defaultdict(list)
    for r in found:
        by[r.k].append(r)
    order = sorted(by, key=lambda k: (k is not None, k or ""))
    for number, k in enumerate(order):
        own = sorted(by[k], key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        assert {r.group_no for r in own} == {number}
        assert [r.o for r in own] == sorted(r.o for r in own)


# -- op11 -----------------------------------------------------------------------------------------------------


def brute_whiten(vectors, k):
    kept = [(i, v) for i, v in vectors if v is not None and all(e is not None and np.isfinite(e) for e in v)]
    x = np.array([[int(np.floor(64 * np.float64(e))) + 1000000 for e in v] for _, v in kept])
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    cov = y.T @ y / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    white = y @ basis / np.sqrt(values)
    return {
        (i, c + 1): (n, sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)), white[r, c], values[c] / np.trace(cov))
        for r, ((i, _), row) in enumerate(zip(kept, x, strict=True))
        for c in range(min(k, len(values)))
    }


def test_whitening_equals_plain_eigenvectors(spark):
    rng = np.random.default_rng(1)
    mixed = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))
    rows = [(i, [float(e) for e in v]) for i, v in enumerate(mixed.astype(np.float32))]
    rows += [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("-inf")] + [0.0] * 11), (5, rows[7][1])]
    table = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<float>, n int, component string, whitened double")
    found = whiten(table.repartition(3), 8).collect()
    assert not {r.vec_id for r in found} & {900, 901, 902, 903}
    assert len(found) == 301 * 8
    expect = brute_whiten([(100000 + k, v) for k, (_, v) in enumerate(rows)], 8)
    by_row = Counter((r.vec_id, r.component) for r in found)
    assert by_row[(5, 1)] == 2  # a repeated id is whitened row by row
    sign = {}
    for r in sorted(found, key=lambda r: (r.vec_id, r.component)):
        if r.vec_id == 5:
            continue
        n, deviation, white, share = expect[(100000 + r.vec_id, r.component)]
        s = sign.setdefault(r.component, np.sign(white * r.whitened))
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(s * r.whitened - white) < 1e-9
        assert abs(r.explained / share - 1) < 1e-10
        assert r.identity_error < 1e-9


def test_whitening_of_edge_tables(spark):
    kind = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]):
        assert whiten(spark.createDataFrame(rows, kind)).collect() == []
    two = [(1, [0.0, 1.0]), (2, [2.0, 1.5]), (None, [4.0, 0.5]), (4, [1.0]), (5, [3.0]), (6, [1e300]), (7, [2.0**60])]
    found = whiten(spark.createDataFrame(two, kind)).collect()
    assert Counter(r.n for r in found) == {3: 6, 2: 2}  # each length for itself; entries too large for an exact long are left out
    assert sorted(r.whitened for r in found if r.n == 2) == [-1.0, 1.0]


def test_deviation_is_exact_beyond_float_and_long():
    space = Space(3, np.array([3 * 10**15 + 1], object), 10**15)
    assert space.deviation(np.array([[10**15]])) == [1]
    assert space.deviation(np.array([[2 * 10**15]])) == [None]
    assert Space(10**6, np.array([0], object), 10**6).deviation(np.array([[3]])) == [9 * 10**12]


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [1, 1, 1], [1e8, 1, 1e-3, 1e-3], [0, 0, 7], [3], [2, 2, 1, 1, 0]])
def test_split_finds_all_eigenvectors(values):
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(len(values),) * 2))[0]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, x = eigen(a)
    size = max(values)
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-13 * size)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ x - x * found).max() < 1e-13 * size * len(values)


def test_polar_factor_is_orthogonal_also_near_singular():
    q = np.linalg.qr(np.random.default_rng(4).normal(size=(6, 6)))[0]
    a = q @ np.diag([3, 1, 1e-9, -1e-9, -2, -5]) @ q.T
    u = polar((a + a.T) / 2)
    assert np.abs(u @ u - np.eye(6)).max() < 1e-12
    assert np.abs(u - q @ np.diag([1, 1, 1, -1, -1, -1]) @ q.T).max() < 1e-5
    assert polar(np.zeros((3, 3))) is None and polar(np.diag([1.0, 0.0])) is None


# -- op12 -----------------------------------------------------------------------------------------------------


def check_shards(rows, shards, texts):
    counts = Counter(r.shard for r in rows)
    assert all(0 <= s < shards for s in counts)
    assert max(counts.values(), default=0) - min([counts.get(s, 0) for s in range(shards)], default=0) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert all((r.law, r.grown_shard) == ("rows", None) for r in rows)
    if texts is not None:
        for r in rows:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    used = defaultdict(set)
    for r in rows:
        used[(r.size, r.text_crc32)].add(r.shard)
    return used


def test_linked_documents_share_shards_of_equal_rows(spark, documents):
    rows, n = [], 0
    for g in range(60):  # groups of 2 to 7
        for _ in range(2 + g % 6):
            rows.append((n, f"group {g} é"))
            n += 1
    rows += [(n + k, "hot text") for k in range(250)]
    n += 250
    rows += [(n + k, f"alone {k}") for k in range(230)]
    found = shard_documents(documents(rows), 10).collect()
    used = check_shards(found, 10, dict(rows))
    hot = [r for r in found if r.group_size == 250]
    assert len({r.shard for r in hot}) == -(-250 // (len(rows) // 10))  # no more shards than it needs
    split = sum(len(s) > 1 for k, s in used.items() if k != (hot[0].size, hot[0].text_crc32))
    assert split <= 1
    again = shard_documents(documents(rows), 10).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)


def test_shards_where_all_documents_are_linked(spark, documents):
    rows = [(k, f"pair {k // 2}") for k in range(400)]
    used = check_shards(shard_documents(documents(rows), 10).collect(), 10, dict(rows))
    assert sum(len(s) > 1 for s in used.values()) <= 20  # of 200 pairs; full shards hold what cannot be moved


def test_shards_of_edge_tables(spark, documents):
    assert shard_documents(documents([]), 4).collect() == []
    rows = [(1, None), (1, ""), (1, "same"), (None, "same"), (None, None), (2, "x" * 200_000), (3, "ends\n")]
    found = shard_documents(documents(rows), 4).collect()
    check_shards(found, 4, None)
    assert sorted((r.size, r.group_size) for r in found) == [(16, 3), (16, 3), (16, 3), (20, 2), (20, 2), (21, 1), (200016, 1)]
    assert [r.text_crc32 for r in found if r.size == 16] == [0, 0, 0]


def test_flows_keep_to_the_room():
    demand = np.array([[0, 10, 0], [4, 0, 0], [0, 6, 0]])
    for room in ([0, 0, 0], [0, 3, 0], [5, -2, 9]):
        flow = admitted(demand, np.array(room))
        assert (flow <= demand).all() and (flow >= 0).all()
        assert (flow.sum(axis=0) - flow.sum(axis=1) <= np.maximum(room, 0)).all()
    assert admitted(demand, np.array([0, 3, 0])).sum() > 3  # shards also swap
    room = [5, 5, 5]
    assert seeded([(1, 7), (2, 3)], room) == [(1, 0, 5), (1, 1, 2), (2, 1, 3)]
    assert room == [0, 0, 5]


# -- op13 -----------------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def brute_tree(nodes):
    """(root, siblings of every node from the bottom up, with its place)."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            lo = at[k] // 16 * 16
            path.append((nodes[lo : at[k]], nodes[at[k] + 1 : lo + 16]))
            at[k] //= 16
        nodes = [sha("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r, brute_leaf(r)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = brute_tree([leaf for _, leaf in by[s]])
    root, tops = brute_tree([trees[s][0] for s in order]) if order else (None, [])
    out = []
    for s, top in zip(order, tops, strict=True):
        for (r, leaf), path in zip(by[s], trees[s][1], strict=True):
            whole = path + top
            chosen = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            digest = brute_leaf([*r[:4], lower(r[4])]) if chosen else leaf
            for left, right in whole:
                digest = sha("".join(left) + digest + "".join(right))
            proof = sha("".join("".join(left) + "".join(right) for left, right in whole))
            out.append((r[0], leaf, trees[s][0], root, proof, digest, digest == root))
    return sorted(out, key=repr)


KIND = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [257], [700, 1, 16, 300, 257], [3] * 20, [], [273, 4369]])
def test_manifest_equals_plain_trees(spark, sizes):
    rows, n = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n * 7 % 10007, None if k == 2 else f"src {'é' if k % 2 else 'z'}{k}", "en" if n % 3 else None, n if n % 4 else None, f"Text {n} Ä" if n % 5 else None))
            n += 1
    docs = spark.createDataFrame(rows, KIND).repartition(3)
    assert sorted(map(tuple, manifest(docs).collect()), key=repr) == brute_manifest(rows)


def test_manifest_of_odd_rows(spark):
    rows = [
        (None, "a", None, None, None), (None, "a", "en", 1, "X"), (5, "a", "en", 1, "SAME"), (5, "a", "en", 1, "SAME"), (5, "a", "en", 1, "other"),
        (2**60 + 1, "", "en", -3, ""), (7, None, "de", 2, "B" * 300_000), (9, "\U0001f600", "en", 0, "x"), (10, "￿", "en", 0, "X"),
    ]
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], KIND + ", tree string, position string, block int, leaf string").repartition(2)
    found = manifest(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_manifest(rows)


def test_manifest_catches_every_change_of_a_text(spark):
    rows = [(k, f"s{k % 2}", "en", 1, "Upper" if k % 2 else "lower") for k in range(200)]
    found = {r.doc_id: r.verified for r in manifest(spark.createDataFrame(rows, KIND)).collect()}
    for k, _, _, _, text in rows:
        assert found[k] == (zlib.crc32(str(k).encode()) % 5 != 0 or text == "lower")


# -- registered queries ---------------------------------------------------------------------------------------


def test_registered_queries_cover_whole_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    n = docs.count()
    sharded = QUERIES["op12_sharding"](spark, SMALL).collect()
    check_shards(sharded, 40, {r.doc_id: r.text for r in docs.collect()})
    assert len(sharded) == n
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_merkle"](spark, SMALL).collect()), key=repr) == brute_manifest(rows)
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").where(F.col("embedding").isNotNull()).collect()
    found = QUERIES["op11_whitening"](spark, SMALL).collect()
    expect = brute_whiten([(r.vec_id, r.embedding) for r in vectors], 32)
    assert {(r.vec_id, r.component): (r.n, r.deviation) for r in found} == {k: v[:2] for k, v in expect.items()}
    assert max(abs(abs(r.whitened) - abs(expect[(r.vec_id, r.component)][2])) for r in found) < 1e-8
