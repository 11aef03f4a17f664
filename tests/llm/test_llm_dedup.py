"""Exact dedup, SimHash, substring dedup, embeddings and components against brute force on small tables."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from faultline.llm import embedding_dedup, exact_dedup, repeats, simhash
from faultline.llm.common import connected_components


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, 900 + k) for k in range(50)] + [(7, 7), (3, 900), (None, 4)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    plain = [(a, b) for a, b in links if a is not None and a != b]
    assert found == smallest_reachable({n for link in plain for n in link}, plain)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


ROWS = [(1, "a b"), (2, "a b"), (3, "a  b"), (4, None), (5, ""), (6, "é" * 50_000), (7, "é" * 50_000), (8, "A b"), (2, "a b"), (None, "z"), (None, "a b")]


@pytest.mark.parametrize("content_hash", [F.md5, lambda t: F.length(t).cast("string")], ids=["md5", "colliding"])
def test_exact_classes(documents, content_hash):
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    expected = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        expected += [(i, keep, len(ids), i == keep, digest) for i in ids]
    found = exact_dedup.exact_classes(documents(ROWS), content_hash)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_exact_stage_keeps_one_row_and_all_columns(documents):
    docs = documents(ROWS)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(2, "a b"), (3, "a  b"), (5, ""), (7, "é" * 50_000), (8, "A b"), (0, "z")]
    )
    assert exact_dedup.drop_exact_copies(documents([])).count() == 0 and exact_dedup.exact_classes(documents([])).count() == 0


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(v >> bit & 1 for v in values) * 2 > len(values))


def test_fingerprint_is_that_of_sparks_hash(spark):
    assert int(spark.sql("SELECT lower(hex(xxhash64('one two three four')))").first()[0], 16) == simhash.fingerprint(b"One two\tthree  FOUR")


@pytest.mark.parametrize("text", [None, "", " \n", "one", "a b c d e", "x " * 300, "Ünï cödé \x0b w\x1crd " * 9])
def test_fingerprints(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


def test_trie_pairs_and_forest_equal_all_pairs():
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = [s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for s in seeds for _ in range(8)] + seeds[:3]
    fps = [f % (1 << 64) for f in fps]
    group = [rng.randrange(2) for _ in fps]
    order = sorted(range(len(fps)), key=lambda k: (group[k], fps[k]))
    g, f = np.array([group[k] for k in order]), np.array([fps[k] for k in order], np.uint64)
    found = {tuple(sorted(p)) for i, j in simhash.trie_pairs(g, f, 4, frontier=50) for p in zip(i.tolist(), j.tolist(), strict=True)}
    near = {(i, j) for i in range(len(f)) for j in range(i + 1, len(f)) if g[i] == g[j] and (int(f[i]) ^ int(f[j])).bit_count() <= 4}
    assert found == near and len(near) > 50
    root = simhash.forest(len(f), simhash.trie_pairs(g, f, 4))
    assert dict(enumerate(root.tolist())) == smallest_reachable(range(len(f)), near)


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 4])
def test_near_edges_connect_what_all_pairs_do(spark, chunk):
    rng = random.Random(5)
    seeds = [rng.getrandbits(63) for _ in range(25)]
    fps = sorted({s ^ sum({1 << rng.randrange(62) for _ in range(rng.randrange(5))}) for s in seeds for _ in range(6)})
    rows = list(zip(fps, range(len(fps)), strict=True))
    edges = [tuple(e) for e in simhash.near_edges(spark.createDataFrame(rows, "fp long, rep long"), 4, chunk).collect()]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert smallest_reachable(range(len(fps)), edges) == smallest_reachable(range(len(fps)), near)


def near_texts():
    rng = random.Random(11)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(400)) for _ in range(12)]
    rows = [(10 * k + 1, t) for k, t in enumerate(base)] + [(10 * k + 2, t + " end") for k, t in enumerate(base)] + [(10 * k + 3, t.upper()) for k, t in enumerate(base)]
    return [*rows, (900, None), (901, ""), (902, "one"), (903, "x " * 30_000), (1, base[0]), (None, base[1])]


def test_simhash_components(documents):
    rows = near_texts()
    prints = [brute_fingerprint(t) for _, t in rows]
    links = [(a, b) for k, (a, _) in enumerate(rows) for j, (b, _) in enumerate(rows) if a is not None and b is not None and (prints[k] ^ prints[j]).bit_count() <= 4]
    root = smallest_reachable({i for i, _ in rows if i is not None}, links)
    expected = sorted((i or 0, f"{p:016x}", root[i] if i else root[11]) for (i, _), p in zip(rows, prints, strict=True))
    found = simhash.simhash_components(documents(rows)).select("doc_id", "fingerprint", "component_id")
    assert sorted((r[0] or 0, r[1], r[2]) for r in found.collect()) == expected
    kept = simhash.drop_near_copies(documents(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values())) and kept.columns == documents(rows).columns


def test_near_copies_are_told_apart_by_text_and_not_by_id(documents):
    rng = random.Random(17)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(200)) for _ in range(9)]
    rows = list(zip([None] * 6 + [5, 5, 9], texts, strict=True))
    docs = documents([*rows, (9, texts[8]), (None, texts[0]), (4, texts[1])]).withColumns({"_h1": F.lit(1), "_k2": F.lit("x"), "h1": F.lit(0.5)})
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    expected = [(4 if t == texts[1] else i, t) for i, t in rows]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("blocks,shared", [(5, 1), (6, 2), (7, 3), (8, 4)])
def test_every_choice_of_blocks_finds_all_near_pairs(spark, blocks, shared):
    rng = random.Random(6)
    seeds = [rng.getrandbits(63) for _ in range(10)]
    fps = sorted({s ^ sum({1 << rng.randrange(62) for _ in range(rng.randrange(5))}) for s in seeds for _ in range(6)})
    rows = spark.createDataFrame([(f, k) for k, f in enumerate(fps)], "fp long, rep long")
    dealt = {}
    for r in simhash.subtries(rows, blocks, shared).collect():
        dealt.setdefault((r.block, r.bits), []).append(r.rep)
    met = {(a, b) for group in dealt.values() for a in group for b in group if a > b}
    near = {(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4}
    assert near <= met and len(near) > 20


def test_copies_of_a_fingerprint_do_not_grow_with_the_table(spark):
    """Rows dealt per fingerprint depend on the blocks alone, and crowding stays bounded however many there are."""
    assert [simhash.blocks_for(n) for n in (0, 10**6, 10**9, 10**11, 10**13)] == [(5, 1), (5, 1), (6, 2), (7, 3), (8, 4)]
    rng = random.Random(8)
    for n in (500, 5000):
        rows = spark.createDataFrame([(rng.getrandbits(63), k) for k in range(n)], "fp long, rep long")
        assert simhash.subtries(rows, *simhash.blocks_for(n)).count() == 5 * n


def test_simhash_of_no_rows(documents):
    assert simhash.simhash_components(documents([])).count() == 0 and simhash.drop_near_copies(documents([])).count() == 0


def brute_repeats(rows):
    """Per row: words, removed words, digest of the rest. Rows of one id and text are the same document."""
    order = sorted({(float("inf") if i is None else i, t or "") for i, t in rows}, key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    seen, gone = set(), {}
    for i, t in order:
        words = t.encode().split()
        own = gone.setdefault((i, t), set())
        for k in range(len(words) - 19):
            w = tuple(words[k : k + 20])
            if w in seen:
                own.update(range(k, k + 20))
            seen.add(w)
    out = []
    for i, t in rows:
        words, own = (t or "").encode().split(), gone[(float("inf") if i is None else i, t or "")]
        kept = b" ".join(w for k, w in enumerate(words) if k not in own)
        out.append((i or 0, len(words), len(own), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def look_alikes():
    """Texts whose 20 words differ in one long word only, of the kind that polynomial hashes modulo 2**64 confuse."""
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"q{k}" for k in range(19))
    return [(800, f"{rest} {one}"), (801, f"{rest} {other}"), (802, f"{other} {rest} {other}")]


def repeat_rows():
    rng = random.Random(2)
    word = lambda n: [f"w{rng.randrange(40)}" for _ in range(n)]
    passages = [word(n) for n in (19, 20, 21, 35, 80, 300)]
    rows = []
    for k in range(60):
        parts = [p if rng.random() < 0.5 else p[: rng.randrange(1, len(p))] for p in rng.sample(passages, 3)]
        rows.append((k * 3, "\n".join(" ".join(word(rng.randrange(30)) + p) for p in parts)))
    again = " ".join(word(40))
    ends = " ".join(word(20))
    twice = [(700, again), (701, f"a b c {ends}"), (701, f"{ends} u1"), (701, " ".join(word(40))), (700, again), (702, ends)]
    return [*rows, *twice, *look_alikes(), (500, f"{again} {again} {again}"), (501, "a " * 90), (502, None), (503, ""), (504, "é ü\x1cz " * 30), (0, rows[0][1]), (None, rows[5][1])]


@pytest.mark.parametrize("block", [repeats.SHARD_BYTES, 500])
def test_repeats_equal_brute_force(documents, monkeypatch, block):
    monkeypatch.setattr(repeats, "SHARD_BYTES", block)
    rows = repeat_rows()
    found = repeats.drop_repeats(documents(rows))
    digests = found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted((r[0] or 0, *r[1:]) for r in digests) == brute_repeats(rows)
    for r in found.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_repeats_of_no_rows_and_long_texts(documents):
    assert repeats.drop_repeats(documents([])).count() == 0
    long = " ".join(f"v{k}" for k in range(200_000))
    found = {r.doc_id: r.n_removed for r in repeats.drop_repeats(documents([(1, long), (2, "start " + long)])).collect()}
    assert found == {1: 0, 2: 200_000}


def test_words_are_numbered_alike_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 64)
    text = ("one two\tthree\x0bfour \x1c " + "y" * 200 + "\n").encode() * 5
    rows, known = repeats.word_numbers([text, b"", b"two"])
    words = text.split()
    assert [known[k] for k in rows[0]] == words and len(rows[1]) == 0 and [known[k] for k in rows[2]] == [b"two"]
    assert len(known) == len(set(words))
    for numbers, different, expected in (([0, 1, 63], 64, 1), ([0, 64, 4095], 4096, 2), ([0, 5, 300_000], 300_001, 4)):
        line, width = repeats.symbols(np.array(numbers, np.int32), different)
        assert width == expected and len({line[k * width : (k + 1) * width] for k in range(3)}) == 3


def test_places_come_from_the_automaton_alone(documents, monkeypatch):
    rows = repeat_rows()
    assert any(r.n_removed for r in repeats.drop_repeats(documents(rows)).collect())
    shard = repeats.Shard([b" ".join(b"w%d" % (k % 50) for k in range(200))])
    everywhere = np.unique(shard.phrases)
    assert len(shard.located(everywhere)) == 181 and len(shard.located(everywhere[:0])) == 0

    class Deaf:
        def __init__(self, *_):
            pass

        add_word = make_automaton = lambda self, *_: None
        __len__ = lambda self: 1
        iter = lambda self, _: iter(())

    monkeypatch.setattr(repeats.ahocorasick, "Automaton", Deaf)
    assert len(shard.located(everywhere)) == 0


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        rows += [(len(rows) + k, (centre + rng.normal(size=16) * 0.15).astype(float).tolist()) for k in range(8)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15), (1004, []), (1005, rows[0][1]), (1006, rows[0][1])]
    return [*rows, (1007, [1.0, 2.0]), (1008, [2.0, 4.0]), (1009, [float("inf")] * 16), (1010, [0.0] * 16), (3, rows[3][1]), (None, rows[4][1])]


def test_embedding_components(spark):
    rows = vectors()
    unit = [embedding_dedup.valid_unit(v) for _, v in rows]
    n, links = [0] * len(rows), []
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                n[i] += 1
                if rows[i][0] is not None and rows[j][0] is not None:
                    links.append((rows[i][0], rows[j][0]))
    root = smallest_reachable({i for i, _ in rows if i is not None}, links)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, part string")
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_components(frame).collect()}
    assert found == {(i, k, root.get(i, root[4]), i is not None and root[i] == i) for (i, _), k in zip(rows, n, strict=True)}
    assert sum(n) > 200
    assert embedding_dedup.embedding_components(frame.limit(0)).count() == 0


def test_neighbours_on_both_sides_of_a_task_border_meet(spark):
    """One row a task, so every link of this chain lies across a border; all keys are alike, so order is by hash of the id."""
    rows = [(k, 1, [1.0, 0.001 * k]) for k in range(40)]
    frame = spark.createDataFrame(rows, "rep long, n long, embedding array<double>")
    links = {(r.a, r.b) for r in embedding_dedup.near_links(frame, task_bytes=600).collect()}
    assert smallest_reachable(range(40), links) == dict.fromkeys(range(40), 0)


@pytest.mark.parametrize("rows", [6_000, 60_000])
def test_recall_of_pairs_at_the_threshold(rows):
    """Planted pairs at cosine 0.9 to 0.92 among random vectors: the share that lies within a window in some pass."""
    rng = np.random.default_rng(rows)
    half = rows // 2
    a = rng.normal(size=(half, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(half, 64))
    b -= np.einsum("ij,ij->i", a, b)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    cosine = rng.uniform(0.9, 0.92, half)[:, None]
    passes, window = embedding_dedup.search_size(rows)
    keys = embedding_dedup.sort_keys(np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * b]), passes)
    met = np.zeros(half, bool)
    for p in range(passes):
        place = np.argsort(np.argsort(keys[:, p], kind="stable"))
        met |= np.abs(place[:half] - place[half:]) <= window
    assert met.mean() >= 0.9


def test_search_grows_with_the_table():
    sizes = [embedding_dedup.search_size(n) for n in (0, 1, 1000, 10**5, 10**7, 10**9)]
    assert sizes == sorted(sizes) and sizes[0] == (12, 48) and sizes[-1][1] == 1000


def test_window_follows_dense_runs_to_their_end():
    units = np.repeat(np.eye(4), [3, 200, 5, 1], axis=0)
    found = {(a, b) for i, j in embedding_dedup.window_links(units, 2, 0.9) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert len(found) == 3 + 200 * 199 // 2 + 10
