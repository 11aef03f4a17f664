import random

import pytest
from pyspark.sql import functions as F

from faultline.functions.similarity import lcs_lengths, lcs_table, ratios, token_set_score
from faultline.operators import leaders
from faultline.operators.best_match import best_match
from faultline.operators.leaders import candidate_pairs, elect, greedy_leaders, scored_pairs, similar_pairs
from faultline.plans import mapping


def variants(rng, count):
    """Names in groups of near copies, and plain noise."""
    out = set()
    while len(out) < count:
        base = "".join(rng.choice("ABCDE ") for _ in range(rng.randrange(4, 30))).strip()
        for _ in range(rng.randrange(1, 5)):
            word = list(base)
            for _ in range(rng.randrange(0, 3)):
                if word:
                    word[rng.randrange(len(word))] = rng.choice("ABCDE")
            out.add("".join(word).strip())
    return sorted(out)[:count]


def greedy(names, threshold):
    """The definition: names in order, each free one leads and takes the free similar ones."""
    taken = {}
    for i, name in enumerate(names):
        if name in taken:
            continue
        taken[name] = name
        for other in names[i + 1 :]:
            if other not in taken and ratios([name], [other])[0] >= threshold:
                taken[other] = name
    return taken


@pytest.mark.parametrize("threshold", [90, 80, 60])
def test_leaders_equal_the_sequential_result(spark, threshold):
    rng = random.Random(threshold)
    names = variants(rng, 70) + [""]
    rng.shuffle(names)
    nodes = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "form string, rank int")
    found = greedy_leaders(nodes, threshold)
    assert {r["form"]: r["leader"] for r in found.collect()} == greedy(names, threshold)
    assert greedy_leaders(nodes.limit(0), threshold).count() == 0


def greedy_graph(nodes, pairs):
    near = {n: {b for a, b in pairs if a == n} for n in nodes}
    taken = set()
    for n in nodes:
        if n not in taken:
            taken |= near[n]
    return taken


def test_election_takes_as_many_rounds_as_decisions_depend_on_each_other(spark):
    def rounds(pairs):
        taking, n = elect(spark.createDataFrame([(f"{a:04}", f"{b:04}") for a, b in pairs], "first string, second string"))
        found = {int(r.second) for r in taking.collect()}
        assert found == greedy_graph(sorted({x for p in pairs for x in p}), pairs)
        return n

    assert rounds([(0, k) for k in range(1, 200)]) == 1  # a large group goes with its first name
    assert rounds([(k, j) for k in range(40) for j in range(k + 1, 40)]) == 1  # also if all are alike
    assert rounds([(3 * k, 3 * k + 1) for k in range(100)]) == 1  # groups do not wait for each other
    assert rounds([(k, k + 1) for k in range(12)]) == 6  # a chain is the worst case: two names a round
    rng = random.Random(5)
    pairs = {tuple(sorted(rng.sample(range(300), 2))) for _ in range(900)}
    assert rounds(pairs) <= 8


def test_no_task_holds_all_names(spark):
    names = variants(random.Random(1), 60)
    nodes = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "form string, rank int")
    plan = similar_pairs(nodes, 80)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("threshold", [95, 90, 75, 50])
def test_candidates_miss_no_similar_pair(spark, threshold):
    names = variants(random.Random(7), 150)
    nodes = spark.createDataFrame([(n,) for n in names], "form string")
    found = {(r[0], r[1]) for r in candidate_pairs(nodes, nodes, threshold).collect()}
    left, right = zip(*[(a, b) for a in names for b in names if a != b])
    for a, b, score in zip(left, right, ratios(list(left), list(right))):
        if score >= threshold:
            assert (a, b) in found


@pytest.mark.parametrize("a, b", [(9, 12), (12, 9), (70, 64), (70, 80), (0, 5), (0, 0)])
def test_table_of_common_subsequences(a, b):
    rng = random.Random(a * 100 + b)
    sides = [["Ab" * k + "".join(rng.choice("ABC\U0001f600") for _ in range(size)) + "z" * k for _ in range(7)] for size in (a, b) for k in (3,)]
    expected = [lcs_lengths([x] * 7, sides[1]).tolist() for x in sides[0]]
    assert lcs_table(*sides).tolist() == expected


@pytest.mark.parametrize("dense", [0, 10, 10**9])
@pytest.mark.parametrize("threshold", [90, 75, 50])
def test_joined_and_compared_pairs_are_all_similar_pairs(spark, monkeypatch, dense, threshold):
    monkeypatch.setattr(leaders, "DENSE", dense)
    monkeypatch.setattr(leaders, "BLOCK", 5)
    names = [*variants(random.Random(threshold), 90), "", *[f"SUPPLIER {i:06}" for i in range(20)]]
    left, right = (spark.createDataFrame([(i, n) for i, n in enumerate(side)], "id long, form string") for side in (names, names[::2]))
    found = sorted(tuple(r) for r in scored_pairs(left, right, threshold).collect())
    expected = []
    for i, a in enumerate(names):
        scores = ratios([a] * len(names[::2]), names[::2])
        expected += [(i, j, float(s)) for j, s in enumerate(scores) if s >= threshold]
    assert found == expected
    nodes = left.select("form", F.col("id").alias("rank"))
    pairs = sorted((r.first_rank, r["second"]) for r in similar_pairs(nodes, threshold).collect())
    scores = {i: ratios([a] * len(names), names) for i, a in enumerate(names)}
    assert pairs == sorted((i, names[j]) for i in scores for j in range(i + 1, len(names)) if scores[i][j] >= threshold)


def test_common_pieces_make_no_quadratic_join(spark):
    """Names that differ in a few digits share most pieces: they are compared in blocks, and no pair is joined to be checked."""
    form = F.format_string("%09d SUPPLIER", F.col("id"))
    nodes = spark.range(3000).select("id", form.alias("form"))
    lengths = leaders._planned(nodes, nodes, 90, 0)
    assert [tuple(r) for r in lengths.collect()] == [(18, 18, 3000, 3000, True)]
    diverse = spark.range(3000).select("id", F.substring(F.md5(F.col("id").cast("string")), 1, 18).alias("form"))
    assert [r.dense for r in leaders._planned(diverse, diverse, 90, 0).collect()] == [False]


@pytest.mark.parametrize("cutoff", [90, 60])
def test_best_others_equals_brute_force(spark, cutoff):
    names = [*variants(random.Random(cutoff), 50), "", "", "ABC DE", "DE ABC"]
    rows = [(i // 2 * 2 if i % 10 == 1 else i, n) for i, n in enumerate(names)] + [(None, names[0]), (900, None)]
    found = sorted(tuple(r) for r in mapping.best_others(spark.createDataFrame(rows, "k int, name string"), "k", "name", cutoff).collect())
    best = {}
    for k, a in rows:
        for other, b in rows:
            if None not in (k, other, a, b) and k != other:
                score = round(float(ratios([" ".join(sorted(a.split()))], [" ".join(sorted(b.split()))])[0]), 6)
                if score >= cutoff:
                    best[k] = max(best.get(k, (0, 0)), (score, -other))
    assert found == sorted((k, -other, score) for k, (score, other) in best.items())


def test_manufacturer_alias(spark):
    names = ["BORVIK INC"] * 5 + ["BORVIK CORP"] * 2 + ["HALDEXONA"] * 4 + ["HALDEXONAS PLC", "ZARNOW LABS", None, "ZARNOW LABS", "Labs Zarnow"]
    events = spark.createDataFrame([(n,) for n in names], "manufacturer_d_name string")
    found = {r["raw_name"]: r for r in mapping.manufacturer_alias(events).collect()}
    assert len(found) == 6
    assert {k: v["standardized_name"] for k, v in found.items()} == {
        "BORVIK INC": "BORVIK INC", "BORVIK CORP": "BORVIK INC", "HALDEXONA": "HALDEXONA", "HALDEXONAS PLC": "HALDEXONA",
        "ZARNOW LABS": "ZARNOW LABS", "Labs Zarnow": "ZARNOW LABS",
    }
    rules = {k: (v["normalization_rule"], v["confidence_level"], v["manual_review_flag"]) for k, v in found.items()}
    assert rules["BORVIK INC"] == ("exact", 100.0, False)
    assert rules["BORVIK CORP"] == ("suffix_removal", 95.0, False)
    assert rules["HALDEXONAS PLC"][0] == "fuzzy_match" and rules["HALDEXONAS PLC"][2]
    assert rules["HALDEXONAS PLC"][1] == pytest.approx(100 * 18 / 19)
    assert rules["Labs Zarnow"] == ("fuzzy_match", 100.0, True)


def test_all_above_misses_nothing(spark):
    names = variants(random.Random(3), 80)
    frame = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    found = {(r[0], r[1]): r[2] for r in mapping.all_above(frame, frame, "i", "name", 75).collect()}
    forms = [" ".join(sorted(n.split())) for n in names]
    for i, a in enumerate(forms):
        for j, score in enumerate(ratios([a] * len(forms), forms)):
            assert (score >= 75) == ((i, j) in found) and (score < 75 or found[i, j] == pytest.approx(score))


def test_review_flag_takes_ties(spark):
    df = spark.createDataFrame([(1, 90.0), (2, 95.0), (3, 95.0), (4, 91.0)], "i int, c double")
    flagged = mapping.flag_top_with_ties(df, F.col("i") > 0, "c", 1, "f")
    assert sorted(r["i"] for r in flagged.where("f").collect()) == [2, 3]
    assert mapping.flag_top_with_ties(df, F.col("i") > 9, "c", 1, "f").where("f").count() == 0


def test_empty_names(spark):
    events = spark.createDataFrame([(None,)], "manufacturer_d_name string")
    alias = mapping.manufacturer_alias(events)
    assert alias.count() == 0
    assert alias.columns == ["raw_name", "standardized_name", "normalization_rule", "confidence_level", "manual_review_flag"]


@pytest.mark.parametrize("cutoff", [40, 60, 75, 95])
def test_index_and_length_classes_miss_nothing(spark, cutoff):
    rng = random.Random(cutoff)
    words = ["pump", "pumps", "infusion", "system", "cardiac", "lead", "a", "of", "blood", "bloods", "é"]
    names = sorted({" ".join(rng.sample(words, rng.randrange(1, 5))) for _ in range(60)})
    texts = sorted({" ".join(rng.choice([*words, "zz", "systen", "card"]) for _ in range(rng.randrange(1, 7))) for _ in range(80)})
    dim = spark.createDataFrame([(n, n, n) for n in names], "name string, code string, place string")
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "t string")
    rows = best_match(df, "t", dim, name="name", code="code", place="place", cutoff=cutoff, name_block=7, text_block=9).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        scores = [token_set_score(set((r.t or "").split()), set(n.split())) for n in names]
        top = max(scores)
        expected = (names[scores.index(top)], top) if r.t and top >= cutoff else (None, None)
        assert (r.match_name, r.match_score) == expected


def test_ties_go_by_place_and_not_by_code(spark):
    """The order of the dimension decides between equal scores, whatever the codes are."""
    dim = spark.createDataFrame([("ZZZ", "Valve Ring", 0), ("AAA", "Ring Valve", 1), ("MMM", "Valve Ring Two", 2)], "product_code string, device_name string, row long")
    recalls = spark.createDataFrame([("R1", None, "valve Valve Ring assembly")], "recall_number string, product_code string, product_description string")
    assert mapping.map_recalls(recalls, dim, order="row").first().matched_product_code == "ZZZ"
    assert mapping.map_recalls(recalls, dim).first().matched_product_code == "AAA"


@pytest.mark.parametrize("block", [3, 1000])
def test_best_match_equals_brute_force(spark, block):
    rng = random.Random(11)
    words = ["pump", "infusion", "system", "cardiac", "lead", "wire", "imaging", "monitor", "blood", "glucose", "pumps", "leads", "a", "é"]
    names = sorted({" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(40)})
    rng.shuffle(names)
    texts = sorted({" ".join(rng.choice(words + ["xx", "sterile", "systems"]) for _ in range(rng.randrange(1, 12))) for _ in range(120)})
    dim = spark.createDataFrame([(n, f"C{i}", i) for i, n in enumerate(names)], "name string, code string, place int")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {
        r["t"]: (r["match_name"], r["match_score"])
        for r in best_match(df, "t", dim, name="name", code="code", place="place", cutoff=60, name_block=block, text_block=4 * block).collect()
    }
    for t in texts:
        scores = [token_set_score(set(t.split()), set(n.split())) for n in names]
        top = max(scores)
        expected = (names[scores.index(top)], top) if top >= 60 else (None, None)
        assert found[t] == expected


def test_map_recalls(spark):
    dim = spark.createDataFrame(
        [("QAA", "Orbital Gauze Clamp"), ("QBB", "Harbor Valve Assembly"), ("QCC", "Frame, Folding"), (None, "No code"), ("QXX", None),
         ("QDD", "Table, Tilting Height Adjustable Examination")],
        "product_code string, device_name string",
    )
    long_text = "Mabry QUARTZ Wanderer Folding Frame with Spare Hinge Kit (Edition 3.x), for wards. Use: indoors, on dry and level floors only."
    recalls = spark.createDataFrame(
        [("R1", "QAA", "anything"), ("R2", None, "Harbor Valve Assembly"), ("R3", "none", "qqq jjj vvv"), ("R4", None, None),
         ("R5", None, "Lot Number: 5"), ("R6", None, long_text), ("R7", None, "LUMO Drift, Tilting Height Adjustable Examination Table")],
        "recall_number string, product_code string, product_description string",
    )
    found = {r["recall_number"]: r[3:] for r in mapping.map_recalls(recalls, dim).collect()}
    assert found["R1"] == ("exact_product_code_match", "QAA", 100.0, True)
    assert found["R2"] == ("high_confidence_text_match", "QBB", 100.0, True)
    for unmapped in ("R3", "R4", "R5"):
        assert found[unmapped] == ("unmapped", None, None, False)
    # "Folding" is shared; against it and "Frame," there are 7 characters more of 21
    assert found["R6"] == ("low_confidence_text_match", "QCC", pytest.approx(100 * 14 / 21, abs=0.01), False)
    # four words, 37 characters, are shared; with " Table," 7 more of 81
    assert found["R7"][:2] == ("high_confidence_text_match", "QDD") and found["R7"][2] == pytest.approx(100 * 74 / 81, abs=0.01)
    assert mapping.map_recalls(recalls.limit(0), dim).count() == 0
