import random

import pytest
from pyspark.sql import functions as F

from faultline.functions import dates, json_fields, kpis, rounding, similarity, text
from faultline.functions.registry import register_functions
from faultline.functions.similarity import ratio, token_set_ratio, token_sort_ratio


def values(spark, items, make, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_company_key(spark):
    names = ["acme corp", "ACME, INC.", "TEST HOLDINGS GROUP INC", "JOHNSON AND JOHNSON", "", None, "Coca Cola Co", "A B", "Inc"]
    assert values(spark, names, text.company_key) == [
        "ACME", "ACME", "TEST", "JOHNSON AND JOHNSON", "", "", "COCA COLA", "A B", "",
    ]
    assert values(spark, ["", None, "Lindmoor LLC"], text.applicant_key) == [None, None, "LINDMOOR"]


def test_denoise_description(spark):
    cases = {
        "Orlen Tidal Rack, Item Number 4471, Model QZ-8": "Orlen Tidal Rack,",
        "NanoClave Manifold UDI: (01)10840619083929(17)220729": "NanoClave Manifold UDI:",
        "Surgical Gown Lot Number: 4496182. Non-Sterile": "Surgical Gown Non-Sterile",
        "Step Drill 2.5-3.9x124mm, 16mm stop, contra-angle": "Step Drill , stop, contra-angle",
        "Hip Stem REF (RPN): HNB5.0-38-65-P-NS-RIM REF (GPN): G05979": "Hip Stem",
        "see reference": "see",
        "Kit BG7045 v2.1": "Kit",
        "  a   b ": "a b",
    }
    assert values(spark, list(cases), text.denoise_description) == list(cases.values())
    assert values(spark, ["", None], text.denoise_description) == ["", ""]


def test_small_text_functions(spark):
    assert values(spark, [" d", "Life Threatening", "Death ", "unknown", "", None, " h"], text.outcome_code) == [
        "D", "L", "D", "unknown", "", None, "H",
    ]
    classes = ["Class I", "Class II", "is Class III.", "Class IV", "class II", "", None, "Class II"]
    assert values(spark, classes, text.recall_class) == ["I", "II", "III", "I", None, None, None, "II"]
    assert values(spark, ["ABC--", "---", "A-B"], text.without_trailing_dashes) == ["ABC", "", "A-B"]
    assert values(spark, ["-", "---", "A-", None], text.is_junk_code) == [True, True, False, False]
    assert values(spark, ["  ", None, " AN ", ""], text.label_or_unknown) == ["Unknown", "Unknown", "AN", "Unknown"]
    assert values(spark, ["Y", "N", "y", None], text.yes_no) == [True, False, None, None]


def test_dates(spark):
    found = values(spark, ["20230115", "2023-01-15", "BADDATE", None, "2023011"], dates.compact_date)
    assert [str(d) for d in found] == ["2023-01-15", "None", "None", "None", "None"]
    mixed = ["20230115", "2023-01-15", "2023-01-15T10:20:30", "01/15/2023", "Jan 15, 2023", "BADDATE", "", None, "2023"]
    found = values(spark, mixed, dates.mixed_date)
    assert [str(d) for d in found] == ["2023-01-15"] * 5 + ["None"] * 3 + ["2023-01-01"]
    shapes = ["1/15/2023", "01-15-2023", "2023.01.15", "20230115T103000", "15 January 2023", "January 15 2023", "01/15/23", "2023/1/15", "15 Jan 2023", "13/45/2023", "15 Nonsense 2023"]
    assert [str(d) for d in values(spark, shapes, dates.mixed_date)] == ["2023-01-15"] * 9 + ["None"] * 2
    assert str(values(spark, ["12/31/99"], dates.mixed_date)[0]) == "1999-12-31"


def test_filled_fields(spark):
    texts = ["[]", "[1]", "{}", '{"a": 1}', "0", "0.0", "7", "false", "true", '""', '"0"', '"{}"', "null", None]
    found = values(spark, texts, lambda c: json_fields.is_filled(F.try_parse_json(c), "$"))
    assert found == [False, True, False, True, False, False, True, False, True, False, True, True, False, False]


def test_rounding_is_that_of_the_exact_value(spark):
    rng = random.Random(5)
    numbers = [2.675, 0.35, 0.25, 0.75, 2.45, 1.005, 0.0, 99.95, 0.5, 1.5] + [rng.randrange(10**7) / rng.randrange(1, 10**5) for _ in range(300)]
    numbers += [n / 20 for n in range(200)]
    for digits in (1, 2, 4):
        found = values(spark, numbers, lambda c: rounding.round_exact(c, digits), "double")
        assert found == [round(n, digits) for n in numbers]
    found = values(spark, numbers, rounding.percent_text, "double")
    assert found == [f"{n:.1%}" for n in numbers]


@pytest.mark.parametrize(
    "kpi,pairs",
    [
        (lambda a, b: kpis.events_per_100_clearances(a, b), [(5, 10, 50.0), (5, 9, None), (0, 20, 0.0), (5, 0, None)]),
        (lambda a, b: kpis.recalls_per_100_clearances(a, b), [(1, 10, 10.0), (1, 9, None)]),
        (lambda a, b: kpis.recall_to_event_ratio(a, b), [(1, 2, 0.5), (1, 0, None)]),
        (lambda a, b: kpis.severe_recall_share(a, b), [(1, 4, 0.25), (1, 2, None)]),
        (lambda a, b: kpis.firm_share(a, b), [(1, 4, 0.25), (0, 0, None)]),
    ],
)
def test_kpis(spark, kpi, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint, expected double")
    for got, expected in df.select(kpi(F.col("a"), F.col("b")), "expected").collect():
        assert got == pytest.approx(expected) if expected is not None else got is None


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def test_lcs_against_the_table_method():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcé 𝒳") for _ in range(rng.choice([0, 1, 5, 30, 63, 64, 65, 90]))) for _ in range(240)]
    left, right = words[:120], words[120:]
    assert list(similarity.lcs_lengths(left, right, cells=17 * 64)) == [plain_lcs(a, b) for a, b in zip(left, right)]


def test_lcs_of_long_strings_carries_from_word_to_word():
    rng = random.Random(12)
    texts = ["".join(rng.choice("abé") for _ in range(n)) for n in (0, 1, 63, 64, 65, 127, 128, 129, 200, 300)] + ["a" * 130, "a" * 64, "ab" * 90]
    left, right = zip(*[(a, b) for a in texts for b in texts], strict=True)
    assert list(similarity.lcs_lengths(list(left), list(right), cells=2000)) == [plain_lcs(a, b) for a, b in zip(left, right, strict=True)]


def test_sql_functions_equal_the_columns(spark):
    assert "token_set_ratio" in register_functions(spark)
    pairs = [("a b c", "c b"), ("Acorn  tool", "tool acorn"), ("", "x"), ("", ""), (None, "x"), ("x y", None), ("abc d", "abd e"), ("é ü" * 40, "ü é" * 41)]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    columns = df.select(ratio(a, b), token_sort_ratio(a, b), token_set_ratio(a, b)).collect()
    in_sql = spark.sql("SELECT indel_ratio(a, b), token_sort_ratio(a, b), token_set_ratio(a, b) FROM {t}", t=df).collect()
    for x, y in zip(columns, in_sql, strict=True):
        assert list(x) == pytest.approx(list(y)) if None not in x else list(x) == list(y)
    for (m, n), got in zip(pairs, columns, strict=True):
        expected = None if m is None or n is None else similarity.token_set_score(set(m.split()), set(n.split()))
        assert got[2] == (expected if expected is None else pytest.approx(expected))
    rates = "recall_to_event_ratio(1, 0), firm_share(1, 4), events_per_100_clearances(5, 9), events_per_100_clearances(5, 10), severe_recall_share(1, 2, 2)"
    assert tuple(spark.sql(f"SELECT {rates}").first()) == (None, 0.25, None, 50.0, 0.5)


def test_similarity_golden_values(spark):
    df = spark.createDataFrame(
        [
            ("abcd", "abxd", 75.0, 75.0, 75.0),
            ("kitten", "sitting", 800 / 13, 800 / 13, 800 / 13),
            ("", "", 100.0, 100.0, 0.0),
            ("b a", "a  b", None, 100.0, 100.0),
            ("Frame, Folding", "Folding Frame, large", None, None, 100.0),
            ("LUMO Drift, Tilting Height Adjustable Examination Table", "Table, Tilting Height Adjustable Examination", None, None, 7400 / 81),
            (None, "a", None, None, None),
        ],
        "a string, b string, r double, sort double, st double",
    )
    a, b = F.col("a"), F.col("b")
    for got in df.select(ratio(a, b), token_sort_ratio(a, b), token_set_ratio(a, b), "r", "sort", "st", "a").collect():
        for value, expected in zip(got[:3], got[3:6]):
            if expected is not None:
                assert value == pytest.approx(expected, abs=0.02)
        if got["a"] is None:
            assert got[0] is None and got[1] is None and got[2] is None
