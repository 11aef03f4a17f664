"""Toxicity, license scan, URL filter and chat formatting."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import chat_template, license_scan, toxicity, url_filter
from faultline.llm.common import table


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def toxic_rows(n=1200):
    """Insults alone are fine, groups alone are fine; together they are toxic."""
    rng = random.Random(9)
    rows = []
    for i in range(n):
        words = [f"word{rng.randrange(200)}" for _ in range(12)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["grubnak"] * insult + ["zorblings"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    return rows


def test_machine_learns_a_pair_that_no_additive_weights_can(documents, spark):
    rows = toxic_rows()
    docs = documents([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    truth = {i: y for i, _, y in rows}
    found = toxicity.toxicity_scores(docs, labels).collect()
    assert all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.3) for r in found)
    judged = [r for r in found if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in judged) >= 0.95 * len(judged)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if not r.predicted}


def test_machine_scores_the_plain_double_sum():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(np.arange(30), -0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    for size in (0, 1, 2, 17):
        at = np.sort(rng.choice(30, size, replace=False))
        z = machine.bias + sum(machine.weights[i] for i in at)
        z += sum(float(machine.factors[i] @ machine.factors[j]) for i in at for j in at if i < j)
        assert machine.score(at) == pytest.approx(1 / (1 + np.exp(-z)))


def test_rows_of_one_id_do_not_exceed_the_training_bound(documents, spark, monkeypatch):
    """An id that is repeated gives one training row, so the driver sees no more than the bound."""
    seen = []
    plain = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda rows, *a, **k: seen.append(len(rows)) or plain(rows, *a, **k))
    ids = [i for i in range(20) if not held(i)][:3]
    docs = documents([(ids[0], f"w{k} bad") for k in range(500)] + [(ids[1], "good"), (ids[2], "fine")])
    labels = spark.createDataFrame([(ids[0], 1), (ids[1], 0), (ids[2], 0)], "doc_id long, toxic int")
    toxicity.train(docs, labels, rows=1)
    toxicity.train(docs, labels, rows=10)
    assert seen == [1, 3]


def test_labels_of_held_out_rows_change_nothing(documents, spark):
    rows = toxic_rows(150)
    docs = documents([(i, t) for i, t, _ in rows])
    schema = "doc_id long, toxic int"
    true = spark.createDataFrame([(i, y) for i, _, y in rows], schema)
    turned = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, _, y in rows], schema)
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.toxicity_scores(docs, x).collect()) for x in (true, turned))
    assert a == b


def test_toxicity_edge_cases(documents, spark):
    docs = documents([(1, None), (2, ""), (3, "w " * 100_000), (3, "w"), (None, "w"), (1, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity_scores(docs, none).collect()] == [pytest.approx(0.0, abs=1e-12)] * 6
    assert toxicity.drop_toxic(docs, none).count() == 6
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(docs, odd).count() == 6
    assert toxicity.toxicity_scores(documents([]), odd).count() == 0


def test_held_out_accuracy_on_the_benchmark_table(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    scores = toxicity.toxicity_scores(table(spark, folder, "documents"), labels).join(labels, "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r.n for r in scores.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert counts[1, 1] >= 0.85 * (counts[1, 1] + counts.get((1, 0), 0)) and counts.get((0, 1), 0) <= 0.01 * counts[0, 0]


def brute_licenses(text):
    words = re.findall(license_scan.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for label, phrase in license_scan.PHRASES:
        phrase = phrase.split()
        for k in range(len(words) - len(phrase) + 1):
            if words[k : k + len(phrase)] == phrase:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


GRANT = license_scan.TEMPLATES[1][1]
LICENSE_ROWS = [
    (1, "Released under the MIT License."),
    (2, "under the MIT-License; Apache License, Version 2.0 and apache license version 2 CC BY-NC 4.0 cc by nc"),
    (3, None),
    (4, ""),
    (5, "under the mit licenses. apache license version 22. under the the mit license"),
    (6, "x " * 50_000 + "UNDER THE MIT LICENSE"),
    (7, "intro " + GRANT.replace(" copy of", " complete copy of").replace("free of charge ", "")),
    (7, "cc by nc"),
    (1, "Released under the MIT License."),
    (None, "CC BY NC"),
    (8, "é under the mit licenseé under thé mit license"),
    (9, "K\u212ay under the mit license \u212a \u0130x I"),
]


def test_license_scan_equals_brute_force(documents):
    found = license_scan.license_scan(documents(LICENSE_ROWS)).collect()
    base = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=repr)
    assert base == sorted(((i, *brute_licenses(t)) for i, t in LICENSE_ROWS), key=repr)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in found if r.base_labels)
    assert all(r.labels == "" and r.score < 1 for r in found if r.doc_id in (3, 4))


def test_a_changed_license_text_is_one_span_over_neighbouring_diagonals(documents):
    found = license_scan.license_scan(documents(LICENSE_ROWS)).where("doc_id = 7 AND n_words > 10").first()
    assert found.labels == "mit" and found.base_labels == "" and 0.6 < found.score < 1


def test_words_put_into_a_template_do_not_split_its_span(documents):
    """Also where a phrase that the template repeats puts a foreign diagonal between the two true ones."""
    rows, expect = [], {}
    for tid, (label, text) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        for at in range(1, len(words)) if len(words) > 20 else ():
            rows.append((100 * tid + at, "before it " + " ".join([*words[:at], "zzz", *words[at:]]) + " after it"))
            expect[100 * tid + at] = label
    alone = tuple(t for t in license_scan.TEMPLATES if len(t[1].split()) > 20)
    found = license_scan.license_scan(documents(rows), (), alone).collect()
    assert {r.doc_id: r.labels for r in found} == expect
    # at least all words whose gram lies on one side of the new word are seen
    assert min(r.score for r in found) > 0.85


def test_part_of_a_template_gives_no_label(documents):
    rows = [(1, "he walks in the sun under the mit and says"), (2, "free of charge to any person " * 40), (3, " ".join(GRANT.split()[:14]))]
    found = {r.doc_id: r for r in license_scan.license_scan(documents(rows)).collect()}
    assert [found[k].labels for k in (1, 2, 3)] == ["", "", ""]
    assert found[3].score == 14 / len(GRANT.split())


def test_license_scan_of_no_rows_is_native(documents):
    found = license_scan.license_scan(documents([]))
    assert found.count() == 0
    plan = license_scan.license_scan(documents(LICENSE_ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


URLS = [
    (1, "http://A.Example.NET/en/5?x=1", "a.example.net", "/en/5", "example.net/en/", "allow"),
    (2, "https://net/x", "net", "/x", "net/", "block"),
    (3, "http://notnet/x", "notnet", "/x", None, None),
    (4, "http://example.com/de/1#/", "example.com", "/de/1", "example.com/de/", "block"),
    (5, "http://my.org/fr/", "my.org", "/fr/", "org/fr/", "allow"),
    (6, "http://my.net", "my.net", "", None, None),
    (7, "no scheme.net/en/", "", "", None, None),
    (8, None, "", "", None, None),
    (9, "", "", "", None, None),
    (10, "a://b.net?u=http://c.org/fr/", "b.net", "", None, None),
    (11, "http://x.net/" + "p/" * 20_000, "x.net", "/" + "p/" * 20_000, "net/", "block"),
    (1, "http://A.Example.NET/en/5?x=1", "a.example.net", "/en/5", "example.net/en/", "allow"),
    (None, "http://\nx.net/a\nb?c", "\nx.net", "/a\nb", "net/", "block"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "", "x", 1.0) for i, u, *_ in URLS], "page_id long, url string, html string, host string, score double")
    found = url_filter.url_filter(pages).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in found), key=repr) == sorted(((i, h, p, r) for i, _, h, p, r, _ in URLS), key=repr)
    wanted = {(i, v) for i, *_, v in URLS if v}
    assert wanted <= {(r.page_id, r.verdict) for r in found} and {r.verdict for r in found} <= {"block", "allow"}
    assert url_filter.url_filter(pages.limit(0)).count() == 0


def test_url_trees_learn_from_labelled_urls(spark):
    """Rules label two thirds of the hosts; long digit paths are blocked, and the trees carry that over to the rest."""
    rng = random.Random(1)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.5
        name = "".join(rng.choice("abcdefgh") for _ in range(6))
        path = "".join(rng.choice("0123456789") for _ in range(30)) if bad else "".join(rng.choice("klmno") for _ in range(8))
        top = ("bad.test" if bad else "good.test") if i % 3 else f"other{i}.test"
        rows.append((i, f"http://{name}.{top}/{path}", bad))
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    found = {r.page_id: r for r in url_filter.url_filter(pages, (("block", "bad.test", "/"), ("allow", "good.test", "/"))).collect()}
    rest = [(i, bad) for i, _, bad in rows if not i % 3]
    assert all(found[i].rule is None and 0 <= found[i].score <= 1 for i, _ in rest)
    assert sum((found[i].verdict == "block") == bad for i, bad in rest) > 0.95 * len(rest)


def test_url_entropy_and_long_urls(spark):
    urls = ["", "a", "aab", "http://x/" + "é1" * 50, "".join(map(chr, range(0x4E00, 0x4E00 + 3000))) * 3]
    rows = spark.createDataFrame([(u, "", "") for u in urls], "url string, host string, path string")
    for r in url_filter.with_features(rows).select("url", "entropy").collect():
        shares = [n / len(r.url) for n in Counter(r.url).values()]
        assert r.entropy == pytest.approx(-sum(p * np.log2(p) for p in shares), abs=1e-9)


def test_hosts_held_out_are_judged_by_what_other_hosts_show(spark):
    """Digit paths are blocked on every host; no host of the judged fold is in the training rows."""
    rng = random.Random(4)
    rows = []
    for k in range(800):
        host, bad = f"h{rng.randrange(60)}.site{rng.randrange(9)}.test", rng.random() < 0.5
        rows.append((k, f"http://{host}/{'num' if bad else 'abc'}/" + "".join(rng.choice("0123456789" if bad else "klmnop") for _ in range(20))))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    n, share = url_filter.held_out_accuracy(pages, (("block", "test", "/num/"), ("allow", "test", "/abc/")))
    assert n > 50 and share > 0.95


def test_pages_are_scanned_twice_at_most(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    trees = url_filter.url_filter(pages)
    assert trees._jdf.queryExecution().optimizedPlan().toString().count("Relation [page_id") <= 1
    sample = url_filter.labelled_urls(pages)
    assert "Relation [page_id" not in sample._jdf.queryExecution().optimizedPlan().toString()  # stored


def test_held_out_hosts_of_the_benchmark_table(spark):
    """Its rules go by the path's language, which lexical features hardly show: the trees beat the commoner verdict, not by much."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    n, share = url_filter.held_out_accuracy(pages)
    blocked = url_filter.labelled_urls(pages).where("fold = 0").agg(F.avg("label")).first()[0]
    print("held-out hosts:", n, share, "always one verdict:", max(blocked, 1 - blocked))
    assert n > 100 and share >= max(blocked, 1 - blocked)


def test_url_filter_is_native(spark):
    pages = spark.createDataFrame([(i, u) for i, u, *_ in URLS], "page_id long, url string")
    plan = url_filter.url_filter(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


TURNS = [
    (1, 1, "assistant", "hi <|end|> [x] \\l \\\\"), (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 2, "user", None), (1, 3, "assistant", "ünd\n<|user|>\n"),
    (2, 0, None, ""), (2, None, "assistant", "last"), (2, 5, "assistant", "five"), (2, 5, "assistant", "five"), (2, 5, "assistant", "again"),
    (3, 0, "user|>\n<x>", "long " * 100_000), (None, 0, "assistant", "nobody"), (None, 1, "user", "else"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, piece string")
    found = {r.conv_id: r for r in chat_template.read_back(chat_template.format_conversations(rows)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((t[1] if t[1] is not None else 10**9, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = found[conv]
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(len(chat_template.escape(a)) + len(chat_template.escape(b)) + 13 for _, a, b in own)
    assert len(found) == 4 and chat_template.format_conversations(rows.limit(0)).count() == 0


def render(template, messages):
    return "".join(f"[{t}]" if masked else t for t, masked in chat_template.compile_template(template)(messages))


@pytest.mark.parametrize(
    ("template", "expected"),
    [
        ("a{# note #}b{{ 'c' + \"d\" | upper }}{{ 1 + 2 }}", "abcD3"),
        ("{% for m in messages %}{{ loop.index }}{{ m['role'] }}{% if loop.last %}.{% elif loop.first %};{% else %},{% endif %}{% endfor %}", "1user;2bot,3user."),
        ("{% for m in messages %}{% if m.role != 'user' and not (m.text == '') %}{% generation %}{{ m.text }}{% endgeneration %}{% endif %}{% endfor %}", "[ B ]"),
        ("{% for m in messages %}{{ m.text | trim | lower }}{{ m.missing }}{% endfor %}", "abc"),
        ("{% if true or x %}y{% else %}n{% endif %}{% if 'a' == 'b' %}{{ nothing }}{% endif %}", "y"),
    ],
)
def test_templates(template, expected):
    messages = [{"role": "user", "text": "A"}, {"role": "bot", "text": " B "}, {"role": "user", "text": "C"}]
    assert render(template, messages) == expected


def test_constants_are_folded():
    assert chat_template.fold(chat_template.parse("a{{ 'b' + 'c' | upper }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{% if false %}e{% endif %}")) == (
        chat_template.Emit(chat_template.Const("abCd")),
    )


@pytest.mark.parametrize("template", ["{{ m.__class__() }}", "{{ x | eval }}", "{% include 'x' %}", "{% for m in messages %}", "{{ 1 ~ 2 }}", "{% endif %}"])
def test_the_language_is_closed(template):
    with pytest.raises(chat_template.TemplateError):
        chat_template.compile_template(template)


def test_values_have_no_python_attributes():
    for template in ("{{ messages.append }}", "{{ 'a'.upper }}", "{{ 1 + 'a' }}", "{{ unknown }}", "{% for c in 'abc' %}{% endfor %}"):
        with pytest.raises(chat_template.TemplateError):
            render(template, [{"role": "a"}])


def test_unknown_rows_score_by_bias():
    machine = toxicity.fit([np.array([0]), np.array([], int)], np.array([1.0, 0.0]), np.array([5]))
    assert machine.score(np.array([0])) > machine.score(np.array([], int))
