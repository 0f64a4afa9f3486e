import random

from postflow.llm import licenses as L
from tests.llm.helpers import docs, empty, odd, terms


def brute(text):
    w = terms(text)
    places = sorted(
        (i, label)
        for phrase, label in L.PHRASES.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    )
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_phrases_against_brute_force(spark):
    rng = random.Random(2)
    words = ["MIT", "License", "license", "apache", "General", "public", "gnu", "x", "é"]
    rows = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(150)]
    rows += [(500, "mit license"), (501, None)]
    got = L.license_report(docs(spark, rows)).collect()
    for r in got:
        own = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert own == brute(dict(rows)[r["doc_id"]]), r["doc_id"]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])
    assert len(got) == len(rows)


def test_edited_notices_are_found(spark):
    notice = L.TEMPLATES["bsd"][0]
    edited = notice.replace("binary forms", "compiled forms").replace("that the following", "that all the following")
    cut = notice[: len(notice) // 3]
    rows = [(1, f"before {notice} after"), (2, f"some words {edited}"), (3, cut), (4, "permitted provided"), (5, f"{notice} x {notice}")]
    found = {r["doc_id"]: r for r in L.scan(docs(spark, rows)).collect()}
    spans = {i: [(s["label"], s["low"], s["high"]) for s in r["spans"]] for i, r in found.items()}
    n = len(terms(notice))
    assert spans[1] == [("bsd", 1, 1 + n)]
    assert [s[0] for s in spans[2]] == ["bsd"] and spans[2][0][1:] == (2, 2 + n + 1)
    assert spans[3] == spans[4] == [] and [s[0] for s in spans[5]] == ["bsd", "bsd"]
    assert found[2]["spans"][0]["share"] < 1


def test_odd_documents(spark):
    given = odd(spark)
    assert L.license_report(given).count() == given.count()
    assert L.license_report(empty(spark)).count() == 0
    assert L.scan(given, templates={"none": ("a",)}).filter("size(spans) > 0").isEmpty()


def test_the_path_is_native(spark):
    plan = L.scan(docs(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
