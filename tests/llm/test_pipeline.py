"""The whole pipeline, and the registered queries."""

import pytest

import corpus_pipeline as P
from checks.compare import connect, differences
from postflow.llm.oracles import ORACLES
from postflow.llm.queries import QUERIES, table
from tests.conftest import SF_DIR
from tests.llm.helpers import empty, odd, terms, WORD
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_line_dedup import folded
from tests.llm.test_minhash import classes


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == []


# These have rows of their own: conversations, words, and orders of filters.
OTHER_ROWS = {"op6_chat_format", "op11_spelling_variants", "op13_filter_audit"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_ROWS))
def test_a_row_for_each_document(spark, name):
    expected = sorted(r["doc_id"] for r in table(spark, SF_DIR, "documents").collect())
    assert sorted(r["doc_id"] for r in QUERIES[name](spark, SF_DIR).collect()) == expected


def test_stages(spark):
    names = [name for name, _ in P.STAGES]
    assert names == ["quality rules", "line dedup", "near-duplicates", "decontamination", "mix"]
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        docs = P.keep_table(stage(spark, docs, SF_DIR), "test-stage")
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and docs.count() == len(now) and set(now) <= set(rows)
        if name == "quality rules":
            verdict = {r["doc_id"]: r["kept"] for r in QUERIES["op9_quality_rules"](spark, SF_DIR).collect()}
            assert now == {i: t for i, t in rows.items() if verdict[i]}
        if name == "line dedup":
            seen = set()
            for i in sorted(now):
                for line in now[i].split("\n"):
                    if len(line) >= 20 and len(folded(line)) >= 20:
                        assert folded(line) not in seen
                        seen.add(folded(line))
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "near-duplicates":
            assert set(now) == set(classes(sorted(rows.items())).values())
        if name == "decontamination":
            items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
            hit = {r[0] for r in leaks(sorted(rows.items()), items, 10) if r[2]}
            assert set(now) == set(rows) - hit
        rows = now
    blocks = P.mix(spark, docs, SF_DIR).collect()
    taken = sum(b["n_words"] for b in blocks)
    total = sum(len(WORD.findall(t)) for t in rows.values())
    assert abs(taken - 1.5 * total) < 20 * 128
    assert {i for b in blocks for i in b["doc_ids"]} <= set(rows)
    assert all(terms(b["text"]) is not None and len(b["text"].split(" ")) == b["n_words"] for b in blocks)


@pytest.mark.parametrize("make", [empty, odd])
def test_stages_take_odd_tables(spark, make):
    docs = make(spark)
    for _, stage in P.STAGES:
        last = stage(spark, docs, SF_DIR)
        if stage is not P.mix:
            assert last.columns == docs.columns
        last.count()
