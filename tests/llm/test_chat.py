import random

from postflow.llm import chat
from tests.conftest import plan_of

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = {}
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *key(r))):
        turns.setdefault(r[0], []).append(r[2:])
    order = sorted(turns, key=lambda c: (c is not None, c or 0))
    kept = {}
    for c in order:
        inner = any(turns[o][: len(turns[c])] == turns[c] and len(turns[o]) > len(turns[c]) for o in turns)
        if not inner:
            kept.setdefault(tuple(turns[c]), []).append(c)
    # Of equal ones the smallest id stays; a null id only where there is no other.
    stay = {min((i for i in ids if i is not None), default=None) for ids in kept.values()}
    out = {}
    for c in turns:
        into = [s for s in stay if turns[s][: len(turns[c])] == turns[c] and s is not None]
        out[c] = (len(turns[c]), c in stay, c if c in stay else min(into, default=None))
    return out, turns, stay


def cases(seed):
    rng = random.Random(seed)
    rows = []
    logs = [[(rng.choice(["user", "bot", None]), rng.choice(["hi", "<|im_end|> x", None, ""])) for _ in range(8)] for _ in range(4)]
    for c in range(30):
        log = rng.choice(logs)[: rng.randint(1, 8)]
        start = rng.randint(0, 3)
        rows += [(c, start + 3 * i, *turn) for i, turn in enumerate(log)]
    rows += [(None, 0, "user", "hi"), (None, None, "user", "hi"), (77, 0, "a", "b"), (77, 0, "a", "b"), (78, 5, "a", "b")]
    return rows


def test_against_brute_force(spark, monkeypatch):
    for seed, run in ((1, 256), (2, 2)):
        monkeypatch.setattr(chat, "RUN_TURNS", run)
        rows = cases(seed)
        verdict, texts = chat.collapse(spark.createDataFrame(rows, SCHEMA))
        expected, turns, stay = brute(rows)
        assert {r["conv_id"]: (r["n_turns"], r["kept"], r["kept_in"]) for r in verdict.collect()} == expected
        whole = {}
        for r in sorted(texts.collect(), key=lambda r: r["run"]):
            assert r["n_turns"] <= run
            whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["text"]
        safe = lambda s: (s or "").replace("<|im_end|>", "<| im_end |>")
        assert whole == {
            c: "".join(f"<|im_start|>{safe(a)}\n{safe(b)}<|im_end|>\n" for a, b in turns[c]) for c in stay
        }


def test_extra_columns_and_empty_tables(spark):
    verdict, texts = chat.collapse(spark.createDataFrame([], SCHEMA + ", n long, run long, prefix long"))
    assert verdict.count() == texts.count() == 0
    verdict, texts = chat.collapse(spark.createDataFrame([(1, 0, "u", "x", 5)], SCHEMA + ", run long"))
    assert verdict.first()["kept"] and texts.first()["text"] == "<|im_start|>u\nx<|im_end|>\n"


def test_runs_spread_a_long_conversation(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(1000)]
    turns = chat.numbered(spark.createDataFrame(rows, SCHEMA))
    assert turns.select("run").distinct().count() == 4
    assert sorted(r["n"] for r in turns.collect()) == list(range(1, 1001))
    assert "conv_id" in plan_of(turns) and "run" in plan_of(turns)
