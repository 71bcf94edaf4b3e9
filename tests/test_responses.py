from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evalspark.functions import responses as R
from evalspark.operators import responses as P
from evalspark.operators import scoring

PIECES = [
    "<think>", "</think>", "Thinking Process:", "```python\n", "```\n", "```", "```js\n", "Here is", "My solution",
    "def f():", "return 1", "\n", "\n\n", " ", "\t", " ", " ", "\u0085", "\x1c", "\r", "é", "x", "$1", "\\", "日本",
]


PY, JS, END = "```python\n", "```js\n", "\n```"
# response, prompt, what is left of it, its code, the program
CASES = [
    ("", "p", "", "", "p"),
    ("  \n x", "", "x", "", "x"),
    ("<think>a\nb</think>\n\ny", "", "y", "", "y"),
    ("<think>a</think>b<think>c</think>d", "", "bd", "", "bd"),
    ("<think>never closed", "", "<think>never closed", "", "<think>never closed"),
    ("Thinking Process: 1. 2. Here is z", "", "Here is z", "", "Here is z"),
    ("Thinking Process: all of it", "p", "", "", "p"),
    ("x Thinking Process: stays", "", "x Thinking Process: stays", "", "x Thinking Process: stays"),
    (f"Thinking Process: a {PY}return 1{END}", "p ", f"{PY}return 1{END}", "return 1", "p return 1"),
    (f"a {PY}b = 1{END} c {PY}c = 2{END} d", "p", f"a {PY}b = 1{END} c {PY}c = 2{END} d", "c = 2", "pa "),
    (f"a {JS}return 1;{END}", "", f"a {JS}return 1;{END}", "return 1;", "return 1;"),
    (f"{JS}return 1;{END}{PY}x = 1{END}", "", f"{JS}return 1;{END}{PY}x = 1{END}", "x = 1", ""),
    (f"{PY}def f():\n    return 2{END}", "def f():", f"{PY}def f():\n    return 2{END}", "def f():\n    return 2", "def f():\n    return 2"),
    (f"{PY}def f():\n    return 2{END}", "def f():  \n", f"{PY}def f():\n    return 2{END}", "def f():\n    return 2", "def f():\n    return 2"),
    (f"{PY}def f():\n    return 2{END}", "def g():\n", f"{PY}def f():\n    return 2{END}", "def f():\n    return 2", "def g():\ndef f():\n    return 2"),
    (f"{PY}open block", "p", f"{PY}open block", "", "p"),
    (f"{PY}{END}", "p", f"{PY}{END}", "", "p"),
    ("é 日本 $1 \\", "", "é 日本 $1 \\", "", "é 日本 $1 \\"),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(CASES)], "i int, response string, prompt string")
    for r in P.completion_predictions(df).collect():
        assert (r["cleaned"], r["code"], r["prediction"]) == CASES[r["i"]][2:], CASES[r["i"]]


def test_properties_of_random_texts(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t, rng.choice(["", "x", "def f():\n  "])) for t in texts], "response string, prompt string")
    wrapped = df.withColumn("last", F.concat("response", F.lit("\n```\n```python\nlast = 1\n```")))
    done = P.completion_predictions(df.withColumn("again", R.strip_think(R.strip_think(F.col("response")))))
    for r in done.collect():
        assert not re.search("<think>.*</think>", r["cleaned"], re.S) or "<think><think>" in r["response"] or r["cleaned"] != r["response"]
        assert not r["cleaned"][:1].isspace()
        assert r["code"] in r["cleaned"] and "```" not in r["code"]
        assert r["prediction"].startswith(r["prompt"]) or r["prompt"].rstrip() in r["code"]
    for r in wrapped.select(R.extract_code(F.col("last")).alias("code")).collect():
        assert r["code"].endswith("last = 1") or "```" not in r["code"]


def test_order_of_the_two_patterns(spark):
    df = spark.createDataFrame([("<think>a</think>\nThinking Process: b",), ("<think>a</think>Thinking Process: bHere is c",), ("<think>open",)], "t string")
    got = [r[0] for r in df.select(R.strip_think(F.col("t"))).collect()]
    assert got == ["Thinking Process: b", "Here is c", "<think>open"]


def test_unpaired(spark):
    docs = spark.createDataFrame([(1, "p"), (2, "q")], "doc_id int, prompt string")
    answers = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "doc_id int, response string")
    assert P.pair_responses(answers, docs).count() == 2
    sides = {(r["doc_id"], r["side"]) for r in P.unpaired(answers, docs).collect()}
    assert sides == {(3, "response without doc"), (2, "doc without response")}


def test_inputs_that_must_line_up(spark):
    docs = spark.createDataFrame([(1, "p"), (2, "q")], "doc_id int, prompt string")
    answers = spark.createDataFrame([(1, "a"), (1, "b")], "doc_id int, response string")
    assert P.pair_all(answers, docs, unanswered="skip").count() == 2
    assert P.pair_all(answers, docs.where("doc_id = 1")).count() == 2
    with pytest.raises(Exception, match="problem without response: 2"):
        P.pair_all(answers, docs).collect()
    with pytest.raises(Exception, match="response without problem: 1"):
        P.pair_all(answers, docs.where("doc_id = 2"), unanswered="skip").collect()


def test_prompts(spark):
    df = spark.createDataFrame([("add", ["t0", "t1", "t2"], "T", "add")], "text string, test_list array<string>, test string, entry_point string")
    row = P.render_prompts(df, P.TASK_PROMPT, P.TASK_TARGET).first()
    assert row["rendered_prompt"].endswith("here is your task:\nadd\nYour code should pass these tests:\nt0\nt1\nt2")
    assert row["rendered_target"] == "t0\nt1\nt2"
    row = P.render_prompts(df, P.COMPLETION_PROMPT, P.COMPLETION_TARGET, prompt="text").first()
    assert row["rendered_prompt"].endswith("```python\nadd\n```\n") and row["rendered_target"] == "T\ncheck(add)"


def test_first_n(spark):
    df = spark.range(100).withColumn("task", F.when(F.col("id") < 90, "hot").otherwise("cold"))
    assert [r["id"] for r in P.first_n(df, 3, ["id"]).collect()] == [0, 1, 2]
    got = {(r["task"], r["id"]) for r in P.first_n(df, 2, ["id"], ["task"]).collect()}
    assert got == {("hot", 0), ("hot", 1), ("cold", 90), ("cold", 91)}


def chance(n, c, k):
    draws = list(itertools.combinations([True] * c + [False] * (n - c), k))
    return sum(any(d) for d in draws) / len(draws)


def test_pass_at_k_is_the_share_of_draws_with_a_hit(spark):
    cases = [(n, c) for n in range(3, 8) for c in range(n + 1)]
    samples = [(f"{n}-{c}", i < c) for n, c in cases for i in range(n)]
    outcomes = spark.createDataFrame([("t", p, ok) for p, ok in samples], "task string, problem string, correct boolean")
    got = scoring.pass_at_k(outcomes, [1, 2, 3], ["task"]).first()
    for k in (1, 2, 3):
        want = sum(chance(n, c, k) for n, c in cases) / len(cases)
        assert got[f"pass_at_{k}"] == pytest.approx(want, abs=1e-12)
    assert got["n_problems"] == len(cases)


def test_too_few_samples_give_no_score(spark):
    outcomes = spark.createDataFrame([("t", "a", True), ("t", "b", True), ("t", "b", False)], "task string, problem string, correct boolean")
    got = scoring.pass_at_k(outcomes, [1, 2], ["task"])
    assert got.first()["pass_at_1"] == 0.75 and got.first()["pass_at_2"] is None
    rows = scoring.scores_to_results(got, "task", [1, 2]).collect()
    assert [tuple(r) for r in rows] == [("t", "pass@1,none", 0.75)]


def test_one_row_for_each_response(spark):
    responses = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (9, "e"), (None, "f")], "doc_id int, response string")
    docs = spark.createDataFrame([(1, "p1"), (2, "p2"), (2, "p2"), (3, "p3"), (4, "p4")], "doc_id int, prompt string")
    paired, rejects = P.pair_or_reject(responses, docs)
    assert sorted((r["response"], r["prompt"]) for r in paired.collect()) == [("a", "p1"), ("b", "p1"), ("d", "p3")]
    assert sorted((r["response"], r["side"]) for r in rejects.collect()) == [("c", P.DOC_REPEATED), ("e", P.RESPONSE_ALONE), ("f", P.RESPONSE_ALONE)]
    found = {(r["doc_id"], r["n_responses"], r["n_docs"], r["side"]) for r in P.parity(responses, docs).collect()}
    assert found == {(None, 1, 0, P.NO_KEY), (2, 1, 2, P.DOC_REPEATED), (4, 0, 1, P.DOC_ALONE), (9, 1, 0, P.RESPONSE_ALONE)}
    one = {(r["doc_id"], r["side"]) for r in P.parity(responses, docs, per_doc=1).collect()}
    assert one == {(None, P.NO_KEY), (1, P.TOO_MANY), (2, P.DOC_REPEATED), (4, P.DOC_ALONE), (9, P.RESPONSE_ALONE)}
    assert {r["side"] for r in P.parity(responses.where("doc_id = 3"), docs.where("doc_id = 3"), per_doc=2).collect()} == {P.TOO_FEW}
    with pytest.raises(PySparkException, match="listed more than once: 2"):
        P.pair_all(responses.where("doc_id = 2"), docs.where("doc_id = 2")).collect()
    assert P.pair_all(responses.where("doc_id IN (1, 3)"), docs.where("doc_id IN (1, 3)")).count() == 3
