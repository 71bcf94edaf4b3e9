from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evalspark.llm import chat

SCHEMA = "conv_id long, message_id string, seq long, kind string, role string, text string"
NASTY = st.text(alphabet="<\\|>ni_start\n aé\U0001f600", max_size=30)


def formatted(spark, rows):
    done = chat.format_log(spark.createDataFrame(rows, SCHEMA)).withColumns(
        {"turns": chat.read_back(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))}
    )
    return {r.conv_id: r for r in done.collect()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\\n|b", "<|im_end|>", "\\\n"]), NASTY), min_size=1, max_size=6), min_size=1, max_size=20))
def test_every_text_reads_back(spark, conversations):
    rows = [(c, f"m{t}", t, "message", role, text) for c, turns in enumerate(conversations) for t, (role, text) in enumerate(turns)]
    got = formatted(spark, rows)
    for c, turns in enumerate(conversations):
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].loss == "".join(text for role, text in turns if role == "assistant")
        assert len(re.findall(r"<\|im_start\|>", got[c].formatted)) == len(turns) == len(re.findall(r"<\|im_end\|>\n", got[c].formatted))


def test_events_fold(spark):
    rows = [
        (1, "a", 0, "message", "user", "first"),
        (1, "b", 1, "message", "assistant", "old "),
        (1, "b", 2, "delta", None, "tail"),
        (1, "a", 3, "edit", None, "second"),
        (1, "b", 4, "regenerate", None, "not shown"),
        (1, "b", 6, "delta", None, "er"),
        (1, "b", 5, "delta", None, "new"),
        (1, "c", 7, "message", "user", "gone"),
        (1, "c", 8, "delete", None, None),
        (1, "d", 9, "delta", "assistant", "only deltas"),
        (2, "a", 0, "message", "user", "x"),
        (2, "a", 1, "delete", None, None),
        (2, "a", 2, "edit", None, "back"),
        (3, "a", 0, "message", "user", "x"),
        (3, "a", 1, "delete", None, None),
    ]
    got = formatted(spark, rows)
    assert [tuple(t) for t in got[1].turns] == [("user", "second"), ("assistant", "newer"), ("assistant", "only deltas")]
    assert [tuple(t) for t in got[2].turns] == [("user", "back")]
    assert 3 not in got


def test_nulls_ties_and_empty_logs(spark):
    rows = [(None, None, None, "message", None, None), (None, "x", None, "message", "user", "b"), (None, "y", None, "message", "user", "b"), (5, "a", 1, "message", "assistant", "z" * 1_000_000)]
    got = formatted(spark, rows)
    assert [tuple(t) for t in got[None].turns] == [("", ""), ("user", "b"), ("user", "b")]
    assert len(got[5].loss) == 1_000_000
    assert formatted(spark, []) == {}


def test_unknown_kinds_fail(spark):
    with pytest.raises(Exception, match="unknown kind"):
        formatted(spark, [(1, "a", 0, "scream", "user", "x")])
