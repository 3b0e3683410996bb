from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indexpanel.llm import prefix_targets as p

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["a", "\\", "<|", "|>", "<|im_end|>", "<|im_start|>", "\n", "<\\|", "🎉", " ", "assistant", "$1"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


def order(rows):
    null = lambda v: (v is not None, v if v is not None else 0)
    return sorted(((r[1], r[2] or "", r[3] or "") for r in rows), key=lambda r: (null(r[0]), r[1], r[2]))


def check(spark, rows):
    got = {r.conv_id: r for r in p.read_back(p.segments(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        turns = order([x for x in rows if x[0] == c])
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in turns]
        assert list(r.replies) == [t[2] for t in turns if t[1] == "assistant"]


@settings(max_examples=8, deadline=None)
@given(turns=st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["user", "assistant", "system", "a\nb\\", None]), TEXT | st.none()),
                      min_size=1, max_size=30), cut=st.integers(1, 4))
def test_round_trip(spark, turns, cut):
    check(spark, [(i % cut, t, role, text) for i, (t, role, text) in enumerate(turns)])


def test_nulls_ties_and_repeats(spark):
    check(spark, [(None, None, None, None), (None, 1, "assistant", "x"), (1, 0, "user", "u"), (1, 0, "user", "u"), (2, 5, "user", "alone"),
                  (3, 0, "assistant", ""), (3, 1, "assistant", None), (4, 0, "user", "x" * 100_000)])


def test_examples_have_all_preceding_turns_and_one_target(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "<|im_end|>"), (1, 3, "user", "v"), (1, 4, "assistant", "b")]
    parts = p.segments(spark.createDataFrame(rows, SCHEMA))
    got = p.examples(parts).orderBy("example").collect()
    assert [r.text[r.loss_start:r.loss_end] for r in got] == ["<\\|im_end|>", "b"]
    first = "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n<\\|im_end|><|im_end|>\n"
    assert got[0].text == first
    assert got[1].text == first + "<|im_start|>user\nv<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"


def test_read_back_takes_all_from_the_examples_written_out(spark):
    rows = [(1, 0, "user", "u"), (1, 1, "assistant", "one"), (1, 2, "user", "v"), (1, 3, "assistant", "two"), (1, 4, "user", "w"),
            (2, 0, "user", "alone")]
    parts = p.segments(spark.createDataFrame(rows, SCHEMA))
    made = p.examples(parts).collect()
    tails = parts.where("loss_end is null").collect()
    right = {r.conv_id: r for r in p.read_back(parts).collect()}
    for c in (1, 2):
        assert right[c].formatted_chars == sum(len(r.text) for r in made if r.conv_id == c) + sum(
            len(r.segment) for r in tails if r.conv_id == c)
    # Places that are off by one in the examples must show in the replies, and no count is taken from them.
    off = {r.conv_id: r for r in p.read_back(parts.withColumn("context_chars", F.col("context_chars") + 1)).collect()}
    assert list(right[1].replies) == ["one", "two"] and list(off[1].replies) == ["ne<", "wo<"]
    assert off[1].formatted_chars == right[1].formatted_chars and off[1].turns == right[1].turns


def test_long_conversation_stays_linear(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(3000)]
    parts = p.segments(spark.createDataFrame(rows, SCHEMA))
    assert sum(len(r.segment) for r in parts.collect()) < 200_000 and parts.count() == 1500


def test_empty_table_and_native_plan(spark):
    parts = p.segments(spark.createDataFrame([], SCHEMA))
    assert p.read_back(parts).count() == 0
    plan = p.read_back(parts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
