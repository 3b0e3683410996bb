from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indexpanel.llm import quality_rules as q

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_of_odd_documents(odd_docs):
    rows = q.judged(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        expected = counts(r.row.text)
        assert tuple(r[c] for c in COUNTS) == expected
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert r.base_failed == failed and not (failed and r.kept)


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(["a", "b", "\n", " ", "c d e f g h i j ", "a b c d e f g h\n", "#"]), max_size=40)
                      .map("".join), min_size=1, max_size=30))
def test_counts_of_any_text(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in q.judged(docs).collect():
        assert tuple(r[c] for c in COUNTS) == counts(r.row.text)


def test_empty_table(no_docs):
    assert q.judged(no_docs).count() == 0


def test_verdict_follows_the_group(spark):
    """Symbols that are usual in one source condemn a text of another, also where half as many rows are junk."""
    plain, marked = "word " * 3 + "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho {}", None
    marked = plain.replace("alpha", "## ## alpha ##")
    rows = [(i, plain.format(i), "en", "plain") for i in range(60)] + [(100 + i, marked.format(i), "en", "code") for i in range(60)]
    rows += [(200 + i, marked.format(i), "en", "plain") for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.row.doc_id: r.kept for r in q.judged(docs).collect()}
    assert all(kept[i] for i in range(60)) and all(kept[100 + i] for i in range(60))
    assert not any(kept[200 + i] for i in range(25))


def test_sketch_merges_and_bounds_its_error(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 12_345, 10**9]
    got = [r.b for r in spark.createDataFrame([(v,) for v in values], "v long").select(q.bucket(F.col("v")).alias("b")).collect()]
    assert all(b <= v <= b * 33 / 32 for v, b in zip(values, got, strict=True))
    assert got[:3] == [0, 1, 63]


def test_no_python_in_the_plan(odd_docs):
    plan = q.judged(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_fences_differ_between_groups(spark):
    """On the given table, at least three ratios have other fences in other groups."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = q.measured(docs, F.lit(0))
    found = q.fences(q.sketches(rows)).collect()
    highs = {name: {r[f"fence_{name}"].high for r in found} for name in q.RATIOS}
    assert sum(len(v) >= 3 for v in highs.values()) >= 3, highs
    assert len({r.fence_word_length.low for r in found}) >= 3
    assert len(found) == docs.select("lang", "source").distinct().count()


def test_repeats_are_judged_by_their_group(spark):
    """A text with a third of its lines repeated goes where nobody repeats lines, and stays where many do."""
    def text(i: int, repeats: int) -> str:
        lines = [" ".join(f"w{i:04}x{k}y{w}" for w in range(3)) for k in range(8 - repeats)]
        return "\n".join(lines + lines[:repeats])

    rows = [(i, text(i, 0), "en", "flat") for i in range(300)] + [(400 + i, text(400 + i, 2 * (i % 10 == 0)), "en", "song") for i in range(300)]
    rows += [(900, text(900, 2), "en", "flat"), (901, text(901, 2), "en", "song")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.row.doc_id: r.kept for r in q.judged(docs).collect()}
    assert not kept.pop(900) and all(kept.values())


def test_verdicts_equal_judged(odd_docs):
    def key(rows):
        return sorted(str((r.row.doc_id, r.n_words, r.n_marks, r.base_failed, r.kept)) for r in rows.collect())
    assert key(q.verdicts(odd_docs, ["doc_id"])) == key(q.judged(odd_docs))
