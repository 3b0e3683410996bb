"""Records with quoted line breaks: splits of any size give what one pass over the file gives."""

from __future__ import annotations

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indexpanel.sources import grid
from indexpanel.sources.records import read_records, records
from indexpanel.sources.staged import Pick, load_metrics, load_with_rejects, read_staged


def plain(text):
    """One pass with a flag; after a quote that is never closed every line stands alone."""
    lines = text.split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    out, held = [], []
    for line in lines:
        held.append(line)
        if "\n".join(held).count('"') % 2 == 0:
            out, held = [*out, "\n".join(held)], []
    return [x.removesuffix("\r") for x in [*out, *held]]


def as_lines(spark, texts, cut):
    """`cut` lines per split."""
    rows = []
    for name, text in enumerate(texts):
        lines = text.split("\n")
        lines = lines[:-1] if lines[-1] == "" else lines
        rows += [(str(name), i // cut * 10, i, x) for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "file string, split long, at long, line string")


def gathered(df, n):
    out = [[] for _ in range(n)]
    for r in df.orderBy("file", "record").collect():
        assert r.record == len(out[int(r.file)])
        out[int(r.file)].append(r.line)
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='a,"\n\r', max_size=40), min_size=1, max_size=40), st.integers(1, 5))
def test_any_text_in_any_splits(spark, texts, cut):
    got = gathered(records(as_lines(spark, texts, cut)), len(texts))
    assert got == [plain(t) for t in texts]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def table(n):
    return [[str(i), f'{i} "quoted", {"x" * (i % 50)}' + "\n" * (i % 4) + "end", f"tail\r\n{i}" if i % 7 == 0 else ""] for i in range(n)]


def written(path, rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    path.write_bytes(out.getvalue().encode())


def test_a_file_is_read_in_many_splits(small_splits, tmp_path):
    rows = table(3000)
    written(tmp_path / "a b.csv", rows)
    written(tmp_path / "long.csv", [["1", "line\n" * 20_000, "x"], ["2", "y", "z"]])
    cells = grid.read_grid(small_splits, str(tmp_path))
    got = {(r.sheet, r.row_idx): r.cells for r in cells.collect()}
    assert len(got) == 3002
    for i, row in enumerate(rows):
        assert got["a b", i] == [c or None for c in row]
    assert got["long", 0] == ["1", "line\n" * 20_000, "x"] and got["long", 1] == ["2", "y", "z"]
    assert read_records(small_splits, str(tmp_path)).select("file").distinct().count() == 2
    splits = small_splits.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert splits > 10


def test_staged_counts_equal_one_pass(small_splits, tmp_path):
    rows = table(2000)
    for i in range(0, 2000, 5):
        rows[i][0] = "no number"
    for part in range(4):
        written(tmp_path / f"p{part}.csv", [["id\nof row", "text", "rest"], *rows[part::4]])
    picks = [Pick("id", 1, "bigint"), Pick("body", 2), Pick("rest", 3)]
    loaded = load_with_rejects(read_staged(small_splits, str(tmp_path)), picks)
    assert tuple(load_metrics(loaded).first()) == (2000, 1600, 400, 0)
    good = {r.id: (r.body, r.rest or "") for r in loaded.where("status = 'loaded'").collect()}
    assert good == {int(r[0]): (r[1], r[2]) for r in rows if r[0] != "no number"}


def test_an_open_quote_ends_with_its_line(small_splits, tmp_path):
    (tmp_path / "open.csv").write_text('1,"a\nb",c\n2,"open,c\n' + "".join(f"{i},x,y\n" for i in range(3, 2000)))
    loaded = load_with_rejects(read_staged(small_splits, str(tmp_path), header=False), [Pick("id", 1, "bigint"), Pick("n", 3)])
    assert tuple(load_metrics(loaded).first()) == (1999, 1998, 1, 1)


def test_nothing_but_splits_is_gathered(small_splits, tmp_path):
    """No window by file alone over lines, no file as one value."""
    written(tmp_path / "a.csv", table(100))
    text = read_records(small_splits, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "wholetext" not in text.lower() and "SinglePartition" not in text


def test_empty_files_and_lines(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "gaps.csv").write_text("a\n\nb\r\n\n")
    got = read_records(spark, str(tmp_path)).orderBy("record").select(F.col("file.file_name"), "record", "line").collect()
    assert [tuple(r) for r in got] == [("gaps.csv", 0, "a"), ("gaps.csv", 1, ""), ("gaps.csv", 2, "b"), ("gaps.csv", 3, "")]
