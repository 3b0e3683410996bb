"""The shared folder of a session, with and without spark.checkpoint.dir, and what stays in it."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from indexpanel.llm.common import materialize, scratch

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(code: str, tmp_path, **conf: str) -> str:
    """Runs code in a fresh session whose defaults name no checkpoint folder."""
    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", **conf}
    start = "".join(f".config({k!r}, {v!r})" for k, v in conf.items())
    script = ("from pyspark.sql import SparkSession\n"
              f"spark = SparkSession.builder.master('local[2]').appName('t'){start}.getOrCreate()\n"
              "spark.sparkContext.setLogLevel('OFF')\n" + code)
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=600, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


@pytest.mark.parametrize("named", [False, True])
def test_operators_need_no_named_folder(tmp_path, named):
    conf = {"spark.checkpoint.dir": f"file://{tmp_path}/shared"} if named else {}
    code = """
import corpus_pipeline
from indexpanel.llm import mixing, near_dedup, quality_rules, residual_packing, secret_ownership
docs = spark.createDataFrame([(i, "some words of text " * 9, "en", "s", 171) for i in range(3)],
                             "doc_id long, text string, lang string, source string, n_chars long")
assert quality_rules.judged(docs).count() == 3
assert mixing.mixed(docs).count() == 3
assert secret_ownership.spans(docs).count() == 3
assert near_dedup.grouped(docs).count() == 3
assert residual_packing.placed(residual_packing.pieces(docs, length=2048), length=2048).count() == 3
docs.write.parquet(PATH)
assert corpus_pipeline.run(spark, PATH.rsplit("/", 1)[0]).count() >= 0
from indexpanel.llm.common import shared_dir
print(shared_dir(spark))
""".replace("PATH", repr(f"{tmp_path}/documents.parquet"))
    out = run(code, tmp_path, **conf)
    assert (f"{tmp_path}/shared" in out) == named


def test_a_cluster_without_a_folder_is_refused():
    from indexpanel.llm.common import shared_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_dir(Session())


def test_scratch_tables_go_and_kept_ones_stay(spark):
    def exists(df):
        return os.path.isdir(df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])

    with scratch() as outer:
        with scratch() as keep:
            gone = materialize(spark.range(3))
            files = gone.inputFiles()
            kept = keep(gone.select("id"))
        assert not os.path.exists(files[0].removeprefix("file://")) and exists(kept)
        last = outer(kept.selectExpr("id + 1 AS id"))
        held = kept.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(held) and sorted(r.id for r in last.collect()) == [1, 2, 3]
    with pytest.raises(ZeroDivisionError), scratch():
        broken = materialize(spark.range(3)).inputFiles()[0].removeprefix("file://")
        raise ZeroDivisionError
    assert not os.path.exists(broken)
