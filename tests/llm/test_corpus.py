"""All registered queries against SQL, the pipeline stage by stage against plain versions, and life without this folder."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from check_queries import differences, duck

import __spark_entry__ as entry
import corpus_pipeline
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from flowgauge.llm import quality, toxicity
from flowgauge.llm.mixing import mixing_plan
from flowgauge.llm.queries import ORACLES, QUERIES
from test_near_dedup import plain_groups

ROOT = Path(__file__).resolve().parents[2]
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark):
    ours = QUERIES[name](spark, SMALL).toPandas()
    assert differences(ours, duck(SMALL).execute(ORACLES[name]).df()) == ""


def test_all_are_registered():
    names = set(entry.queries())
    assert names >= set(QUERIES) | {"pipeline"}
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_stages_by_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def texts(df):
        assert df.columns == columns
        return {r["doc_id"]: r["text"] for r in df.collect()}

    all_ = texts(docs)
    model = quality.fit_quality(docs, labels)
    after = stages["quality"](spark, docs, SMALL)
    good = texts(after)
    assert good == {i: t for i, t in all_.items() if model.predict(quality.matrix([t.encode()]))[0] >= 0.3}
    score = toxicity.toxicity_scorer(toxicity.fit_toxicity(after, labels))
    after = stages["toxicity"](spark, after, SMALL)
    civil = texts(after)
    assert civil == {i: t for i, t in good.items() if score([t.encode()])[0] < 0.5}
    after = stages["minhash_dedup"](spark, after, SMALL)
    once = texts(after)
    assert once == {i: civil[i] for i, _, _, kept in plain_groups(list(civil.items()), 5, 80) if kept}
    plan = {r["doc_id"]: r["copies"] for r in mixing_plan(after).collect()}
    after = stages["mixing"](spark, after, SMALL)
    assert after.columns == columns
    mixed = Counter(r["doc_id"] for r in after.collect())
    assert mixed == Counter({i: n for i, n in plan.items() if n}) and set(plan) == set(once)
    packed = stages["packing"](spark, after, SMALL).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == mixed
    whole = sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).drop("sequence_id", "offset").collect())
    assert whole == sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)


def test_stages_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    """Nulls, repeats and clashing columns go through; an empty table stays empty."""
    spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, now, str(tmp_path))
            if name != "packing":
                assert after.columns == docs.columns
                after = corpus_pipeline.stored(after, name)
            now = after
        assert now.isEmpty() == docs.isEmpty()


def test_dedup_judges_rows_by_their_texts(spark):
    """Copies under one id or none leave one row; an unlike text under a repeated id stays."""
    x, y = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    rows = [(0, x), (1, x.upper()), (1, y), (2, y), (None, x), (None, y + " more"), (3, y), (3, y), (4, ""), (4, ""), (5, None), (None, "a z"), (None, "a z")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    kept = dict(corpus_pipeline.STAGES)["minhash_dedup"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(0, x), (1, y), (4, ""), (4, ""), (5, None), (None, "a z")], key=str)


def test_rest_works_without_this_subpackage(tmp_path):
    """A copy without the folder and the pipeline still imports and has all other queries."""
    script = f"""
import shutil, sys
shutil.copytree({str(ROOT)!r}, {str(tmp_path / "copy")!r}, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
sys.path.insert(0, {str(tmp_path / "copy")!r})
import __spark_entry__ as entry
assert entry.__file__.startswith({str(tmp_path)!r})
assert "station_flow" in entry.queries() and "pipeline" not in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
"""
    subprocess.run([sys.executable, "-B", "-c", script], check=True, cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})
