"""The pipeline stage by stage against the operators' brute-force forms."""

import os
import subprocess
import sys

import corpus_pipeline as P
from conftest import SMALL
from marquee.llm import toxicity
from llm.test_near import shingles
from llm.test_overlap import brute as overlap


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in P.STAGES[:-1]:
        docs = P.written(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == names
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.items() <= before.items()
        if name == "near_duplicates":
            sets = {k: shingles(t) for k, t in after.items()}
            ids = sorted(sets)
            assert not any(100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for a in ids for b in ids if a < b and sets[a] and len(sets[a] & sets[b]))
        if name == "decontamination":
            gone = set(before) - set(after)
            assert gone == {d for d, _, hit, _, _ in overlap([(k, before[k]) for k in gone], items) if hit}
        before = after
    last = P.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in last) == sorted(before) and all(len(r.ids) == 4 * r.n_tokens for r in last)


def test_run_gives_the_last_stage(spark):
    rows = P.run(spark, SMALL).collect()
    assert rows and {"doc_id", "ids", "n_tokens"} <= set(rows[0].asDict())
    assert toxicity.FOLDS == 5


def tables(spark, folder, docs, names="doc_id long, text string, lang string, source string, n_chars long, score string, _id string, _mark int, component int"):
    """A folder with the documents given, the small table's labels and benchmark items."""
    docs = spark.createDataFrame(docs, names)
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return docs


def test_run_on_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated ids and rows, very long texts, clashing column names."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(120).collect()
    extra = ("s", "i", 1, 2)
    clean = next(r for r in rows if r.lang == "en" and r.text and 300 < len(r.text) < 3000)
    other = next(r for r in rows if r.lang == "fr" and r.text and 300 < len(r.text) < 3000)
    odd = [(None,) * 9, (1, None, "en", None, None, *extra), (2, "", "en", "s", 0, *extra), (None, other.text, None, None, None, *extra),
           (clean.doc_id, other.text + " " + clean.text, "en", "s", 1, *extra), (900, (clean.text + " ") * 300, "en", "s", 1, *extra)]
    docs = tables(spark, str(tmp_path), [(*r, *extra) for r in rows] + odd + odd[1:])
    found = docs
    for name, stage in P.STAGES[:-1]:
        found = P.written(stage(spark, found, str(tmp_path)), f"odd-{name}")
        assert found.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in found.collect()]
    assert all(t for _, t in kept)  # the language stage drops texts without letters
    assert sorted(r.doc_id for r in P.run(spark, str(tmp_path)).collect() if r.doc_id is not None) == sorted(d for d, _ in kept if d is not None)
    assert (clean.doc_id, other.text + " " + clean.text) in kept or (clean.doc_id, clean.text) in kept


def test_run_on_an_empty_table(spark, tmp_path):
    tables(spark, str(tmp_path), [])
    assert P.run(spark, str(tmp_path)).collect() == []


def test_executors_need_no_copy_of_the_repository(tmp_path):
    """The models and indexes that tasks receive bring their code along."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.abspath(P.__file__))!r})
from pyspark.sql import SparkSession, functions as F
from marquee.llm import decontaminate, language, token_align, toxicity, hidden_markov, periodic_runs
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate()
docs = spark.createDataFrame([(k, ("the cat and the dog " if k % 2 else "der hund und die katze ") + f"w{{k}}", "en" if k % 2 else "de") for k in range(40)], "doc_id long, text string, lang string")
labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
items = spark.createDataFrame([("a", "dog w1")], "item_id string, text string")
model = language.train(docs, F.lit(True))
print("kept", language.keep_identified(docs, model, 0.0).count(), language.predict(docs, model).count())
model = toxicity.train(docs, labels, F.lit(True))
print("kept", toxicity.keep_harmless(docs, model).count(), toxicity.predict(docs, model).count())
print("kept", decontaminate.decontaminate(docs, items).count(), decontaminate.find_overlap(docs, items).count())
print("kept", hidden_markov.LanguageModel(docs, F.lit(True)).scores().count(), token_align.Alignment(docs).documents().count(), periodic_runs.periodic_runs(docs).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    lines = [x.split()[1:] for x in done.stdout.splitlines() if x.startswith("kept")]
    # how much the two models keep of such a toy table is not the point
    assert done.returncode == 0 and [x[-1] for x in lines] == ["40"] * 4 and lines[2:] == [["39", "40"], ["40", "40", "40"]], done.stderr[-2000:]
