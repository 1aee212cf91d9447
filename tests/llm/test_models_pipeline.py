"""Trained operators by held-out accuracy, the pipeline, the SQL oracles."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]
from llm_frames import ODD_ROWS, make_docs  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
import oracle_harness  # noqa: E402
from playlens.llm import langid, quality, queries  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = queries.op8_language_id(spark, SF).join(docs, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == docs.count() and held
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["rejected"] for r in found) <= 0.005 * len(found)


def test_language_odd_rows(spark):
    docs = make_docs(spark, ODD_ROWS + [(100 + i, "der die das und ein Haus", "de") for i in range(4)])
    model = langid.fit(docs)
    found = langid.identify(docs, model).collect()
    assert len(found) == docs.count()
    by_id = {r["doc_id"]: r for r in found}
    for i in (2, 3, 4):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[100]["lang_pred"] == "de" and not by_id[100]["rejected"]
    nothing = langid.fit(docs.where("false"))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.where("false"), model).count() == 0


def test_foreign_script_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    languages, _, rejected = model.predict(["Это совсем другой язык и другая письменность", "漢字仮名交じり文の例です"])
    assert rejected.all()


def test_fit_ignores_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    rows = docs.where(~langid.held_out())
    assert rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).count() == 0
    noisy = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit(rows), langid.fit(noisy.where(~langid.held_out()))
    assert a.languages == b.languages and np.allclose(a.centroids, b.centroids)


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = queries.op4_quality_classifier(spark, SF)
    assert found.count() == 1000
    rows = found.join(labels, "doc_id").where("held_out").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    auc = np.mean((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :]))
    assert auc >= 0.9
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in rows]) >= 0.88
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_odd_rows(spark):
    docs = make_docs(spark, ODD_ROWS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    found = quality.score(docs, model).collect()
    assert len(found) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in found)
    none = quality.fit(docs, labels.where("false"))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("false"), model).count() == 0


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, quality.FEATURES))
    y = (x[:, 0] + rng.normal(size=1500) > 0).astype(float)  # noisy labels: an overfitted net is overconfident
    model = quality.train(np.zeros((1, 1), np.float32), x, y, epochs=40)
    assert model.temperature > 1
    fresh = rng.normal(size=(3000, quality.FEATURES))
    p = 1 / (1 + np.exp(-model.logits(fresh) / model.temperature))
    truth = fresh[:, 0] + rng.normal(size=3000) > 0
    confident = p > 0.8
    assert abs(truth[confident].mean() - p[confident].mean()) < 0.1


def test_pipeline(spark):
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == corpus_pipeline.COLUMNS, name
        n = docs.count()
        assert before is None or n <= before
        before = n
    kept = docs.select("doc_id").collect()
    assert len({r["doc_id"] for r in kept}) == len(kept) and 600 < len(kept) < 950
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    source = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality_filter(spark, source, SF).join(labels, "doc_id").count()
    assert good >= 0.97 * labels.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == len(kept)


def test_pipeline_stages_on_odd_rows(spark):
    """Every stage on odd rows and on an empty table."""
    docs = make_docs(spark, ODD_ROWS)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert name == "packing" or found.columns == corpus_pipeline.COLUMNS
        found.count()
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [-3, 0, 1, 2, 3, 4, 6, 7, 7, 8]


def test_near_duplicate_stage_keeps_one_text_of_a_group(spark):
    """Rows are decided by id and text, also where an id has several texts."""
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(3, " ".join(a)), (7, " ".join([*a[:-1], "x"])), (7, " ".join(b)), (7, " ".join([*b[:-1], "y"])), (7, " ".join(b))]
    kept = corpus_pipeline.near_duplicates(spark, make_docs(spark, rows), SF).select("doc_id", F.substring("text", 1, 1)).collect()
    assert sorted(map(tuple, kept)) == [(3, "a"), (7, "b")]


def test_word_vectors_equal_a_plain_sum(spark):
    texts = ["One two, three TWO four", "two three", None, "", "x", "a1 b2 (c3) d4 e5 " * 40]
    positions, signs = quality.index_vectors()
    want = np.zeros((quality.ROWS, quality.DIM))

    def add(target, source):
        for p, s in zip(positions[source], signs[source]):
            want[target, p] += s

    for text in texts:
        rows = list(quality.word_rows([(text or "").encode()], 1 << 16))
        words, shapes = (np.concatenate([r[k] for r in rows]).tolist() for k in (2, 3))
        for i in range(len(words)):
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if j != i:
                    add(words[i], words[j])
                    add(shapes[i], words[j])
                    add(shapes[i], shapes[j])
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1)
    docs = make_docs(spark, list(enumerate(texts)))
    assert np.allclose(quality.word_vectors(docs.repartition(3)), want, atol=1e-6)


def test_repeated_ids_train_alike(spark):
    """The training rows don't depend on how often a row is repeated or where it lies."""
    rows = [(i, f"word{i % 7} some text {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    once = quality.fit(make_docs(spark, rows), labels, sample=25)
    vectors = once.vectors
    again = quality.fit(make_docs(spark, rows[::-1] + rows[:10] * 30), labels, sample=25)
    again.vectors = vectors
    assert np.allclose(once.mean[-1], again.mean[-1]) and len(once.weights) == 4


def test_texts_without_letters_are_undetermined(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()))
    odd = ["² ½ Ⅷ ①", "123 !!", "", None, "_ _", "\u0301"]
    found = langid.identify(make_docs(spark, list(enumerate(odd))), model).collect()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in found} == {("und", 0.0, True)}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    found = queries.queries()[name](spark, SF).toPandas()
    assert oracle_harness.compare(found, oracle_harness.duck(SF).execute(queries.oracle_sql()[name]).df()) is None


def test_registered_with_the_driver():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names


def test_workers_find_the_package_from_elsewhere(tmp_path):
    """The driver may run in any folder; executors get the package shipped."""
    root = os.path.dirname(os.path.dirname(HERE))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\nfrom playlens.config import local_session\n"
        "s = local_session(2)\nprint('ROWS', e.queries()['op10_bpe_codec'](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200" in out.stdout, out.stderr[-2000:]
