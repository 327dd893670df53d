"""Composite jobs: exploration report, featurisation, tuned job, streaming."""

from pyspark.sql import functions as F

from fundcast.fixtures import campaign_table
from fundcast.operators import features as FT
from fundcast.plans import train as TR
from fundcast.plans.explore import explore, snapshot
from fundcast.plans.featurise import featurise, fit_text_pipeline, materialise_features, text_pipeline
from fundcast.plans.prepare import prepare
from fundcast.plans.wordcount import top_words_file
from fundcast.sinks import write_csv, write_text
from fundcast.sources import read_parquet
from fundcast.streaming import prepare_stream

from conftest import SF_SMALL


def test_explore_reports_are_lazy_frames(spark, tmp_dir):
    raw = campaign_table(spark, SF_SMALL)
    snap = snapshot(spark, write_csv(raw, tmp_dir + "/csv"), tmp_dir + "/pq", lossless=True)
    reports = explore(snap)
    assert reports["shape"].first()["n_rows"] == raw.count()
    assert reports["prepared_shape"].first()["n_rows"] == prepare(raw).count()
    assert reports["missing_country_currencies"].count() >= 1


def test_featurise_stage_by_stage(spark, tmp_dir):
    prep = prepare(campaign_table(spark, SF_SMALL))
    frames, models = featurise(prep, 5, "keep")
    assert set(frames) == {"tokens", "filtered", "vectorized", "tfidf", "indexed", "features"}
    size = len(models["count_vectorizer"].vocabulary) + 5
    assert frames["features"].select(F.col("features")).first()[0].size == size
    back = read_parquet(spark, materialise_features(prep, tmp_dir, 5, "keep"))
    assert back.count() == prep.count()


def test_text_pipeline_hoisted_equals_plain(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    plain = text_pipeline(5).fit(docs)
    hoisted = fit_text_pipeline(docs, 5)
    assert plain.stages[2].vocabulary == hoisted.stages[2].vocabulary
    a = {r["doc_id"]: r["tfidf"] for r in plain.transform(docs).select("doc_id", "tfidf").collect()}
    b = {r["doc_id"]: r["tfidf"] for r in hoisted.transform(docs).select("doc_id", "tfidf").collect()}
    assert a == b
    assert len(FT.text_stages()) == 2


def test_tuned_logreg_job(spark, tmp_dir):
    prep = prepare(campaign_table(spark, SF_SMALL))
    out = TR.tuned_logreg(prep, tmp_dir, reg_params=(1e-7, 1e-1), min_dfs=(5.0,), max_iter=10, key="project_id")
    assert out["metrics"].count() == 2
    assert 0.0 <= out["f1"].first()["f1"] <= 1.0
    assert out["confusion"].agg(F.sum("count")).first()[0] == out["scored"].count()
    model, loaded = out["model"], TR.load_pipeline(tmp_dir)
    assert len(loaded.stages) == len(model.stages) == 7  # both category columns are one stage
    before, after = (
        sorted(tuple(r) for r in TR.scores_table(m.transform(prep)).collect()) for m in (model, loaded)
    )
    assert before == after and len(before) == prep.count()


def test_word_count_file(spark, tmp_dir):
    write_text(spark.createDataFrame([("b a b",), ("a b",)], "v string"), "v", tmp_dir)
    assert [tuple(r) for r in top_words_file(spark, tmp_dir, 1).collect()] == [("b", 3)]


def test_prepare_stream_equals_batch(spark, tmp_dir):
    raw = campaign_table(spark, SF_SMALL)
    write_csv(raw.repartition(3), tmp_dir + "/in")
    q = prepare_stream(spark, tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ckpt")
    q.awaitTermination(300)
    streamed = read_parquet(spark, tmp_dir + "/out")
    batch = prepare(raw)
    key = ["project_id", "goal", "days_campaign", "hours_prepa", "country2", "currency2", "text"]
    assert streamed.select(key).exceptAll(batch.select(key)).count() == 0
    assert streamed.count() == batch.count()


def test_prepare_stream_resumes_from_checkpoint(spark, tmp_dir):
    raw = campaign_table(spark, SF_SMALL)
    first = raw.filter(F.col("project_id") < 100)
    second = raw.filter(F.col("project_id") >= 100)
    write_csv(first, tmp_dir + "/in/part1")
    q = prepare_stream(spark, tmp_dir + "/in/*", tmp_dir + "/out", tmp_dir + "/ckpt")
    q.awaitTermination(300)
    n1 = read_parquet(spark, tmp_dir + "/out").count()
    assert n1 == prepare(first).count()
    write_csv(second, tmp_dir + "/in/part2")
    q = prepare_stream(spark, tmp_dir + "/in/*", tmp_dir + "/out", tmp_dir + "/ckpt")
    q.awaitTermination(300)
    out = read_parquet(spark, tmp_dir + "/out")
    assert out.count() == prepare(raw).count()
    assert out.select("project_id").distinct().count() == out.count()


def test_registered_tuned_job_covers_the_full_grid(spark):
    import __spark_entry__ as entry

    job = entry.queries()["tuned_logreg_job"]
    rows = job(spark, SF_SMALL).collect()
    points = {(r["regParam"], r["minDF"]) for r in rows}
    assert points == {(r, m) for r in (1e-7, 1e-5, 1e-3, 1e-1) for m in (55.0, 75.0, 95.0)}
    assert all(0.0 <= r["f1"] <= 1.0 and 0.0 <= r["test_f1"] <= 1.0 for r in rows)
