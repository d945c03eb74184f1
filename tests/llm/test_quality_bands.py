"""Bands on labelled texts that they were not fitted on."""

from rigprep.llm import band_fit, quality


def test_bad_documents_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bad = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 0")
    out = quality.fertility_rules(docs.join(bad, "doc_id", "left_semi")).where("not base_failed")
    assert out.count() >= 27 and out.where("kept").count() == 0


def test_fitted_bands_judge_the_half_they_have_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts = band_fit.measured(docs, labels).cache()
    bands = band_fit.fit_bands(texts)
    rows = band_fit.band_report(texts, bands).collect()
    total = lambda good, held, c: sum(r[c] for r in rows if r.good == good and r.held_out == held)
    assert total(True, False, "rejected") == 0 and total(True, False, "texts") > 50
    assert total(True, True, "rejected") <= 0.05 * total(True, True, "texts")
    assert total(False, True, "rejected") >= 0.8 * total(False, True, "texts") > 0
    # the rules themselves take the bands and give the same verdicts
    judged = quality.fertility_rules(docs, bands=bands).where("not base_failed and not kept").join(texts.select("doc_id"), "doc_id").count()
    assert judged == sum(r.rejected for r in rows)
    assert band_fit.fit_bands(texts.where("false")) == quality.BANDS
