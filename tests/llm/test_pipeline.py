"""The pipeline's stages on the smallest tables, each held against the plainer functions of test_operators."""

from pyspark.sql import functions as F

import corpus_pipeline
from atelier.llm.shared import written

from .test_operators import SMALL, base_counts, base_spans, contaminated, near_classes


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SMALL), "test")
        after = out.collect()
        ids = {r.doc_id for r in after}
        if name == "quality rules":
            assert all(not base_counts(r.text)[5] for r in after) and len(after) > 0.7 * len(before)
        if name == "MinHash near-dedup":
            assert ids == set(near_classes([(r.doc_id, r.text) for r in before]).values())
        if name == "benchmark decontamination":
            assert ids == {r[0] for r in contaminated([(r.doc_id, r.text) for r in before], bench) if not r[5]}
        if name == "PII":
            assert len(after) == len(before) and not any(base_spans(r.text or "") for r in after) and all(r.n_chars == len(r.text) for r in after)
        if name == "best-fit packing":
            assert {r.doc_id for r in before} == ids
        else:
            assert out.columns == docs.columns
        docs, before = out, after
    assert corpus_pipeline.run(spark, SMALL).count() == len(after)


def test_stages_of_odd_tables(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, other columns, and no rows at all."""
    text = " ".join(f"word{i % 61} and{i % 37}" for i in range(400))
    other = " ".join(f"next{i % 71} thing{i % 41}" for i in range(300))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (None, other, "xx", None, 5), (5, other, "xx", "s", 5), (6, " ".join([other] * 80), "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("clash") for c in ("n", "label", "_text", "_base", "kept", "low", "pieces")})
    for given, seen in ((docs, True), (docs.limit(0), False)):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, given, SMALL), "odd")
            after = out.collect()
            if name == "quality rules":
                assert all(r.text for r in after) and (not seen or {r.doc_id for r in after} >= {1, 2})
            if name == "MinHash near-dedup" and seen:
                assert sorted(r.doc_id for r in after if r.text == text) == [1, 1]
            if name != "best-fit packing":
                assert out.columns == docs.columns
            given = out
        assert bool(after) == seen
