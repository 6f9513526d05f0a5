import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from ontime.llm import queries

SF = "/root/testdata/sf0.01"


def test_stages_keep_clean_documents_and_their_columns(spark):
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        counts.append(docs.count())
    assert counts[0] == counts[1] >= counts[2] == counts[3] >= counts[4] >= 0.8 * counts[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == counts[4]


def test_language_stage_rejects_foreign_and_nonsense_texts_alone(spark):
    rng = np.random.default_rng(3)
    junk = ["kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki",
            "Все люди рождаются свободными и равными в своем достоинстве и правах, они наделены разумом",
            "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待" * 3,
            "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), 400)),
            "".join(rng.choice(list("bcdfghjklmnpqrstvwxz    "), 150)),
            " ".join("%x" % k for k in rng.integers(1 << 20, 1 << 40, 60))]
    docs = queries.table(spark, SF, "documents")
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(junk)],
                                    "doc_id long, text string, lang string")
    found = queries.identified_documents(spark, docs.unionByName(planted, allowMissingColumns=True), SF)
    assert [r.text for r in found.where("doc_id < 0").collect()] == []
    assert found.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_run_on_the_whole_table(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and "sequence_id" in found.columns


def test_stages_on_odd_rows_and_an_empty_table(spark, odd_docs, no_docs):
    """Nulls, empty and long texts, repeated rows, a null id, clashing columns."""
    for docs in (odd_docs, no_docs):
        now, size = docs, docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns and [f.dataType for f in now.schema] == [f.dataType for f in docs.schema]
            assert (left := now.count()) <= size
            size = left
        pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF)
        assert pieces.select("doc_id").distinct().count() <= max(size, 0) and (size > 0) == (pieces.count() > 0)
