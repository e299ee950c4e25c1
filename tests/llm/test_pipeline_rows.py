"""What the pipeline keeps of rows whose ids are null or repeated, and of odd columns."""

import collections

import corpus_pipeline

TEXT = "one two three four five six seven eight nine ten eleven twelve"


def test_one_row_of_each_group_stays(spark):
    rows = [(1, TEXT), (1, TEXT), (None, TEXT), (None, TEXT), (2, TEXT), (2, "another text altogether, with words of its own"), (None, None), (None, None), (3, ""), (4, TEXT + " more")]
    docs = spark.createDataFrame([(*r, i, i) for i, r in enumerate(rows)], "doc_id bigint, text string, pos int, `a.b` int")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert kept.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter([rows[0], rows[5], rows[6], rows[7], rows[8]])
    unique = spark.createDataFrame([(5, TEXT), (3, TEXT), (9, "x")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, unique, None).collect()) == [3, 9]
