"""The pipeline's stages on small tables."""

import corpus_pipeline
import pytest
from test_operators import FOLDER, empty, odd

from pagemill.llm.shared import written


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = written(stage(spark, docs, FOLDER), name)
        assert 0 < docs.count() <= before
        if name != "byte_bpe":
            assert docs.columns == columns
    assert sorted(docs.collect()) == sorted(corpus_pipeline.run(spark, FOLDER).collect())


@pytest.mark.parametrize("make", [odd, empty])
def test_stages_take_odd_rows(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), name)
    assert (docs.count() == 0) == (make is empty)
