"""Rows that share an id in the pipeline, long documents in training, bounded memories."""

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from oreflow.llm import passage_attention

RIVER = "the river ran slowly past the old mill and the miller watched it go by every morning"
STONE = "seven grey stones lie on the hill where nobody has walked since the winter of the great snow"


def test_texts_of_a_shared_id_are_judged_one_by_one(spark):
    rows = [(1, STONE, 5), (2, STONE, 5), (2, RIVER, 5), (2, RIVER, 5), (3, RIVER, 5), (4, "short", 5), (None, RIVER, 5), (None, None, 5), (5, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    # The river text of id 2 comes after all ids, so that of id 3 stands for it.
    assert sorted((tuple(r)[:2] for r in left.collect()), key=str) == sorted([(1, STONE), (3, RIVER), (4, "short"), (5, None), (None, RIVER), (None, None)], key=str)


def test_a_clean_text_of_a_shared_id_stays(spark):
    docs = spark.createDataFrame([(1, STONE), (2, STONE), (2, RIVER)], "doc_id long, text string")
    assert sorted(r.text for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == sorted([STONE, RIVER])


def test_every_passage_of_a_long_document_is_learned_from():
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(64 * 500))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([long]), pa.array([1.0])], names=["order", "text", "label"])
    (made,) = passage_attention._features(iter([batch]))
    features = np.frombuffer(made.column(1)[0].as_py(), np.float32).reshape(-1, passage_attention.FEATURES)
    assert np.array_equal(features, passage_attention.passages(batch.column(1))[0].astype(np.float32))
    assert len(features) >= 500
