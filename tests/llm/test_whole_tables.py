"""Models learn from all rows, also where those are many."""

from __future__ import annotations

from math import isclose, log

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.llm import language, pii, quality
from millrace.llm.common import bounded_sample, held_out

MANY = 60_000  # of which two thirds may be learned from


def test_pii_learns_from_all_documents(spark):
    docs = spark.range(MANY).selectExpr("id AS doc_id", "concat('mail a', id, '@host.', if(id % 3 = 0, 'org', 'left'), ' soon') AS text")
    good, every = docs.where("pmod(xxhash64(text), 2) = 0").agg(F.expr("count_if(doc_id % 3 = 0)"), F.count("*")).first()
    assert isclose(pii.fit(docs).prior[0], log(good / (every - good)))


def test_languages_learn_from_all_texts(spark):
    known = spark.range(MANY).selectExpr("id AS doc_id").where(~held_out(F.col("doc_id")))
    sampled = bounded_sample(known, 20_000, F.col("doc_id")).withColumn("sampled", F.lit(True))
    text = F.when(F.col("sampled"), "plain").when(F.col("doc_id") % 2 == 0, "qzj").otherwise("plain")
    docs = known.join(sampled, "doc_id", "left").select("doc_id", text.alias("text"), F.expr("if(doc_id % 2 = 0, 'xx', 'yy')").alias("lang"))
    _, slot = language.grams(np.frombuffer(b"qzj", np.uint8), np.array([0, 3]), 16)
    assert language.fit(docs).ratios[slot].any()  # words that no sample shows


def test_quality_learns_from_all_labelled_rows_in_bounded_shards(spark, monkeypatch):
    counted = lambda shard, *_: pd.DataFrame({"slot": [0, 1], "weight": [float(len(shard)), 1.0]})
    monkeypatch.setattr(quality, "_follow_leader", counted)
    docs = spark.range(MANY).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    model = quality.fit(docs, docs.selectExpr("doc_id", "int(doc_id % 2) AS quality"))
    learnt = docs.where(~held_out(F.col("doc_id"))).count()
    assert model.weights[0] == learnt and model.weights[1] >= learnt / quality.SHARD_ROWS
