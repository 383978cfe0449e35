"""Held-out figures of the language and quality operators on the given tables."""

import os

import pytest

from boxlake.llm import registry

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang is not null").select("doc_id", "lang")
    got = registry.queries()["op5_language"](spark, SF).filter("held_out").join(docs, "doc_id").collect()
    assert len(got) > 200 and sum(x.lang_pred == x.lang for x in got) >= 0.98 * len(got)


def test_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality is not null")
    got = registry.queries()["op3_pu_quality"](spark, SF).filter("held_out").join(labels, "doc_id").collect()
    good, bad = ([x.score for x in got if x.quality == q] for q in (1, 0))
    area = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert area >= 0.95 and sum(x.predicted == x.quality for x in got) >= 0.93 * len(got)
