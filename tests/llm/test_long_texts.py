"""One text with very many secrets: places and redaction take linear time; pipeline columns of any name."""

import hashlib
import re
import time

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import secret_scan


def test_a_hundred_thousand_secrets_in_one_text(spark):
    text = " ".join(("é " if k % 7 == 0 else "") + hashlib.md5(str(k).encode()).hexdigest() for k in range(100_000))
    start = time.time()
    found = secret_scan.secret_scan(spark.createDataFrame([(1, text), (2, "clean")], "doc_id long, text string"))
    row = found.withColumn("left", secret_scan.redact()).where("doc_id = 1").first()
    assert time.time() - start < 120
    assert [(x.s, x.e) for x in row.found if x.kind == "hex"] == [m.span() for m in re.finditer("[0-9a-f]{24,}", text)]
    assert row.left == re.sub("[0-9a-f]{24,}", "[SECRET]", text)


def test_text_stages_keep_columns_of_any_name(spark):
    names = ["_new", "_changed", "row", "text_hash", "found"]
    good = "The quick brown fox jumps over the lazy dog near the river bank, and then it walks home through the quiet green fields before night falls again."
    docs = spark.createDataFrame([(1, f"{good} token = abcdefgh12", *names), (2, good, *names), (3, None, *names), (None, "", *names)],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)).withColumn("n_chars", F.length("text").cast("long"))
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.secret_stage):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[n] for n in names] == names and r.n_chars == (len(r.text) if r.text is not None else None)
    assert {r.doc_id: r.text for r in corpus_pipeline.secret_stage(spark, docs, "").collect()}[1] == f"{good} [SECRET]"
