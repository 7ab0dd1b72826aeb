"""The registered queries of this subpackage."""

from __future__ import annotations


from tessera.llm import (
    conversations,
    decontaminate,
    language,
    licenses,
    multipack,
    oracles,
    packing,
    quality,
    resampling,
    secret_scan,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)
from tessera.llm.common import table

QUERIES = {}
ORACLES = {"op2_suffix_dedup": oracles.SUFFIX_DEDUP, "op10_warc": oracles.WARC, "op11_conversations": oracles.CONVERSATIONS,
           "op13_resampling": oracles.RESAMPLING}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark, sf_dir):
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


@query
def op4_quality(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents")).drop("cleaned_text")


@query
def op6_licenses(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark, sf_dir):
    return packing.best_fit_pack(table(spark, sf_dir, "documents"))


@query
def op9_secrets(spark, sf_dir):
    return secret_scan.digest(secret_scan.secret_scan(table(spark, sf_dir, "documents")))


@query
def op10_warc(spark, sf_dir):
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


@query
def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


@query
def op3_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op5_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_matches=True)


@query
def op8_toxicity(spark, sf_dir):
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_resampling(spark, sf_dir):
    return resampling.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_multipack(spark, sf_dir):
    return multipack.multi_length_pack(table(spark, sf_dir, "documents"))


@query
def op11_conversations(spark, sf_dir):
    return conversations.repaired_conversations(table(spark, sf_dir, "conversations"))
