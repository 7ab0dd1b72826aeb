"""License scan by diagonal voting, in DataFrame functions only.

Rolling word bigrams of each text are joined by hash to the positions of the
license templates (a fixed list below, so the broadcast side is bounded), hits
vote for their diagonal (text position minus template position), neighbouring
diagonals of one template merge, and spans are verified: a base phrase needs
every bigram on one diagonal; another template may lack a number of bigrams set
by its length (``may_lose``), but not the words that tell its license.
Votes are bit masks, so repeated rows change nothing.  A row is told by
(doc_id, hash of text); null ids and texts have one result each, null text
counts as empty.  Only hits and one light row per text are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ALNUM_WORD, ascii_lower, words

# Phrases and the labels they carry.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Wordings of the other labels: label, wordings, words of each group of which one must be met (in a shared bigram).
MORE = [
    ("mit", [("mit", ), ("license", "licence", "identifier")], [
        "licensed under the mit license", "under the mit license", "the mit license", "an mit license", "under mit license",
        "licensed under the mit licence", "under the mit licence", "the mit licence", "spdx license identifier mit"]),
    ("mit", [("permission", "granted", "obtaining")], [
        "permission is hereby granted free of charge to any person obtaining a copy",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"]),
    ("apache-2.0", [("apache", ), ("0", ), ("license", )], [
        "licensed under the apache license version 2 0", "under the apache license version 2 0", "the apache license version 2 0", "apache license version 2 0",
        "under the apache license 2 0", "apache license 2 0", "apache 2 0 license", "spdx license identifier apache 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"]),
    ("bsd", [("bsd", ), ("license", "licence", "clause")], [
        "licensed under the bsd license", "under the bsd license", "the bsd license", "a bsd license", "bsd 2 clause", "bsd 3 clause",
        "the bsd licence", "a bsd licence"]),
    ("bsd", [("redistribution", "redistributions", "binary")], [
        "redistribution and use in source and binary forms with or without modification",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"]),
    ("mpl-2.0", [("mozilla", "mpl"), ("0", )], [
        "mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file"]),
    ("cc", [("creative", ), ("attribution", )], [
        "creative commons attribution", "licensed under a creative commons attribution", "under the creative commons attribution"]),
    ("gpl", [("gnu", ), ("general", ), ("public", )], [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation"]),
]
BASE_WORDS = {"cc by": "cc", "general public license": "general", "all rights reserved": "reserved"}


def templates() -> list[tuple[str, str, bool, list[tuple[str, ...]]]]:
    """(template, label, base, word groups); a bit mask holds at most 64 bigrams."""
    return [(x, label, True, [(BASE_WORDS[x],)]) for x, label in BASE.items()] + [(x, label, False, g) for label, g, t in MORE for x in t]


def template_rows(spark) -> DataFrame:
    rows = []
    for phrase, _, base, _ in templates():
        w = phrase.split()
        rows += [(phrase, base, i, f"{w[i]} {w[i + 1]}") for i in range(len(w) - 1)]
    t = spark.createDataFrame(rows, "template string, base boolean, tpos int, gram string")
    return t.withColumn("h", F.xxhash64("gram"))


def may_lose(n_grams: int, min_share: float) -> int:
    """Bigrams a span may lack: an end word or a word put in from 3 bigrams on, any one word changed from 5 on, a share of the long ones."""
    return max(0 if n_grams < 3 else 1 if n_grams < 5 else 2, n_grams - math.ceil(min_share * n_grams - 1e-9))


def template_rules(spark, min_share: float) -> DataFrame:
    """template, label, n_grams, lost, needs: a bit mask per word group, of the bigrams that hold one of its words."""
    rows = []
    for phrase, label, base, groups in templates():
        w = phrase.split()
        pairs = list(zip(w, w[1:]))
        needs = [sum(1 << i for i, p in enumerate(pairs) if {*p} & {*g}) for g in groups]
        rows.append((phrase, label, len(pairs), 0 if base else may_lose(len(pairs), min_share), needs))
    return spark.createDataFrame(rows, "template string, label string, n_grams int, lost int, needs array<long>")


def license_scan(docs: DataFrame, min_share: float = 0.8, max_gap: int = 2) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, from one scan of the texts."""
    spark, key = docs.sparkSession, ["doc_id", "_t", "template", "base", "diag"]
    read = docs.select("doc_id", F.xxhash64("text").alias("_t"), words(ascii_lower(F.col("text")), ALNUM_WORD).alias("_w"))
    # Every template needs a word of its first group, so a text without any of them has no span.
    first = sorted({x for *_, groups in templates() for x in groups[0]})
    pairs = F.when(F.arrays_overlap("_w", F.array(*map(F.lit, first))), F.expr("zip_with(_w, slice(_w, 2, size(_w)), (a, b) -> concat(a, ' ', b))"))
    # Element 0 stands for the row itself, so that rows without a hit, and every row's length, come along.
    grams = (read.select("doc_id", "_t", F.size("_w").cast("long").alias("n_words"),
                         F.concat(F.array(F.lit(None).cast("string")), F.coalesce(pairs, F.array().cast("array<string>"))).alias("_g"))
             .select("doc_id", "_t", "n_words", F.posexplode("_g").alias("pos", "g")).withColumn("h", F.xxhash64("g")))
    known = template_rows(spark).withColumnRenamed("h", "_h")
    hits = grams.join(F.broadcast(known), (F.col("h") == F.col("_h")) & (F.col("g") == F.col("gram")), "left").where("pos = 0 or gram is not null")
    diag = F.col("pos") - 1 - F.col("tpos")
    # Neighbouring diagonals of a longer template (a word put in or left out) vote together.
    at = F.when(F.col("base"), F.array(diag)).when(~F.col("base"), F.sequence(diag - max_gap, diag + max_gap)).otherwise(F.array(F.lit(None).cast("int")))
    votes = (hits.select("doc_id", "_t", "template", "base", "n_words", F.explode(at).alias("diag"), F.expr("shiftleft(1L, tpos)").alias("bit"))
             .groupBy(*key).agg(F.bit_or("bit").alias("mask"), F.max("n_words").alias("n_words"), F.count("*").alias("n")))
    rules = template_rules(spark, min_share)
    spans = (votes.join(F.broadcast(rules), "template", "left").withColumn("share", F.bit_count("mask") / F.col("n_grams"))
             .where(F.col("template").isNull() | ((F.col("n_grams") - F.bit_count("mask") <= F.col("lost"))
                                                  & F.forall("needs", lambda x: F.col("mask").bitwiseAND(x) != 0))))
    row = F.col("template").isNull()
    found = spans.groupBy("doc_id", "_t").agg(
        F.max(F.when(row, F.col("n_words"))).alias("n_words"),
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("diag"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("diag"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"), F.max(F.when(row, F.col("n"))).alias("rows"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                        F.explode(F.sequence(F.lit(1), "rows"))).drop("col")  # repeated rows have a result each
