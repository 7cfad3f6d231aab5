"""Registered queries of the operators, with production parameters."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import cache, wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm import binary, chat, decontamination, jaccard, licenses, oracles, packing, passages, quality, secrets, structure, substring, urls, whitening
from gustline.session import stage

Query = Callable[[SparkSession, str], DataFrame]

CAPACITY = 1024
COMPONENTS = 4


@cache
def _archive() -> str:
    root = Path(__file__).resolve().parents[2]
    base = str(Path(tempfile.mkdtemp(prefix="gustline-"), "gustline"))
    return shutil.make_archive(base, "zip", root, "gustline")


def shipped(query: Query) -> Query:
    """Sends the package to the executors first, so that their Python finds it wherever it runs."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        if not any("gustline" in name for name in spark.sparkContext.listFiles):
            spark.sparkContext.addPyFile(_archive())
        return query(spark, folder)

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The fields of the tools, the short licence statements and the rules of the queries.
TOOL_FIELDS = [
    ("search", "query", "string", True),
    ("search", "turn", "integer", True),
    ("count", "n_chars", "integer", True),
    ("count", "query", "string", False),
    ("count", "turn", "integer", True),
    ("translate", "lang", "string", True),
    ("translate", "query", "string", True),
]
LICENSES = [
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
]
# Opening lines of widely used licences and of the headers that they ask for.
HEADERS = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");\n"
     "you may not use this file except in compliance with the License.\n"
     "You may obtain a copy of the License at\n"
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify\n"
     "it under the terms of the GNU General Public License as published by\n"
     "the Free Software Foundation, either version 3 of the License, or\n"
     "(at your option) any later version."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
     "of this software and associated documentation files (the \"Software\"), to deal\n"
     "in the Software without restriction, including without limitation the rights\n"
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
     "copies of the Software, and to permit persons to whom the Software is\n"
     "furnished to do so, subject to the following conditions:"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without\n"
     "modification, are permitted provided that the following conditions are met:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\n"
     "License, v. 2.0. If a copy of the MPL was not distributed with this\n"
     "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def tool_traffic(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made of a conversation table: each user turn calls a tool with its text, after the
    user turn before it, and the assistant's next turn is the result. Ids count within a conversation."""
    call = lambda back: F.concat(F.lit("call_"), (F.col("turn") - back).cast("string"))
    kind = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(3)) + 1
    name = F.element_at(F.array(*map(F.lit, ("search", "count", "translate"))), kind.cast("int"))
    arguments = F.to_json(F.struct("turn", F.col("text").alias("query"), F.length("text").alias("n_chars")))
    calls = turns.where("role = 'user'").select(
        "conv_id", call(0).alias("call_id"), F.when(F.col("turn") >= 2, call(2)).alias("parent_id"), name.alias("name"), arguments.alias("arguments")
    )
    results = turns.where("role = 'assistant'").select("conv_id", call(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op1_tool_linking(spark: SparkSession, folder: str) -> DataFrame:
    """Tool calls made of all turns of all conversations, linked, levelled, validated, serialised, in order."""
    calls, results = tool_traffic(table(spark, folder, "conversations"))
    schemas = spark.createDataFrame(TOOL_FIELDS, "name string, field string, kind string, required boolean")
    return chat.in_order(chat.link(calls, results, schemas))


def op2_bit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written bit-packed in id order and read back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return binary.round_trip(table(spark, folder, "documents"), tokenizer=path, end_id=2)


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: a third each in the directory of its language, of thousands and of hundreds of its
    id below its source; one of under 1,000 characters stands for a licence file of its directory."""
    id_, text = F.col("doc_id"), lambda column: column.cast("string")
    depth = F.pmod(F.coalesce(id_, F.lit(0)), F.lit(3))
    folders = [F.when(depth >= n, text(F.floor(id_ / size))) for n, size in ((1, 1000), (2, 100))]
    path = F.concat_ws("/", "source", "lang", *folders, F.concat(text(id_), F.lit(".txt")))
    return docs.select("doc_id", path.alias("path"), "text", (F.col("n_chars") < 1000).alias("is_license"))


def op3_license_inheritance(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of all documents, laid out as files in directories of several depths."""
    templates = spark.createDataFrame([*LICENSES, *HEADERS], "license string, text string")
    return licenses.scan(document_files(table(spark, folder, "documents")), templates, extra=["doc_id"])


def op4_log_likelihood_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, score and verdict of all documents."""
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, folder, "labels")))


def op5_redirect_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, folder, "pages"), rules)


def op6_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents. A source is an owner; its documents of one language are a repository."""
    return secrets.scan(table(spark, folder, "documents"), owner=F.col("source"), repo=F.concat_ws("/", "source", "lang"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of five-word shingles are similar to 0.8 or more."""
    return jaccard.groups(table(spark, folder, "documents"))


def op8_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of the benchmark in all documents."""
    return decontamination.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, folder, "documents"), tokenizer=path, end_id=0, capacity=CAPACITY)


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the 20-word passages that occur earlier."""
    return substring.dedup(table(spark, folder, "documents"))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Conversations with the faults of a bad scrape, dealt by a checksum of conversation and turn: a row
    goes, loses its text or its ends of sentences, stands twice, or gets the role of the user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", "turn", *(F.coalesce(c, space).alias(c) for c in ("role", "text")), (F.crc32(key.cast("binary")) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("fate") == 3, 2).otherwise(1).alias("copies"),
    )


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and checksum of all conversations."""
    turns = table(spark, folder, "conversations")
    done = structure.repair(damaged_turns(turns))
    every = turns.select("conv_id").distinct().withColumn("conv", structure.key_of(F.col("conv_id")))
    told = every.join(done.report.drop("conv_id"), "conv", "left").join(structure.digests(done.rows), "conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return told.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first four whitened components of all embeddings."""
    vectors = stage(whitening.whole_vectors(table(spark, folder, "embeddings")), "whole-vectors")
    model, fit = whitening.learn(vectors, components=COMPONENTS)
    rows = whitening.whitened(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*map(F.lit, model.explained.tolist())).cast("array<double>")
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.rows).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, "at").alias("explained"), F.lit(whitening.identity_error(fit, model)).alias("identity_error"),
    )


def op13_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, folder, "documents")
    model = passages.fit(docs, table(spark, folder, "labels"))
    return passages.score(docs, model).select("doc_id", passages.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_passages", "most_weight")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The stages of the corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {
    f.__name__: shipped(f)
    for f in (
        op1_tool_linking,
        op2_bit_packing,
        op3_license_inheritance,
        op4_log_likelihood_quality,
        op5_redirect_equivalence,
        op6_secret_ownership,
        op7_jaccard_join,
        op8_spaced_seeds,
        op9_harmonic_packing,
        op10_substring_dedup,
        op11_structure_repair,
        op12_embedding_whitening,
        op13_attention_quality,
        pipeline,
    )
}
ORACLES: dict[str, str] = {
    "op5_redirect_equivalence": oracles.url_rules(RULES, urls.DEFAULT),
    "op6_secret_ownership": oracles.secret_spans(secrets.MAX_OWNERS, secrets.MAX_REPOS),
    "op7_jaccard_join": oracles.jaccard(jaccard.SIZE, jaccard.PERCENT),
    "op10_substring_dedup": oracles.substrings(substring.SIZE),
    "op11_structure_repair": oracles.structure_repair(),
}
