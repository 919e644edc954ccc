"""The corpus pipeline: ``documents`` in, packed training sequences out.

Five stages, each one of the operators of ``quillstream.llm``; each takes
``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the
last return the columns of ``documents``:

1. ``toxicity``: documents scored toxic are rejected;
2. ``near_dedup``: one document of each group of near duplicates stays;
3. ``unit_dedup``: repeated sentences and lines are cut out of the texts;
4. ``decontaminate``: documents with benchmark items in them are dropped;
5. ``pack``: pieces of at most 2048 tokens and their places in sequences.

Cases: a null text is empty and stays (a class of its own with other texts without
words); a null ``doc_id`` is kept and ranks last; repeated rows are copies, of which
one stays; among near duplicates the smallest ``doc_id`` stays, among its equal rows
one; long texts are read whole; an empty table gives no rows. Other columns pass
through; ``score`` and names that start with an underscore are the stages' own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm import decontam, linededup, minhash, packing, toxicity
from quillstream.llm.queries import ready
from quillstream.session import shared_dir
from quillstream.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL can express neither the scores nor the signatures; tests compare with brute force.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return minhash.keep_one(docs).select(*docs.columns)


def unit_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    cut = linededup.dedup_units(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"])).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_dedup", near_dedup),
    ("unit_dedup", unit_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder."""
    ready(spark)
    folder = shared_dir(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
