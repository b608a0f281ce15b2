"""A corpus pipeline over ``documents``: five stages, each one corpus operator.

Every stage works on all rows its predecessor kept and its decisions take
effect; stages but the last return the columns of ``documents`` (whatever other
columns come in) with ``n_chars`` up to date.  An empty table stays empty; null
sources and languages are kept as they are; what else holds for odd rows is
said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from slotwise.llm.common import fold, table
from slotwise.session import scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity score rejects (0.5 or more) go.

    Row by row: repeated rows share their fate; a null or empty text has no
    word to be rejected for; rows without an id are scored but teach nothing.
    """
    model = toxicity.train(docs, toxicity.learn_from(table(spark, sf_dir, "labels"), fold("doc_id", 5) == 0))
    return toxicity.score(docs, model).filter(F.col("predicted") == 0).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more in five documents or more stay in one; no document goes.

    A null text becomes the empty one (no line to keep).  Rows of one id are one
    document, whose lines are counted once; a null id is one document, too.
    """
    done = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return (done.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.char_length("text").cast("long"))
                .select(*COLUMNS))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one of the least id.

    A null id counts as the least; of ids that tie, the least text hash; of
    repeated rows any one.  Texts without a word are in a class only with equal
    texts.
    """
    return near_dedup.one_of_each(docs).select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null, empty or wordless texts and items match nothing; repeated rows share
    their fate; an empty benchmark leaves all rows.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words without two documents of one source or with equal texts.

    Every row is packed, repeated rows each; a null text has length 0; null
    sources keep no one apart; texts longer than a bin are cut into full bins
    and a rest.
    """
    return packing.pack(packing.measured(docs))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_shared_lines), ("near dedup", keep_one_of_each),
          ("benchmark", drop_benchmark), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; every result but the last is written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = scratch(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{k}")
            docs = spark.read.parquet(f"{base}/{k}")
    return docs
