"""The corpus pipeline: language ID, near-duplicates, benchmark
decontamination, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontam, langid, neardup, packing, pseudonyms
from daybook.llm.common import table, written


#: Documents whose best language is less likely than this are rejected.
MIN_SCORE = 0.5


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no clear language.  The
    model learns from the documents' own ``lang``, without the held-out rows."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    judged = langid.predict(docs, model)
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class: the least doc_id."""
    return neardup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth or more."""
    return decontam.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in the text; ``n_chars`` follows the new text."""
    done = pseudonyms.pseudonymise(docs, kinds_col=None)
    return done.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length-bucketed batches: one row per piece of a document."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language-id", identify),
    ("near-duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("pseudonyms", pseudonymise),
    ("packing", pack),
]

#: Language ID learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    """The result of all stages over the ``documents`` of ``sf_dir``.

    The last stage says where every piece of a text goes; the text itself is
    the result of the stage before.  With ``out``, every stage's result is a
    Parquet table of that folder named like the stage, so the prepared text is
    ``out``/pseudonyms; an existing table there is an error."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", path=out and f"{out.rstrip('/')}/{name}")
    return docs
