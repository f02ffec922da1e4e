"""The corpus pipeline: stages over ``documents``, each calling one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of ``documents``:

1. quality rules: documents that the rules reject go;
2. exact dedup: of equal texts the row with the largest id stays;
3. near dedup: of each group of near-duplicates (similarity ``NEAR_PERCENT``
   hundredths or more) one document stays;
4. mixing: sources meet their target weights; a document stands as often as
   the mix takes it, so up to twice, and goes if the mix does not take it;
5. best-fit packing: the pieces of the mix, with their sequence and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vecdex.llm import exact_dedup, minmax_dedup, mixing, packing, quality_rules
from vecdex.session import drop_scratch, scratch_mark, scratch_path
from vecdex.sources.tables import table

#: similarity from which documents are near duplicates, in hundredths
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minmax_dedup.without_near_duplicates(docs, percent=NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers may still hold what the stage before remembers, so less is kept here
    return packing.pack(packing.document_pieces(docs, known=700_000))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near),
          ("mixing to target weights", mix), ("best-fit packing", pack)]

#: streaming state, min-max hashing and minimum bin slack have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table. What a stage leaves in the
    scratch folder, its input among it, goes once its output is written."""
    docs = table(spark, sf_dir, "documents")
    mark = scratch_mark()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch_path(spark, f"stage{k + 1}")
            docs.write.parquet(path)
            drop_scratch(spark, mark, keep=(path,))
            docs = spark.read.parquet(path)
    return docs
