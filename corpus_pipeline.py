"""The corpus pipeline: documents through five stages, each written and read again before the next.

Each stage works on all rows of its predecessor, carries every column along whatever its name, and of an empty
table makes an empty one. A text is always read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import decontaminate, line_dedup, near_copies as copies, packing, quality_rules
from lamina.llm.common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (op 10): documents that the rules reject go, and from the others the lines above a host's limits.

    Null, empty and blank texts have under ten words and go; a null source is a host of its own; repeated rows
    share one verdict.
    """
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (op 8): later occurrences of three-line windows go from the texts.

    The first occurrence, which stays, is the one of the smallest doc_id (null first), then text, then place; rows
    equal in both keep the same lines. A document may lose all its lines; it stays, with an empty text, and the
    next stage leaves one such document.
    """
    return line_dedup.rewrite(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (op 7) on five-word shingles, links verified at an exact Jaccard similarity of 0.8.

    Of each group the document of the smallest doc_id stays (null last; of equal ids the smallest text hash; of
    equal rows one). Null, empty and blank texts have no words and are one group.
    """
    return copies.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (op 6): documents with a window of a benchmark item go.

    Null and empty texts have no words and stay; repeated rows stay or go together; items without words match nothing.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (op 5): the pieces of the documents and their places in the sequences.

    A null text is an empty one, of the end id alone; repeated rows are packed as rows of their own; ties in size
    are packed in the order of the rows.
    """
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", sequences),
]
#: SQL has no SimHash components, token ids or packing; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
