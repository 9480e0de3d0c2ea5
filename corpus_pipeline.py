"""Documents to packed training sequences, stage by stage.

Each stage takes what the one before kept and returns the columns of `documents`, but for
the last, which returns the pieces of the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm.components import landed
from sluice.llm.cotraining import features_of, keep_good, lexicon_of, train
from sluice.llm.debruijn import dedup_substrings
from sluice.llm.decontaminate import contamination
from sluice.llm.minhash import keep_one_of_each
from sluice.llm.packing import pack, token_pieces
from sluice.llm.registry import query, table
from sluice.llm.tokens import vocabulary_path
from sluice.session import shared_folder

VOCABULARY = "byte_bpe_50k.json"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the co-trained quality classifier accepts."""
    labels = table(spark, sf_dir, "labels")
    lexicon = lexicon_of(docs, labels)
    return keep_good(docs, train(landed(features_of(docs, lexicon), "views"), labels, lexicon))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least, of each component of near duplicates (5-word shingles, 0.8)."""
    return keep_one_of_each(docs)


def distinct_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans of 13 words or more that an earlier one has.

    n_chars follows the text. Documents that lose all their words go; those without words
    on input stay.
    """
    own = {c: f"_own_{c}" for c in ("n_words", "n_removed")}
    cut = dedup_substrings(docs.withColumnsRenamed(own))
    kept = cut.where("n_removed = 0 OR n_removed < n_words")
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    sized = kept.withColumn("n_chars", size).drop(*own)
    return sized.withColumnsRenamed({there: here for here, there in own.items()}).select(docs.columns)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark. Rows of one key go together."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_gone")), "left_anti")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 2048 tokens."""
    return pack(token_pieces(docs, vocabulary_path(VOCABULARY)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("substrings", distinct_substrings),
    ("decontamination", clean_documents),
    ("packing", packed_sequences),
]

# A trained model, iterated components, token ids and a packing plan are beyond SQL.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
