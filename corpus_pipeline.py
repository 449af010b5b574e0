"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents (doc_id, text, lang, source, n_chars).  What a
stage returns is written as Parquet and read again as the next one's ``docs``.

Edge cases, for all stages: an empty table gives no rows; other columns of ``docs``
are dropped; what null and empty texts mean is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm.catalog import CAPACITY, MIX_MOST, MIX_SHARE, MIX_WEIGHTS, vocabulary
from demandlake.llm.mixing import mix
from demandlake.llm.packing import pack, token_pieces
from demandlake.llm.quality import quality_rules
from demandlake.llm.scratch import importable, written
from demandlake.llm.simhash import without_near_copies
from demandlake.llm.substring_dedup import without_substrings
from demandlake.llm.words import words_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  Null and empty texts fail the rules and go."""
    labels = importable(spark).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_rules(docs.select(COLUMNS), labels).where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (3-word shingles, 2 bits): that of the least id.

    Null and empty texts are copies of each other.  Rows without an id go where
    their group has one with an id.
    """
    return without_near_copies(docs.select(COLUMNS), shingle=3, radius=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words or more that occur twice or more.

    Where something goes, the words that stay are joined by one blank; other
    texts are untouched.  A document left without a word goes.
    """
    cut = without_substrings(docs.select(COLUMNS)).withColumn("kept", F.col("kept").cast("string"))
    out = cut.withColumn("text", F.coalesce("kept", "text")).where(F.size(words_of(F.col("text"))) > 0)
    return out.withColumn("n_chars", F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.char_length("kept")).cast("long")).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight: a document comes as often as the mix takes it (0 to 2 times).

    Repeated rows share their fate, each counted on its own; documents of equal hash
    (ties) go together.  Null ids and null sources are values like others.
    """
    docs = docs.select(COLUMNS)
    mixed = mix(docs, F.size(words_of(F.col("text"))), [F.col("doc_id"), F.xxhash64("text")], MIX_WEIGHTS, MIX_SHARE, MIX_MOST)
    return mixed.select(*COLUMNS, F.explode(F.array_repeat(F.lit(True), F.col("copies"))).alias("_")).drop("_")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 ids with their sequence and place.  A null text is empty: one end id.

    Repeated rows (what the mix took twice) have pieces and places of their own;
    pieces of equal id, number and content are interchangeable.
    """
    pieces = token_pieces(docs, vocabulary("word_bpe_49k.json"), CAPACITY)
    return pack(pieces, CAPACITY, ["doc_id", "piece", "ids_crc32"])


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", mixture),
    ("best-fit packing", packed),
]

#: Hashing, parsing and packing have no SQL form; tests/llm compares the first three stages row by row with
#: brute force, the mix with its targets and the packing with its capacity.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = importable(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{i}")
    return docs
