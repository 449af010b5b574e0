"""Operator 12: spelling variant grouping.

Words are counted over all texts; near words (one letter inserted, deleted or
replaced) are found by an FM index of the vocabulary: with one error, either half of
a query is met exactly, so it is matched first and extended across the other half.
The vocabulary is dealt by such halves, and a query goes where words with its half
lie; each task indexes one bounded shard.  A half that very many words share is dealt
over several shards, to each of which its queries go.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.arrow_groups import grouped_tables
from demandlake.llm.fm_index import FMIndex
from demandlake.llm.scratch import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words of which a task keeps counts before it hands them on (some 80 MB).
KEPT = 400_000
#: Words of one shard's index, and queries searched at once.
SHARD = 40_000
QUERIES = 20_000


def word_counts(docs: DataFrame, min_length: int, drop_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the runs of letters of all texts (A-Z lower-cased) that have ``min_length`` code points.

    ``drop_every``: where it divides h, the crc32 of '<id>:<run>', the run loses its
    code point h % length; a null id counts as an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = Counter(w for w in RUN.findall((text.as_py() or "").encode().lower().decode()) if len(w) >= min_length)
                if drop_every:
                    head = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                    for w, n in own.items():
                        h = zlib.crc32(w.encode(), head)
                        if h % drop_every == 0:
                            w = w[: h % len(w)] + w[h % len(w) + 1 :]
                        counts[w] += n
                else:
                    counts.update(own)
                if len(counts) > KEPT:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    def _counted(counts: Counter[str]) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= min_length]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    parts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in grouped_tables(batches, "shard"):
        kind, word = t["kind"].to_numpy(), t["word"].to_pylist()
        indexed = sorted({w for w, k in zip(word, kind) if k == 0})
        if not indexed:
            continue
        index = FMIndex(indexed)
        for half in (1, 2):
            asked = sorted({w for w, k in zip(word, kind) if k == half}, key=len)
            for at in range(0, len(asked), QUERIES):
                some = asked[at : at + QUERIES]
                q, w = index.one_error(some, half == 1)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()).take(pa.array(q)), pa.array(indexed, pa.string()).take(pa.array(w))], names=["word", "near"])


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near), once each and in both directions, for the distinct words of ``vocabulary.word``."""
    word, length = F.col("word"), F.char_length("word")
    half = F.floor(length / 2)

    def key(side: str, part: Column) -> Column:
        return F.xxhash64(F.lit(side), part)

    head = lambda n: key("head", F.substring(word, F.lit(1), n))
    tail = lambda n: key("tail", F.substring(word, length - n + 1, n))
    # A near query is one shorter, as long or one longer: its halves have these lengths.
    heads = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor((length + k) / 2)))
    tails = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.ceil((length + k) / 2)))
    indexed = vocabulary.select("word", F.explode(F.concat(F.transform(heads, lambda n: head(n.cast("int"))), F.transform(tails, lambda n: tail(n.cast("int"))))).alias("key"))
    asked = vocabulary.select("word", F.explode(F.array(F.struct(head(half.cast("int")).alias("key"), F.lit(1).alias("kind")), F.struct(tail((length - half).cast("int")).alias("key"), F.lit(2).alias("kind")))).alias("q")).select("word", "q.*")
    held = written(indexed.groupBy("key").agg(F.count(F.lit(1)).alias("held")), "spelling-keys")
    total = held.agg(F.sum("held")).first()[0] or 0
    shards = max(total // SHARD, 1)
    # A key of more than a quarter shard is dealt over parts of its own.
    parts = held.where(F.col("held") > SHARD // 4).select("key", F.ceil(F.col("held") / (SHARD // 4)).cast("int").alias("parts"))
    shard = lambda part: F.when(F.col("parts").isNull(), F.pmod(F.col("key"), F.lit(shards))).otherwise(F.lit(shards) + F.pmod(F.xxhash64("key", part), F.lit(4 * shards + 1)))
    placed = indexed.join(parts, "key", "left").select(shard(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")).alias("shard"), F.lit(0).alias("kind"), "word")
    goes = asked.join(parts, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)))))
    dealt = placed.unionAll(goes.select(shard(F.col("part")).alias("shard"), "kind", "word")).distinct()
    found = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(_search, "word string, near string")
    return found.distinct()


def spelling_variants(counts: DataFrame, min_count: int = 5, dominance: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of ``counts`` (word, n) with at least ``min_count``.

    Two words are near if they differ by one inserted, deleted or replaced code point.
    A word's form is its near word of largest n (ties: the smallest in code-point
    order), if that n is at least ``dominance`` (2 or more) times its own, else null;
    ``root`` follows the forms to the last.  Null words are left out, repeated ones
    are added up; an empty table gives no rows; other columns are ignored.
    """
    vocabulary = written(counts.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "spelling-words")
    pairs = near_words(vocabulary.select("word")).join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("near_n").alias("near_n"), F.min_by("near", F.struct(-F.col("near_n"), F.col("near"))).alias("near"))
    is_form = F.col("near_n") >= dominance * F.col("n")
    judged = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    judged = written(judged, "spelling-forms")
    roots = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # n grows by ``dominance`` with every form, so chains are short; each round doubles what is followed.
    while roots.join(roots.select(F.col("word").alias("root")), "root", "left_semi").limit(1).count():
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(roots.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
