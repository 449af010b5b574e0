"""Operator 6: quality rules with a hashed n-gram log-likelihood ratio.

Word unigrams and bigrams are hashed into buckets.  Two multinomials over the
buckets, one of trusted texts and one of the raw corpus, give each bucket a log
ratio; a document's score is the mean ratio of its n-grams, less the level that
trusted documents reach which the target was not fitted on, and a fixed threshold
decides.  A few counted base rules go before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.functions.hof import let
from demandlake.llm.ordering import literal_list
from demandlake.llm.scratch import written
from demandlake.llm.words import BLANKS, words_of

BUCKETS = 1 << 16
#: One trusted document in so many is held out: the target is fitted on the others, the level on these.
HELD_OUT = 4
#: N-grams of the raw multinomial that are added to the target as its prior, for each of its own:
#: a ratio's least value, log(share / (1 + share)), then is the same for few trusted n-grams and for many.
PRIOR_SHARE = 0.1
#: Quantile of the held-out documents' mean log ratios that scores count from.
LEVEL = 0.05
#: Values of which a rank is read off at once; more are told apart by so many ranges first.
AT_ONCE, RANGES = 10_000, 1_024
#: A document that stays further below the level is rejected.
THRESHOLD = -0.12
#: Trusted ids are broadcast as bitmaps of MAP_SIZE bits (what bitmap_construct_agg makes), MAP_BITS for each id; with
#: more ids than MOST_MAPS (16 MB) hold, more texts are shuffled to be compared with the ids themselves.
MAP_SIZE, MAP_BITS, MOST_MAPS = 32_768, 8, 4_096
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def ngram_buckets(words: Column) -> Column:
    """Buckets of all unigrams, then of all bigrams."""

    def both(hs: Column) -> Column:
        n = F.size(hs)
        mask = F.lit(BUCKETS - 1)
        low = lambda h: h.bitwiseAND(mask).cast("int")
        pairs = F.zip_with(F.slice(hs, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(hs, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: low(F.xxhash64(a, b)))
        return F.concat(F.transform(hs, low), pairs)

    return let(F.transform(words, lambda w: F.xxhash64(w)), both)


def repeated_words(words: Column) -> Column:
    """Words inside WINDOW-word windows that occur twice or more in the text."""

    def count(win: Column) -> Column:
        order = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(srt: Column) -> Column:
            again = lambda x, k: F.when((x.h == F.get(srt, k - 1).h) | (x.h == F.get(srt, k + 1).h), x.i)
            starts = F.sort_array(F.filter(F.transform(srt, again), lambda i: i.isNotNull()))
            gap = lambda pos: F.aggregate(F.transform(pos, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(pos, k + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)
            return let(starts, gap)

        return F.when(F.size(F.array_distinct(win)) < F.size(win), let(order, covered)).otherwise(F.lit(0).cast("long"))

    def windows(hs: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(WINDOW)])
        return F.transform(F.sequence(F.lit(0), F.size(hs) - WINDOW), at)

    windowed = let(F.transform(words, lambda w: F.xxhash64(w)), lambda hs: let(windows(hs), count))
    return F.when(F.size(words) > WINDOW, windowed).otherwise(F.lit(0).cast("long"))


def base_counts(text: Column, words: Column) -> dict[str, Column]:
    """The counted columns of the base rules."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda xs: F.size(xs) - F.size(F.array_distinct(xs))).cast("long"),
        "n_repeat_words": repeated_words(words).cast("long"),
    }


def trusted_docs(labels: DataFrame) -> DataFrame:
    """Ids of all trusted documents (quality 1, not toxic)."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").cast("long").alias("_id")).distinct()


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(1)), F.lit(HELD_OUT)) == 0


def perhaps_trusted(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_doc, _text, _may) of every document; ``_may`` is true for all whose id is in ``trusted`` and for some others.

    The ids are hashed to bits, some MAP_BITS for each, in bitmaps small enough to
    broadcast; about one in MAP_BITS other documents meets a bit that is set.
    """
    maps = min(max(math.ceil(trusted.count() * MAP_BITS / MAP_SIZE), 1), MOST_MAPS)
    place = lambda c: F.pmod(F.xxhash64(c, F.lit(2)), F.lit(maps * MAP_SIZE))
    own = lambda p: F.floor(p / MAP_SIZE).cast("int")
    bits = trusted.select(place("_id").alias("place")).groupBy(own(F.col("place")).alias("_map")).agg(F.bitmap_construct_agg(F.col("place") % MAP_SIZE).alias("_bits"))
    thin = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text")).withColumn("_place", place("_doc"))
    found = thin.join(F.broadcast(written(bits, "quality-bits")), own(F.col("_place")) == F.col("_map"), "left")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_place") % MAP_SIZE / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = F.col("_doc").isNotNull() & (F.getbit(byte, (F.col("_place") % 8).cast("int")) == 1)
    return found.select("_doc", "_text", F.coalesce(may, F.lit(False)).alias("_may"))


def log_ratios(marked: DataFrame, fitted: DataFrame) -> DataFrame:
    """(bucket, ratio) for every bucket: log of target over raw probability; ``marked`` is of ``perhaps_trusted``.

    Raw counts cover all documents.  The target is smoothed towards the raw
    multinomial, so a bucket of which little is known has a ratio near that of
    one without any target count; without target counts all ratios are 0.
    Only texts that may be in ``fitted`` are shuffled to meet it.
    """
    asked = F.col("_may") & ~held_out(F.col("_doc"))
    own = marked.where(asked).join(fitted.withColumn("_t", F.lit(1)).hint("shuffle_hash"), F.col("_doc") == F.col("_id"), "left")
    texts = own.select("_text", F.coalesce(F.col("_t"), F.lit(0)).alias("t")).unionAll(marked.where(~asked).select("_text", F.lit(0).alias("t")))
    grams = texts.select("t", F.explode(ngram_buckets(words_of(F.col("_text")))).alias("bucket"))
    counts = written(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target")), "quality-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw, target = float(total.raw or 0) + BUCKETS, float(total.target or 0)
    prior = PRIOR_SHARE * target or 1.0
    every = counts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    p = (F.coalesce(F.col("raw"), F.lit(0)) + F.lit(1.0)) / F.lit(raw)
    q = (F.coalesce(F.col("target"), F.lit(0)) + F.lit(prior) * p) / F.lit(target + prior)
    return written(every.select("bucket", F.log(q / p).alias("ratio")), "quality-ratios")


def mean_ratio(words: Column, table: Column) -> Column:
    mean = lambda bs: F.aggregate(bs, F.lit(0.0), lambda acc, b: acc + F.get(table, b)) / F.greatest(F.size(bs), F.lit(1))
    return let(ngram_buckets(words), mean)


def quantile(values: DataFrame, q: float) -> float | None:
    """The exact quantile of the column ``m``, between its two ranks as ``percentile`` has it; None without values.

    ``percentile`` gathers all distinct values in one task.  Here the range of each
    rank is narrowed by counts of RANGES parts of it until at most AT_ONCE values are left.
    """
    whole = values.agg(F.min("m").alias("low"), F.max("m").alias("high"), F.count("m").alias("n")).first()

    def ranked(k: int) -> float:
        part, rows = whole, values
        while part.low < part.high and part.n > AT_ONCE:
            place = F.least(F.floor((F.col("m") - part.low) / (part.high - part.low) * RANGES), F.lit(RANGES - 1))
            parts = rows.groupBy(place.alias("place")).agg(F.min("m").alias("low"), F.max("m").alias("high"), F.count("m").alias("n")).collect()
            for part in sorted(parts):
                if k < part.n:
                    break
                k -= part.n
            rows = values.where(F.col("m").between(part.low, part.high))
        return part.low if part.low == part.high else sorted(r.m for r in rows.collect())[k]

    if not whole.n:
        return None
    at = (whole.n - 1) * q
    low, high = math.floor(at), math.ceil(at)
    first = ranked(low)
    return first if low == high else (high - at) * first + (at - low) * ranked(high)


def trusted_level(marked: DataFrame, held: DataFrame, table: Column) -> float | None:
    """Quantile LEVEL of the mean log ratios of held-out documents of MIN_WORDS words or more; None if there are none."""
    asked = marked.where(F.col("_may") & held_out(F.col("_doc")))
    own = asked.join(held.hint("shuffle_hash"), F.col("_doc") == F.col("_id"), "left_semi")
    words = own.select(words_of(F.col("_text")).alias("_words")).where(F.size("_words") >= MIN_WORDS)
    return quantile(written(words.select(mean_ratio(F.col("_words"), table).alias("m")), "quality-means"), LEVEL)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``score`` and ``kept`` added (clashing columns are replaced).

    Base rules: fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT of
    the words in repeated windows, fail.  Others are kept if their score (mean
    log ratio of all their n-grams, less the level of the held-out trusted
    documents) reaches THRESHOLD.  Null or empty text: no words, fails.  No
    trusted labels, or so few that none is held out or none is left to fit on:
    all scores are 0, so only the base rules decide.  Repeated rows are judged
    alike.  Empty table: no rows.
    """
    trusted = written(trusted_docs(labels), "quality-trusted")
    marked = perhaps_trusted(docs, trusted, id_col, text_col)
    ratios = log_ratios(marked, trusted.where(~held_out(F.col("_id"))))
    # BUCKETS numbers, whatever the size of the corpus; the text form is folded into one array constant.
    table = literal_list([f"{r.ratio:.6f}" for r in sorted(ratios.collect())]).cast("array<double>")
    level = trusted_level(marked, trusted.where(held_out(F.col("_id"))), table)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    out = docs.drop(*added).withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("_words", words_of(F.col(text_col)))
    out = out.withColumns(base_counts(F.col("_text"), F.col("_words")))
    out = out.withColumn("score", F.lit(0.0) if level is None else mean_ratio(F.col("_words"), table) - F.lit(level))
    failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(THRESHOLD))).drop("_text", "_words")
