"""Operator 9: homomorphic multiset fingerprints of documents.

Each paragraph piece is hashed to a wide vector; a document's fingerprint is the
sum of its pieces' vectors modulo a power of two.  The sum forgets the order, so
equal multisets have equal fingerprints, and pieces can be added or taken away
without the rest of the text.  Part of the vector consists of single hash bits
packed into lanes: read as +1/-1 sums, the lanes of two fingerprints estimate how
much of the two multisets agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.functions.hof import let
from demandlake.llm.ordering import hash_key, hex_key, literal_list, range_of, sampled_splitters
from demandlake.llm.scratch import written

#: Pieces end at a line break, or at the blank after a sentence.
PIECE_END = r"\n+|(?<=[.!?])[ ]+"
#: Every component is kept modulo 2**60, so a sum never passes a long.
MODULUS_BITS = 60
MASK = (1 << MODULUS_BITS) - 1
#: Hashes of a piece: all give a full-width component; the first LANE_HASHES also give their bits to lanes.
HASHES, LANE_HASHES = 4, 2
#: Lanes of one packed component, and bits of a lane.  A text ends at 2**31 bytes and a piece takes
#: two with its end, so no text sets a bit of a lane 2**LANE_BITS times.
PACK, LANE_BITS = 2, 30
LANES = sum(1 << (LANE_BITS * k) for k in range(PACK))
#: Components: number of pieces, full-width sums, packed lanes.
WIDTH = 1 + HASHES + LANE_HASHES * LANE_BITS
ROWS_PER_RANGE = 2_000
MAX_RANGES = 20_000


def _lanes(h: Column, shifts: Column) -> Column:
    return F.transform(shifts, lambda k: F.call_function("shiftrightunsigned", h, k).bitwiseAND(F.lit(LANES)))


def _piece_vector(hashes: Column) -> Column:
    shifts = F.array(*[F.lit(k) for k in range(LANE_BITS)])
    packed = [_lanes(F.get(hashes, F.lit(i)), shifts) for i in range(LANE_HASHES)]
    return F.concat(F.array(F.lit(1).cast("long"), *[F.get(hashes, F.lit(i)).bitwiseAND(F.lit(MASK)) for i in range(HASHES)]), *packed)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint vector of the pieces of both (sign 1), or of ``a`` without those of ``b`` (sign -1)."""
    return F.zip_with(a, b, lambda x, y: (x + y if sign > 0 else x - y + F.lit(MASK + 1)).bitwiseAND(F.lit(MASK)))


def fingerprint_vector(text: Column) -> Column:
    """The summed vector of a text's pieces (array of WIDTH longs); null and '' give zeros."""
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), PIECE_END, -1), lambda p: p != "")
    hashes = F.transform(pieces, lambda p: F.array(*[F.xxhash64(p, F.lit(i)) for i in range(HASHES)]))
    zeros = F.array_repeat(F.lit(0).cast("long"), WIDTH)
    return F.aggregate(hashes, zeros, lambda acc, h: combine(acc, _piece_vector(h)))


def fingerprint_text(vector: Column) -> Column:
    """The whole vector as lower-case hex, 15 digits for each component."""
    return F.array_join(F.transform(vector, lambda x: F.lower(F.lpad(F.hex(x), 15, "0"))), "")


def text_vector(fingerprint: Column) -> Column:
    """The vector of a ``fingerprint_text``: what ``combine`` and ``likeness`` take."""
    digits = lambda i: F.substring(fingerprint, i * 15 + 1, F.lit(15))
    return F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda i: F.conv(digits(i), 16, 10).cast("long"))


def _signed(vector: Column) -> Column:
    """The lanes as sums of +1/-1: twice the set bits less the number of pieces."""
    packed = F.slice(vector, 2 + HASHES, LANE_HASHES * LANE_BITS)
    lane = F.lit((1 << LANE_BITS) - 1)
    return F.flatten(F.transform(packed, lambda x: F.array(*[F.shiftrightunsigned(x, LANE_BITS * k).bitwiseAND(lane) * 2 - F.get(vector, 0) for k in range(PACK)])))


def _squares(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common pieces (Dice), 0 to 1: 1 - |a - b|^2 / (|a|^2 + |b|^2) over the lanes.

    The squared length of a +1/-1 sum estimates the number of pieces behind it
    (each of the 120 lanes adds an unbiased guess).  1 for equal fingerprints only.
    """

    def measured(p):
        x, y = F.get(p, 0), F.get(p, 1)
        apart = _squares(F.zip_with(x, y, lambda u, v: u - v))
        return F.greatest(F.lit(0.0), F.least(F.lit(0.999999), F.lit(1.0) - apart / (_squares(x) + _squares(y))))

    near = let(F.array(_signed(a), _signed(b)), measured)
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(near, F.lit(0.0)))


def with_next(rows: DataFrame, id_col: str, tie: Column, columns: list[str]) -> DataFrame:
    """``rows`` with ``next_<c>`` of the row that follows in descending ``id_col`` (after the last: the first).

    One exchange: sampled splitters deal the rows into ranges of about
    ROWS_PER_RANGE; the first row of each range also goes, as a halo, to the
    range before, so each range knows its successors.  Null ids come last; equal
    ids go by ``tie``.  A single row follows itself.
    """
    # Each digit complemented: text order is then descending id order.
    down = F.translate(hex_key(F.col(id_col)), "0123456789ABCDEF", "FEDCBA9876543210")
    key = F.concat(F.when(F.col(id_col).isNull(), F.lit("~")).otherwise(down), hash_key(tie))
    keys = written(rows.select(key.alias("k")), "next-keys")
    n = keys.count()
    parts = min(MAX_RANGES, -(-n // ROWS_PER_RANGE))
    splitters = sampled_splitters(keys, "k", F.lit(1), n, parts, 7)
    heads = {r["r"]: r["k"] for r in keys.groupBy(range_of(F.col("k"), splitters).alias("r")).agg(F.min("k").alias("k")).collect()}
    full = sorted(heads)
    before = {r: full[i - 1] for i, r in enumerate(full)}  # the first range's head follows the last range
    count = len(splitters) + 1
    head = F.get(literal_list([heads.get(r, "") for r in range(count)]), F.col("_range"))
    to = F.get(literal_list([str(before.get(r, r)) for r in range(count)]).cast("array<int>"), F.col("_range"))
    dealt = rows.withColumn("_key", key).withColumn("_range", range_of(F.col("_key"), splitters))
    copies = F.when(F.col("_key") == head, F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("halo")), F.struct(to.alias("r"), F.lit(True).alias("halo"))))
    dealt = dealt.withColumn("_at", F.explode(copies.otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("halo"))))))
    dealt = dealt.drop("_range").withColumn("_range", F.col("_at.r")).withColumn("_halo", F.col("_at.halo")).drop("_at")
    window = Window.partitionBy("_range").orderBy("_halo", "_key")
    out = dealt.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
    return out.where(~F.col("_halo")).drop("_halo", "_key", "_range")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they come.

    The edited text has the last floor(n_chars / 3) code points replaced by as
    many of the next document's first (all, if it has fewer), next in descending
    id, after the last the first.  Null text: empty (fingerprint zero); two empty
    texts are equal, likeness 1.  Repeated rows each follow one another.  Empty
    table: no rows.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chained = with_next(rows.withColumn("vec", fingerprint_vector(F.col("text"))), "doc_id", F.col("text"), ["text", "vec"])
    cut = F.floor(F.char_length("text") / 3).cast("int")
    chained = chained.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.char_length("text") - cut), F.substring("next_text", F.lit(1), cut))
    ).drop("text", "next_text")
    out = chained.withColumn("evec", fingerprint_vector(F.col("edited")))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("vec")).alias("fingerprint"), fingerprint_text(F.col("evec")).alias("edited_fingerprint"),
        likeness(F.col("vec"), F.col("evec")).alias("near_edited"), likeness(F.col("vec"), F.col("next_vec")).alias("near_next"),
    )
