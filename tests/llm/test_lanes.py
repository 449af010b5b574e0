from pyspark.sql import functions as F

from demandlake.llm.fingerprints import fingerprint_vector, likeness


def test_likeness_of_very_many_pieces(spark):
    one = "\n".join(f"line {i}" for i in range(100_000))
    other = "\n".join(f"row {i}" for i in range(100_000))
    half = "\n".join(f"{'line' if i % 2 else 'row'} {i}" for i in range(100_000))
    rows = [("unlike", one, other), ("half", one, half), ("repeated", "a line\n" * 40_000, "some other\n" * 40_000), ("mostly", "a line\n" * 40_000, "a line\n" * 39_000 + "some other\n" * 1_000)]
    vectors = spark.createDataFrame(rows, "k string, x string, y string").repartition(4).select("k", fingerprint_vector(F.col("x")).alias("x"), fingerprint_vector(F.col("y")).alias("y"))
    got = {r["k"]: r["near"] for r in vectors.select("k", likeness(F.col("x"), F.col("y")).alias("near")).collect()}
    assert got["unlike"] < 0.3 and abs(got["half"] - 0.5) < 0.2, got
    assert got["repeated"] < 0.3 and got["mostly"] > 0.9, got
