"""Lower-casing by search gives what it gave by rune."""

from pyspark.sql import functions as F

from wordmill.functions import text as tx

TEXTS = ["The CAT, the cat", None, "", "ΌΣΟΣ Σ İstanbul i̇ Straße é", "a_b 9\x0bx\r\ny --z"]


def test_lower_case_by_search(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    by_rune = F.lower(F.translate("text", tx.CONTEXT_FREE_LOWER_FROM, tx.CONTEXT_FREE_LOWER_TO))
    for r in rows.select(tx.lower_runes(F.col("text")).alias("a"), by_rune.alias("b")).collect():
        assert r.a == r.b
    plan = rows.select(tx.lower_runes(F.col("text")))._jdf.queryExecution().toString()
    assert "translate" not in plan
