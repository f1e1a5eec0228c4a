import math

from pyspark.sql import functions as F

from martflow.llm import mixing as M


def test_poisson_table_is_the_distribution():
    for mean in (0.0, 0.3, 1.0, 7.5, 64.0):
        cdf = M.poisson_table(mean)
        p = [math.exp(-mean) * mean ** k / math.factorial(k) for k in range(min(len(cdf), 150))]
        for k, c in enumerate(cdf[:150]):
            assert abs(c - sum(p[:k + 1])) < 1e-12
        assert cdf == sorted(cdf) and cdf[-1] > 1 - 1e-12


def test_weights_are_met(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "CASE WHEN id < 20000 THEN 'big' WHEN id < 29900 THEN 'mid' END AS source", "'t' AS text")
    got = {r.source: r["count"] for r in M.mixture(df, weights={"big": 1, "mid": 2, None: 1}).groupBy("source").count().collect()}
    for source, share in (("big", 0.25), ("mid", 0.5), (None, 0.25)):
        assert abs(got[source] / 30_000 - share) < 0.02
    again = {r.source: r["count"] for r in M.mixture(df.repartition(7), weights={"big": 1, "mid": 2, None: 1}).groupBy("source").count().collect()}
    assert again == got
    assert {r.source for r in M.mixture(df, weights={"mid": 1}).select("source").distinct().collect()} == {"mid"}


def test_rates_are_the_same_in_every_partitioning(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "concat('s', id * id % 307) AS source")
    weights = {f"s{i}": 1e-9 * (1 + i % 17) / 3 for i in range(307)}
    for how in ({}, {"weights": weights}, {"size": F.col("doc_id") / 7}):
        first = {r.source: (r.size, r.rate) for r in M.rates(df.repartition(1), **how).collect()}
        assert sum(x * y for x, y in first.values()) > 0
        for n in (2, 7, 13):
            assert {r.source: (r.size, r.rate) for r in M.rates(df.repartition(n), **how).collect()} == first


def test_counts_are_poisson(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'s' AS source")
    n = {r.doc_id: r["count"] for r in M.replicated(df, total=30_000.0).groupBy("doc.doc_id").count().collect()}
    counts = [n.get(i, 0) for i in range(20_000)]
    mean = sum(counts) / 20_000
    assert abs(mean - 1.5) < 0.05 and abs(sum((c - mean) ** 2 for c in counts) / 20_000 - 1.5) < 0.1
    many = M.replicated(spark.range(50).selectExpr("id AS doc_id", "'s' AS source"), total=50 * 300.0).count()
    assert abs(many / 50 - 300) < 15


def test_order_and_odd_rows(spark):
    df = spark.createDataFrame([(1, "s", None, "a"), (1, "s", None, "a"), (None, None, "", "b"), (2, "s", "x" * 100_000, "c")],
                               "doc_id long, source string, text string, replica string")
    rows = M.mixed(df, weights={"s": 1, None: 1}, total=400.0).collect()
    keys = [r.shuffle_key for r in rows]
    assert keys == sorted(keys)
    out = M.mixture(df, total=400.0)
    assert out.columns == df.columns
    one = out.groupBy("doc_id").count().collect()
    assert {r.doc_id for r in one} == {1, 2, None} and {r.doc_id: r["count"] for r in one}[1] % 2 == 0
    assert M.mixture(df.limit(0)).count() == 0 and M.mixture(df, weights={}).count() == 0


def test_oracle(spark, sf_small):
    import duckdb
    from martflow.llm.queries import QUERIES
    from martflow.llm.sql import ORACLE
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, source, text, replica, shuffle_key FROM ({ORACLE['op6_mixing']})").fetchall(), key=str)
    got = sorted((tuple(r) for r in QUERIES["op6_mixing"](spark, sf_small).select("doc_id", "source", "text", "replica", "shuffle_key").collect()), key=str)
    assert got == want
