"""op5 over vectors of one component, against brute force."""

from pyspark.sql import functions as F

from ledgerlark.llm import vector_search


def test_vectors_of_one_component(spark):
    values = {i: float((i * 37) % 101 - 50) for i in range(120)}
    rows = [(i, [v]) for i, v in values.items()] + [(500, [1.0, 2.0]), (501, []), (502, None), (503, [None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_search.search(spark, df, F.col("id") % 20 == 0, vec_id="vec_id", vector="embedding").collect()
    taking = {i: v for i, v in values.items() if v}
    for q in (i for i in taking if i % 20 == 0):
        want = sorted(((-taking[q] * v, i) for i, v in taking.items() if i != q))[:20]
        got = [(-r.score, r.vec_id) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
        assert got == want
