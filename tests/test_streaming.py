"""A fitted (batch) target encoding applied to a stream gives the same rows
as the batch transform."""


from tabstack.operators.encode import apply_target_stats, fit_target_stats
from tabstack.session import scratch_path
from tabstack.sources.tables import read_table
from tabstack.streaming.score import read_table_stream, score_stream

from testdata_paths import SF001


def test_stream_scoring_matches_batch(spark):
    orders = read_table(spark, SF001, "orders")
    st = fit_target_stats(orders, ["o_orderpriority"], "o_totalprice", fold=None, m=20.0)

    def transform(df):
        return apply_target_stats(df.select("o_orderkey", "o_orderpriority"), st, fold=None)

    out = scratch_path(spark, "stream-out")
    score_stream(read_table_stream(spark, SF001, "orders", orders.schema), transform, out)
    got = spark.read.parquet(out).select("o_orderkey", "o_orderpriority_te")
    exp = transform(orders).select("o_orderkey", "o_orderpriority_te")
    assert got.count() == exp.count() == orders.count()
    assert got.exceptAll(exp).count() == 0
