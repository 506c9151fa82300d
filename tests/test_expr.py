"""Edge rows for the column expressions (NULL, zero denominators, exact bin
edges, ties, half-way rounding)."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabstack.functions import expr as E


def _rows(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def test_safe_div_edges(spark):
    df = _rows(spark, "a double, b double", [(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None),
                                            (0.0, 0.0), (float("inf"), 1.0), (-3.0, 4.0)])
    got = [r[0] for r in df.select(E.safe_div("a", "b")).collect()]
    assert got == [0.5, 0.0, 0.0, 0.0, 0.0, 0.0, -0.75]


def test_bucketize_right_closed_exact_edges(spark):
    edges = [-0.01, 0.1, 0.3, 0.6, 0.9, float("inf")]
    vals = [0.0, 0.1, 0.1000001, 0.3, 0.6, 0.9, 0.95, 5.0, None, -0.5]
    df = _rows(spark, "x double", [(v,) for v in vals])
    got = [r[0] for r in df.select(E.bucketize("x", edges)).collect()]
    ref = pd.cut(pd.Series(vals, dtype=float), bins=edges, labels=False)
    exp = [None if (isinstance(v, float) and math.isnan(v)) else int(v) for v in ref]
    assert got == exp


def test_round_half_even_matches_numpy(spark):
    vals = [7.125, 2.675, 1.005, 4.985, 35.995, 12.5, -7.125, 0.125]
    df = _rows(spark, "x double", [(v,) for v in vals])
    got = [r[0] for r in df.select(E.round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]
    assert got[0] == 7.12


def test_argmax_ties_lowest_index(spark):
    df = _rows(spark, "p array<double>", [([0.2, 0.4, 0.4, 0.0, 0.0],), ([0.5, 0.1, 0.1, 0.1, 0.5],),
                                          ([0.1, 0.1, 0.1, 0.1, 0.6],)])
    got = [r[0] for r in df.select(E.argmax_class("p")).collect()]
    assert got == [1, 0, 4]


def test_clip_keeps_null_and_flag_reads_null_as_zero(spark):
    df = _rows(spark, "x double", [(None,), (40.0,), (1.0,)])
    r = df.select(E.clip("x", 4.99, 35.99).alias("c"), E.flag("x", "<", 24).alias("f")).collect()
    assert [x.c for x in r] == [None, 35.99, 4.99]
    assert [x.f for x in r] == [1, 0, 1]  # NULL -> 0 -> 0 < 24


def test_strings_and_coercion(spark):
    df = _rows(spark, "s string", [(" own ",), (None,), ("rent",), ("Mortgage",), ("12.5",), ("",)])
    r = df.select(E.str_contains_flag("s", "OWN|MORTGAGE").alias("own"),
                  E.str_not_in_flag("s", ["NONE", "NAN", "NA", ""]).alias("has"),
                  E.coerce_numeric("s").alias("num")).collect()
    assert [x.own for x in r] == [1, 0, 0, 1, 0, 0]
    assert [x.has for x in r] == [1, 0, 1, 1, 1, 0]
    assert [x.num for x in r] == [0.0, 0.0, 0.0, 0.0, 12.5, 0.0]


def test_probability_helpers(spark):
    df = _rows(spark, "p array<double>", [([1.0, 1.0, 2.0, 0.0, 0.0],)])
    r = df.select(E.expected_class("p").alias("e"), E.row_normalise("p").alias("n"),
                  E.round_to_class(F.lit(2.5)).alias("c"), E.one_hot(F.lit(3)).alias("o")).collect()[0]
    assert r.e == 1.0 * 1 + 2.0 * 2
    assert r.n == [0.25, 0.25, 0.5, 0.0, 0.0]
    assert r.c == 2  # half to even
    assert r.o == [0.0, 0.0, 0.0, 1.0, 0.0]
