"""Derived fixtures: tables Spark builds from the input tables, each with a
DuckDB twin (a CTE) used by the oracle SQL.

* ``acct``       one row per customer, stands in for the applicant table
                 (labels ``tier`` 0..4 and ``rate`` in [4.99, 35.99]).
* ``acct_folds`` ``acct`` + stratified 5-fold column on train rows.
* ``acct_pred``  ``acct_folds`` + deterministic stand-in predictions of five
                 models (class probabilities and a rate), so blending, metrics
                 and pseudo-labels can be checked exactly.
* ``doc_semi``   documents left join labels (part labelled).
* ``vec``        embeddings + stratified folds + train/test split.
* ``line``       lineitem at bench scale.
* ``pairs``      lineitem x part x supplier (category pairs).

Money sums go through DECIMAL(18,2) so both engines add exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstack.operators.folds import assign_folds_stratified
from tabstack.session import cut_lineage
from tabstack.sources.tables import read_table

_MEMO: dict = {}


def _materialised(name: str, spark: SparkSession, sf_dir: str, build) -> DataFrame:
    """Build once per session and input folder, written to the shared
    checkpoint folder (lineage cut), like a prediction table read from the
    OOF store.  Stand-in predictions are 25 generated expressions; without the
    cut, Catalyst would inline all of them into every blend expression."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = cut_lineage(build())
    return _MEMO[key]

SEED = 42
N_FOLDS = 5
N_MODELS = 5
N_CLASSES = 5

# fixed values: multipliers of the stand-in class scores (model m, class k)
# and offsets of the stand-in rate errors; any distinct primes would do.
SCORE_MULT = [[3, 5, 7, 11, 13], [17, 19, 23, 29, 31], [37, 41, 43, 47, 53],
              [59, 61, 67, 71, 73], [79, 83, 89, 97, 101]]
TRUE_CLASS_BONUS = [40, 55, 70, 85, 100]
RATE_MULT = [7, 11, 13, 17, 19]


def _dec(c):
    return F.col(c).cast("decimal(18,2)")


# ------------------------------------------------------------------ acct

def acct(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    # pre-aggregate orders per customer before the join (partial aggregation
    # absorbs a customer holding a large share of orders); the aggregate is
    # hash-partitioned by o_custkey, which the join reuses.
    per_cust = orders.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("n_orders"),
        F.sum(_dec("o_totalprice")).alias("_tv"),
        F.count(F.when(st == "F", 1)).alias("late30"),
        F.count(F.when(st == "P", 1)).alias("late60"),
        F.count(F.when(pr == "1-URGENT", 1)).alias("late90"),
        F.sum(F.when((pr == "1-URGENT") & (st == "P"), _dec("o_totalprice"))).alias("_mb"),
        F.max(F.when(pr == "5-LOW", F.col("o_totalprice"))).alias("property_value"),
    )
    j = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    bal = F.col("c_acctbal")
    return j.select(
        F.col("c_custkey").alias("row_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        bal.alias("balance"),
        F.coalesce("n_orders", F.lit(0)).cast("long").alias("n_orders"),
        F.col("_tv").cast("double").alias("total_value"),
        F.coalesce("late30", F.lit(0)).cast("long").alias("late30"),
        F.coalesce("late60", F.lit(0)).cast("long").alias("late60"),
        F.coalesce("late90", F.lit(0)).cast("long").alias("late90"),
        F.col("_mb").cast("double").alias("mortgage_balance"),
        F.col("property_value"),
        F.least(F.lit(4), F.greatest(F.lit(0), F.floor((bal + 1000) / 2200).cast("int"))).alias("tier"),
        F.least(F.lit(35.99), F.greatest(F.lit(4.99), F.lit(24.0) - bal / 400.0)).alias("rate"),
        F.when(F.col("c_custkey") % 10 < 7, "train").otherwise("test").alias("split"),
    )


ACCT_SQL = """acct AS (
  SELECT c_custkey AS row_id, c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance,
         CAST(count(o_orderkey) AS BIGINT) AS n_orders,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
         CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS BIGINT) AS late30,
         CAST(count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS BIGINT) AS late60,
         CAST(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS BIGINT) AS late90,
         CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
                       THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS mortgage_balance,
         max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS property_value,
         CAST(least(4, greatest(0, CAST(floor((c_acctbal + 1000) / 2200) AS INTEGER))) AS INTEGER) AS tier,
         least(35.99, greatest(4.99, 24.0 - c_acctbal / 400.0)) AS rate,
         CASE WHEN c_custkey % 10 < 7 THEN 'train' ELSE 'test' END AS split
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey
  GROUP BY c_custkey, c_mktsegment, c_nationkey, c_acctbal)"""


# ------------------------------------------------------------ acct_folds

def acct_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialised("acct_folds", spark, sf_dir, lambda: assign_folds_stratified(
        acct(spark, sf_dir), key="row_id", k=N_FOLDS, stratify="tier", seed=SEED,
        only_where=F.col("split") == "train"))


def fold_sql(key: str, strat: str, k: int = N_FOLDS, seed: int = SEED,
             where: str | None = None) -> str:
    rn = (f"row_number() OVER (PARTITION BY {strat}{', (' + where + ')' if where else ''} "
          f"ORDER BY md5('{seed}|' || CAST({key} AS VARCHAR)))")
    body = f"CAST(({rn} - 1) % {k} AS INTEGER)"
    if where:
        return f"CASE WHEN {where} THEN {body} END"
    return body


ACCT_FOLDS_SQL = f"""acct_folds AS (
  SELECT *, {fold_sql('row_id', 'tier', where="split = 'train'")} AS fold FROM acct)"""


# ------------------------------------------------------------- acct_pred

def _raw_score(m: int, k: int, row_id, tier):
    base = (row_id * F.lit(SCORE_MULT[m][k]) + F.lit(m)) % 97 + 1
    return base + F.when(tier == k, F.lit(TRUE_CLASS_BONUS[m])).otherwise(F.lit(0))


def acct_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table: per model m, class probabilities m{m}_p{k} and rate m{m}_rate."""
    return _materialised("acct_pred", spark, sf_dir, lambda: _acct_pred(spark, sf_dir))


def _acct_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = acct_folds(spark, sf_dir)
    rid, tier, rate = F.col("row_id"), F.col("tier"), F.col("rate")
    cols = {}
    for m in range(N_MODELS):
        raws = [_raw_score(m, k, rid, tier) for k in range(N_CLASSES)]
        tot = raws[0] + raws[1] + raws[2] + raws[3] + raws[4]
        for k in range(N_CLASSES):
            cols[f"m{m}_p{k}"] = raws[k].cast("double") / tot.cast("double")
        noise = ((rid * F.lit(RATE_MULT[m])) % 101 - 50).cast("double") / F.lit(20.0 + 5 * m)
        cols[f"m{m}_rate"] = rate + noise
    return a.withColumns(cols)


def _raw_sql(m: int, k: int) -> str:
    return (f"((row_id * {SCORE_MULT[m][k]} + {m}) % 97 + 1 + "
            f"CASE WHEN tier = {k} THEN {TRUE_CLASS_BONUS[m]} ELSE 0 END)")


def _acct_pred_sql() -> str:
    parts = []
    for m in range(N_MODELS):
        raws = [_raw_sql(m, k) for k in range(N_CLASSES)]
        tot = "(" + " + ".join(raws) + ")"
        for k in range(N_CLASSES):
            parts.append(f"CAST({raws[k]} AS DOUBLE) / CAST({tot} AS DOUBLE) AS m{m}_p{k}")
        parts.append(f"rate + CAST((row_id * {RATE_MULT[m]}) % 101 - 50 AS DOUBLE) / {20.0 + 5 * m} AS m{m}_rate")
    return "acct_pred AS (\n  SELECT *, " + ",\n    ".join(parts) + "\n  FROM acct_folds)"


ACCT_PRED_SQL = _acct_pred_sql()


def pred_cols(m: int) -> list[str]:
    return [f"m{m}_p{k}" for k in range(N_CLASSES)]


# -------------------------------------------------------------- doc_semi

def doc_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    t = F.col("text")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "lang", "source", "n_chars",
        F.size(F.split(t, r"\s+")).cast("long").alias("n_words"),
        F.size(F.split(t, "\n")).cast("long").alias("n_lines"),
        F.length(F.regexp_replace(t, r"[^0-9]", "")).cast("long").alias("n_digits"),
        "quality", "toxic",
        F.col("quality").isNotNull().cast("int").alias("is_labelled"),
    )


DOC_SEMI_SQL = r"""doc_semi AS (
  SELECT d.doc_id, lang, source, n_chars,
         CAST(len(regexp_split_to_array(text, '\s+')) AS BIGINT) AS n_words,
         CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits,
         quality, toxic,
         CAST(quality IS NOT NULL AS INTEGER) AS is_labelled
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


# ------------------------------------------------------------------- vec

def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    e = e.withColumn("split", F.when(F.col("vec_id") % 10 < 7, "train").otherwise("test"))
    return assign_folds_stratified(e, key="vec_id", k=N_FOLDS, stratify="label", seed=SEED,
                                   only_where=F.col("split") == "train")


VEC_SQL = f"""vec AS (
  SELECT vec_id, embedding, label, split, {fold_sql('vec_id', 'label', where="split = 'train'")} AS fold
  FROM (SELECT *, CASE WHEN vec_id % 10 < 7 THEN 'train' ELSE 'test' END AS split FROM embeddings))"""


# ------------------------------------------------------------------ line

def line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


# ----------------------------------------------------------------- pairs

def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        "l_linestatus", "l_discount", "l_quantity")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .join(supp, li.l_suppkey == supp.s_suppkey)
              .select("l_orderkey", "l_linenumber", "p_brand", "p_type", "s_nationkey",
                      "l_returnflag", "l_linestatus",
                      (F.col("l_discount") * 100).alias("y"),
                      (F.col("l_returnflag") == "R").cast("int").alias("is_r")))


PAIRS_SQL = """pairs AS (
  SELECT l_orderkey, l_linenumber, p_brand, p_type, s_nationkey, l_returnflag, l_linestatus,
         l_discount * 100 AS y, CAST(l_returnflag = 'R' AS INTEGER) AS is_r
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


# ------------------------------------------------------------ composition

CTES = {
    "acct": (ACCT_SQL, ()),
    "acct_folds": (ACCT_FOLDS_SQL, ("acct",)),
    "acct_pred": (ACCT_PRED_SQL, ("acct_folds",)),
    "doc_semi": (DOC_SEMI_SQL, ()),
    "vec": (VEC_SQL, ()),
    "pairs": (PAIRS_SQL, ()),
}


def with_sql(names: str | list[str], body: str, extra: list[str] | None = None) -> str:
    """``WITH <fixture CTEs in dependency order>, <extra CTEs> <body>``."""
    names = [names] if isinstance(names, str) else list(names)
    order: list[str] = []

    def visit(n):
        for d in CTES[n][1]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [CTES[n][0] for n in order] + list(extra or [])
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
