"""Group statistics, window-style transforms, lookups, imputation and encoding
queries (A1-A12, W1-W5, J1-J5, I1-I13, E1-E8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import encode as E
from ..operators import impute as I
from ..operators import lookup as J
from ..operators.groupstats import GroupStat, attach_group_stat, attach_group_stats, global_stat
from .inputs import O, O_SQL, OC, OC_SQL, OCN, OCN_SQL, T as tbl
from .registry import register


def r(c, n=6):
    return F.round(C.col_of(c).cast("double"), n)


# ---- A1, A2 ----------------------------------------------------------------------------

@register("group_mean", sql=f"""
WITH {O_SQL}
SELECT o_orderpriority, round(avg(price_n), 4) AS mean_price FROM O GROUP BY o_orderpriority""")
def group_mean(spark, d):
    return GroupStat(["o_orderpriority"], "price_n", "mean", "mean_price").fit(O(spark, d)).stats.df \
        .select("o_orderpriority", r("mean_price", 4).alias("mean_price"))


@register("group_median", sql=f"""
WITH {O_SQL}
SELECT o_orderpriority, round(median(price_n), 4) AS median_price FROM O GROUP BY o_orderpriority""")
def group_median(spark, d):
    return GroupStat(["o_orderpriority"], "price_n", "median", "median_price").fit(O(spark, d)).stats.df \
        .select("o_orderpriority", r("median_price", 4).alias("median_price"))


# ---- A3, A4, A5, J1 --------------------------------------------------------------------

_TE_KEYS = [("te_nation", "n_name"), ("te_segment", "c_mktsegment"), ("te_year", "o_year")]


def _ocn_year(spark, d):
    return OCN(spark, d).withColumn("o_year", F.year("o_orderdate"))


def _encode(df, stat, value, prefix):
    return attach_group_stats(df, [k for _, k in _TE_KEYS], value, stat, [prefix + n[3:] for n, _ in _TE_KEYS],
                              where=F.col("is_train"))


_TE_SQL = f"""WITH {OCN_SQL},
X AS (SELECT *, year(o_orderdate) AS o_year, CASE WHEN price_n > -1 THEN ln(1 + price_n) END AS lp FROM OCN)"""


@register("target_encode_mean", sql=_TE_SQL + """,
a AS (SELECT n_name, avg(lp) AS v FROM X WHERE is_train GROUP BY 1),
b AS (SELECT c_mktsegment, avg(lp) AS v FROM X WHERE is_train GROUP BY 1),
c AS (SELECT o_year, avg(lp) AS v FROM X WHERE is_train GROUP BY 1)
SELECT o_orderkey, round(a.v, 6) AS te_nation, round(b.v, 6) AS te_segment, round(c.v, 6) AS te_year
FROM X LEFT JOIN a USING (n_name) LEFT JOIN b USING (c_mktsegment) LEFT JOIN c USING (o_year)""")
def target_encode_mean(spark, d):
    df = _ocn_year(spark, d).withColumn("lp", C.log1p("price_n"))
    df = _encode(df, "mean", "lp", "te_")
    return df.select("o_orderkey", *[r(n).alias(n) for n, _ in _TE_KEYS])


@register("target_encode_rate", sql=_TE_SQL + """,
a AS (SELECT n_name, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS v FROM X WHERE is_train GROUP BY 1),
b AS (SELECT c_mktsegment, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS v FROM X WHERE is_train GROUP BY 1),
c AS (SELECT o_year, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS v FROM X WHERE is_train GROUP BY 1)
SELECT o_orderkey, round(a.v, 6) AS rate_nation, round(b.v, 6) AS rate_segment, round(c.v, 6) AS rate_year
FROM X LEFT JOIN a USING (n_name) LEFT JOIN b USING (c_mktsegment) LEFT JOIN c USING (o_year)""")
def target_encode_rate(spark, d):
    df = _encode(_ocn_year(spark, d), "rate", "y", "rate_")
    return df.select("o_orderkey", *[r("rate_" + n[3:]).alias("rate_" + n[3:]) for n, _ in _TE_KEYS])


@register("target_encode_geo", sql=_TE_SQL + """,
a AS (SELECT n_name, avg(lp) AS v FROM X WHERE is_train GROUP BY 1),
b AS (SELECT c_mktsegment, avg(lp) AS v FROM X WHERE is_train GROUP BY 1)
SELECT o_orderkey, round(sqrt(a.v * b.v), 6) AS te_geo
FROM X LEFT JOIN a USING (n_name) LEFT JOIN b USING (c_mktsegment)""")
def target_encode_geo(spark, d):
    df = _ocn_year(spark, d).withColumn("lp", C.log1p("price_n"))
    df = attach_group_stats(df, ["n_name", "c_mktsegment"], "lp", "mean", ["a", "b"], where=F.col("is_train"))
    return df.select("o_orderkey", r(F.sqrt(F.col("a") * F.col("b"))).alias("te_geo"))


@register("join_group_stat", sql=f"""
WITH {OC_SQL}, s AS (SELECT c_mktsegment, avg(o_totalprice) AS a FROM OC GROUP BY 1)
SELECT o_orderkey, round(a, 4) AS seg_avg FROM OC JOIN s USING (c_mktsegment)""")
def join_group_stat(spark, d):
    df = attach_group_stat(OC(spark, d), ["c_mktsegment"], "o_totalprice", "mean", "seg_avg")
    return df.select("o_orderkey", r("seg_avg", 4).alias("seg_avg"))


# ---- A6 --------------------------------------------------------------------------------

@register("ratio_to_global_median", sql="""
WITH m AS (SELECT median(p_size) AS m FROM part)
SELECT p_partkey, round(p_retailprice * p_size / m, 6) AS price_size_ratio FROM part CROSS JOIN m""")
def ratio_to_global_median(spark, d):
    p = tbl(spark, d, "part")
    med = global_stat(p, "p_size", "median")
    return p.select("p_partkey", r(F.col("p_retailprice") * F.col("p_size") / F.lit(med)).alias("price_size_ratio"))


# ---- A7, A8, I3, I4 --------------------------------------------------------------------

_GLOBAL_MODE = """(SELECT prio_n AS m FROM {src} WHERE prio_n IS NOT NULL GROUP BY prio_n
  ORDER BY count(*) DESC, prio_n LIMIT 1)"""
_CUST_MODE = """(SELECT o_custkey, prio_n AS m FROM (SELECT o_custkey, prio_n,
  row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, prio_n) AS rn
  FROM {src} WHERE prio_n IS NOT NULL GROUP BY o_custkey, prio_n) WHERE rn = 1)"""


@register("impute_global_mode", sql=f"""
WITH {OC_SQL}, g AS {_GLOBAL_MODE.format(src='OC')}
SELECT o_orderkey, coalesce(prio_n, g.m) AS prio_f FROM OC CROSS JOIN g""")
def impute_global_mode(spark, d):
    df = I.GlobalImputer(["prio_n"], "mode").fit(OC(spark, d)).transform(OC(spark, d))
    return df.select("o_orderkey", F.col("prio_n").alias("prio_f"))


@register("impute_group_mode", sql=f"""
WITH {OC_SQL}, c AS {_CUST_MODE.format(src='OC')}
SELECT o_orderkey, coalesce(prio_n, c.m) AS prio_f FROM OC LEFT JOIN c USING (o_custkey)""")
def impute_group_mode(spark, d):
    oc = OC(spark, d)
    df = I.GroupImputer("prio_n", ["o_custkey"], "mode").fit(oc).transform(oc)
    return df.select("o_orderkey", F.col("prio_n").alias("prio_f"))


@register("impute_mode_cascade", sql=f"""
WITH {OC_SQL}, c AS {_CUST_MODE.format(src='OC')},
S1 AS (SELECT o_orderkey, coalesce(prio_n, c.m) AS prio_n FROM OC LEFT JOIN c USING (o_custkey)),
g AS {_GLOBAL_MODE.format(src='S1')}
SELECT o_orderkey, coalesce(prio_n, g.m) AS prio_f FROM S1 CROSS JOIN g""")
def impute_mode_cascade(spark, d):
    df = I.impute_cascade(OC(spark, d), "prio_n", [(["o_custkey"], "mode"), ([], "mode")])
    return df.select("o_orderkey", F.col("prio_n").alias("prio_f"))


# ---- A9 --------------------------------------------------------------------------------

@register("label_distribution", sql="""
WITH a AS (SELECT 'quality' AS source, CAST(quality AS VARCHAR) AS label FROM labels
           UNION ALL SELECT 'event_type', event_type FROM events),
c AS (SELECT source, label, count(*) AS n FROM a GROUP BY ALL),
t AS (SELECT source, sum(n) AS total FROM c GROUP BY source)
SELECT source, label, CAST(n AS BIGINT) AS count, CAST(round_even(n * 100.0 / total, 2) AS DOUBLE) AS percent
FROM c JOIN t USING (source)""")
def label_distribution(spark, d):
    a = tbl(spark, d, "labels").select(F.lit("quality").alias("source"), F.col("quality").cast("string").alias("label"))
    b = tbl(spark, d, "events").select(F.lit("event_type").alias("source"), F.col("event_type").alias("label"))
    c = a.unionByName(b).groupBy("source", "label").agg(F.count(F.lit(1)).alias("count"))
    c = attach_group_stat(c, ["source"], "count", "sum", "__total")
    return c.select("source", "label", F.col("count").cast("long").alias("count"),
                    F.bround(F.col("count") * 100.0 / F.col("__total"), 2).alias("percent")) \
            .orderBy("source", "label")


# ---- A11 -------------------------------------------------------------------------------

@register("label_reencode", sql="""
WITH s AS (SELECT * FROM embeddings WHERE label IN (3, 7, 9)),
c AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT label FROM s))
SELECT vec_id, CAST(code AS BIGINT) AS code FROM s JOIN c USING (label)""")
def label_reencode(spark, d):
    s = tbl(spark, d, "embeddings").where(F.col("label").isin(3, 7, 9))
    return E.CategoryCoder("label", "code").fit(s).transform(s).select("vec_id", "code")


# ---- W1, W2 ----------------------------------------------------------------------------

@register("group_median_transform", sql=f"""
WITH {OC_SQL}, s AS (SELECT c_mktsegment, median(o_totalprice) AS m FROM OC GROUP BY 1)
SELECT o_orderkey, round(m, 4) AS seg_median FROM OC JOIN s USING (c_mktsegment)""")
def group_median_transform(spark, d):
    df = attach_group_stat(OC(spark, d), ["c_mktsegment"], "o_totalprice", "median", "seg_median")
    return df.select("o_orderkey", r("seg_median", 4).alias("seg_median"))


@register("ratio_to_group_mean", sql=f"""
WITH {OC_SQL}, s AS (SELECT c_mktsegment, avg(o_totalprice) AS a FROM OC GROUP BY 1)
SELECT o_orderkey, round(o_totalprice / a, 6) AS price_ratio FROM OC JOIN s USING (c_mktsegment)""")
def ratio_to_group_mean(spark, d):
    df = attach_group_stat(OC(spark, d), ["c_mktsegment"], "o_totalprice", "mean", "__m")
    return df.select("o_orderkey", r(F.col("o_totalprice") / F.col("__m")).alias("price_ratio"))


# ---- I1, I2, I5, I8 --------------------------------------------------------------------

@register("impute_group_median", sql=f"""
WITH {O_SQL}, m AS (SELECT o_orderpriority, median(price_n) AS m FROM O GROUP BY 1)
SELECT o_orderkey, round(coalesce(price_n, m), 4) AS price_f FROM O LEFT JOIN m USING (o_orderpriority)""")
def impute_group_median(spark, d):
    o = O(spark, d)
    df = I.GroupImputer("price_n", ["o_orderpriority"], "median").fit(o).transform(o)
    return df.select("o_orderkey", r("price_n", 4).alias("price_f"))


@register("impute_median", sql=f"""
WITH {O_SQL}, m AS (SELECT median(price_n) AS m FROM O)
SELECT o_orderkey, round(coalesce(price_n, m), 4) AS price_f FROM O CROSS JOIN m""")
def impute_median(spark, d):
    o = O(spark, d).select("o_orderkey", "price_n")
    df = I.GlobalImputer(None, "median", exclude=["o_orderkey"]).fit(o).transform(o)
    return df.select("o_orderkey", r("price_n", 4).alias("price_f"))


@register("impute_constant", sql=f"""
WITH {O_SQL}
SELECT o_orderkey, coalesce(prio_n, 'None') AS prio_f, coalesce(price_n, -1.0) AS price_f FROM O""")
def impute_constant(spark, d):
    df = I.fill_constant(O(spark, d), {"prio_n": "None", "price_n": -1.0})
    return df.select("o_orderkey", F.col("prio_n").alias("prio_f"), F.col("price_n").alias("price_f"))


@register("impute_group_mean", sql=f"""
WITH {O_SQL},
Z AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE price_n END AS pz FROM O),
Z1 AS (SELECT o_orderkey, o_orderpriority, CASE WHEN pz = 0 THEN 1.0 ELSE pz END AS pz FROM Z),
m AS (SELECT o_orderpriority, avg(pz) AS m FROM Z1 GROUP BY 1)
SELECT o_orderkey, round(coalesce(pz, m), 4) AS price_f FROM Z1 LEFT JOIN m USING (o_orderpriority)""")
def impute_group_mean(spark, d):
    o = O(spark, d)
    pz = F.when(F.col("o_orderkey") % 13 == 0, F.lit(0.0)).otherwise(F.col("price_n"))
    o = o.withColumn("pz", pz).withColumn("pz", F.when(F.col("pz") == 0, F.lit(1.0)).otherwise(F.col("pz")))
    df = I.GroupImputer("pz", ["o_orderpriority"], "mean").fit(o).transform(o)
    return df.select("o_orderkey", r("pz", 4).alias("price_f"))


# ---- I6, I7 ----------------------------------------------------------------------------

@register("impute_median_then_mean", sql=f"""
WITH {OC_SQL},
m AS (SELECT o_custkey, median(price_n) AS m FROM OC GROUP BY 1),
S1 AS (SELECT o_orderkey, c_mktsegment, coalesce(price_n, m) AS p FROM OC LEFT JOIN m USING (o_custkey)),
a AS (SELECT c_mktsegment, avg(p) AS a FROM S1 GROUP BY 1)
SELECT o_orderkey, round(coalesce(p, CAST(trunc(a) AS DOUBLE)), 4) AS price_f FROM S1 LEFT JOIN a USING (c_mktsegment)""")
def impute_median_then_mean(spark, d):
    df = I.impute_cascade(OC(spark, d), "price_n", [(["o_custkey"], "median"),
                                                    (["c_mktsegment"], "mean", "long")])
    return df.select("o_orderkey", r("price_n", 4).alias("price_f"))


@register("impute_category_mean_rounded", sql=f"""
WITH {O_SQL}, V AS (SELECT o_orderkey, prio_n, price_n / 10000.0 AS v FROM O),
m AS (SELECT prio_n, avg(v) AS m FROM V WHERE v IS NOT NULL GROUP BY 1)
SELECT o_orderkey, coalesce(v, floor(m) + CASE WHEN V.prio_n IN ('1-URGENT', '2-HIGH') THEN 0.5 ELSE 0.0 END, 28.0)
       AS age_f
FROM V LEFT JOIN m ON V.prio_n = m.prio_n""")
def impute_category_mean_rounded(spark, d):
    o = O(spark, d).withColumn("v", F.col("price_n") / 10000.0)
    df = I.impute_category_mean_rounded(o, "v", "prio_n", ["1-URGENT", "2-HIGH"], 28.0)
    return df.select("o_orderkey", F.col("v").alias("age_f"))


# ---- I9, I10, I11 ----------------------------------------------------------------------

@register("impute_from_column", sql="""
WITH s AS (SELECT l_orderkey, CAST(year(max(l_shipdate)) AS INTEGER) AS ship_year FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN ship_year <= 2000 THEN ship_year ELSE CAST(year(o_orderdate) AS INTEGER) END AS yr
FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""")
def impute_from_column(spark, d):
    s = tbl(spark, d, "lineitem").groupBy("l_orderkey").agg(F.year(F.max("l_shipdate")).alias("ship_year"))
    o = tbl(spark, d, "orders").join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select("o_orderkey", I.fill_from_column("ship_year", F.year("o_orderdate"),
                                                     valid=F.col("ship_year") <= 2000).alias("yr"))


_FLAG_SQL = f"""WITH {O_SQL},
X AS (SELECT o_orderkey, price_n, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE y END AS flag FROM O)"""


def _flagged(spark, d):
    o = O(spark, d)
    return o.select("o_orderkey", "price_n",
                    F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("int")).otherwise(F.col("y")).alias("flag"))


@register("impute_conditional", sql=_FLAG_SQL + """,
Y AS (SELECT o_orderkey, price_n, coalesce(flag, CASE WHEN coalesce(price_n, 0) > 0 THEN 0 ELSE 1 END) AS flag_f FROM X)
SELECT o_orderkey, flag_f, CASE WHEN price_n IS NULL AND flag_f = 1 THEN 0.0 ELSE price_n END AS price_f FROM Y""")
def impute_conditional(spark, d):
    x = _flagged(spark, d)
    active = C.any_positive(["price_n"])
    x = x.withColumn("flag_f", F.coalesce(F.col("flag"), F.when(active, 0).otherwise(1)))
    return x.select("o_orderkey", "flag_f",
                    F.when(F.col("price_n").isNull() & (F.col("flag_f") == 1), F.lit(0.0))
                     .otherwise(F.col("price_n")).alias("price_f"))


@register("impute_threshold_flag", sql=_FLAG_SQL + """,
m AS (SELECT avg(price_n) AS m FROM X)
SELECT o_orderkey, coalesce(flag, CAST(price_n >= m AS INTEGER)) AS flag_f FROM X CROSS JOIN m""")
def impute_threshold_flag(spark, d):
    x = I.flag_from_threshold(_flagged(spark, d), "flag", "price_n")
    return x.select("o_orderkey", F.col("flag").alias("flag_f"))


# ---- I13 -------------------------------------------------------------------------------

@register("impute_fit_train_apply_test", sql=f"""
WITH {O_SQL}, m AS (SELECT avg(price_n) AS m FROM O WHERE is_train),
g AS (SELECT prio_n AS g FROM O WHERE is_train AND prio_n IS NOT NULL GROUP BY prio_n ORDER BY count(*) DESC, prio_n LIMIT 1)
SELECT o_orderkey, round(coalesce(price_n, m), 4) AS price_f, coalesce(prio_n, g) AS prio_f FROM O CROSS JOIN m CROSS JOIN g""")
def impute_fit_train_apply_test(spark, d):
    o = O(spark, d)
    mean = I.GlobalImputer(["price_n"], "mean", where=F.col("is_train")).fit(o)
    mode = I.GlobalImputer(["prio_n"], "mode", where=F.col("is_train")).fit(o)
    df = mode.transform(mean.transform(o))
    return df.select("o_orderkey", r("price_n", 4).alias("price_f"), F.col("prio_n").alias("prio_f"))


# ---- E1, E2, E3 ------------------------------------------------------------------------

@register("factorize", sql=f"""
WITH {O_SQL}, f AS (SELECT prio_n, min(o_orderkey) AS first FROM O WHERE prio_n IS NOT NULL GROUP BY 1),
c AS (SELECT prio_n, row_number() OVER (ORDER BY first) - 1 AS code FROM f)
SELECT o_orderkey, CAST(coalesce(code, -1) AS BIGINT) AS prio_code FROM O LEFT JOIN c ON O.prio_n = c.prio_n""")
def factorize(spark, d):
    o = O(spark, d)
    df = E.Factorizer("prio_n", "o_orderkey", "prio_code").fit(o).transform(o)
    return df.select("o_orderkey", "prio_code")


@register("category_codes", sql=f"""
WITH {O_SQL}, c AS (SELECT prio_n, row_number() OVER (ORDER BY prio_n) - 1 AS code
                    FROM (SELECT DISTINCT prio_n FROM O WHERE prio_n IS NOT NULL))
SELECT o_orderkey, CAST(coalesce(code, -1) AS BIGINT) AS prio_code FROM O LEFT JOIN c ON O.prio_n = c.prio_n""")
def category_codes(spark, d):
    o = O(spark, d)
    df = E.CategoryCoder("prio_n", "prio_code").fit(o).transform(o)
    return df.select("o_orderkey", "prio_code")


DECLARED_LEVELS = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]


@register("ordinal_levels", sql=f"""
WITH {O_SQL}
SELECT o_orderkey, CASE prio_n WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2
                   WHEN '2-HIGH' THEN 3 END AS prio_level FROM O""")
def ordinal_levels(spark, d):
    return O(spark, d).select("o_orderkey", E.ordinal("prio_n", DECLARED_LEVELS).alias("prio_level"))


# ---- E5, E6 ----------------------------------------------------------------------------

_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("onehot_times_measure", sql="SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{p}' THEN o_totalprice ELSE 0 END AS \"{E.level_column('price', p)}\""
    for p in _PRIOS) + " FROM orders")
def onehot_times_measure(spark, d):
    o = tbl(spark, d, "orders")
    df = E.OneHotTimes("o_orderpriority", "o_totalprice", "price").fit(o).transform(o)
    return df.select("o_orderkey", *[E.level_column("price", p) for p in _PRIOS])


@register("onehot_unknown_zero", sql="SELECT o_orderkey, " + ", ".join(
    f"CAST(coalesce(o_orderpriority = '{p}', false) AS INTEGER) AS \"{E.level_column('oh', p)}\""
    for p in _PRIOS[:4]) + " FROM orders")
def onehot_unknown_zero(spark, d):
    o = tbl(spark, d, "orders")
    df = E.OneHot("o_orderpriority", "oh", where=F.col("o_orderpriority") != "5-LOW").fit(o).transform(o)
    return df.select("o_orderkey", *[E.level_column("oh", p) for p in _PRIOS[:4]])


# ---- E7, E8 ----------------------------------------------------------------------------

@register("zscore_sample", sql="""
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - m) / sd, 6) AS bal_z FROM customer CROSS JOIN s""")
def zscore_sample(spark, d):
    c = tbl(spark, d, "customer")
    df = E.Standardizer(["c_acctbal"], ddof=1).fit(c).transform(c)
    return df.select("c_custkey", r("c_acctbal").alias("bal_z"))


@register("zscore_population", sql="""
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - m) / sd, 6) AS bal_z FROM customer CROSS JOIN s""")
def zscore_population(spark, d):
    c = tbl(spark, d, "customer")
    df = E.Standardizer(["c_acctbal"], ddof=0).fit(c).transform(c)
    return df.select("c_custkey", r("c_acctbal").alias("bal_z"))


# ---- J2, J3, J4 ------------------------------------------------------------------------

def _region_codes(spark, d):
    """Nation codes listed under region names (a lookup table derived from the
    data): each nation under its own region, nations 3 and 17 also listed under
    the next region, nation 24 left out."""
    n = tbl(spark, d, "nation").where(F.col("n_nationkey") != 24)
    r_ = tbl(spark, d, "region")
    own = n.join(r_, n.n_regionkey == r_.r_regionkey).select(
        F.col("n_nationkey").alias("code"), F.col("r_name").alias("region_name"),
        (F.col("r_regionkey") * 100 + F.col("n_nationkey")).alias("pos"))
    nxt = (n.where(F.col("n_nationkey").isin(3, 17))
            .join(r_, ((n.n_regionkey + 1) % 5) == r_.r_regionkey)
            .select(F.col("n_nationkey").alias("code"), F.col("r_name").alias("region_name"),
                    (F.col("r_regionkey") * 100 + F.col("n_nationkey")).alias("pos")))
    return own.unionByName(nxt)


@register("lookup_first_match", sql="""
WITH own AS (SELECT n_nationkey AS code, r_name AS region_name, r_regionkey * 100 + n_nationkey AS pos
             FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24),
nxt AS (SELECT n_nationkey AS code, r_name AS region_name, r_regionkey * 100 + n_nationkey AS pos
        FROM nation JOIN region ON (n_regionkey + 1) % 5 = r_regionkey WHERE n_nationkey IN (3, 17)),
t AS (SELECT * FROM own UNION ALL SELECT * FROM nxt),
best AS (SELECT code, arg_min(region_name, pos) AS region_name FROM t GROUP BY code)
SELECT c_custkey, coalesce(region_name, 'None') AS region_name FROM customer LEFT JOIN best ON c_nationkey = code""")
def lookup_first_match(spark, d):
    c = tbl(spark, d, "customer")
    out = J.first_match_lookup(c.withColumnRenamed("c_nationkey", "code"), "code", _region_codes(spark, d),
                               "code", "region_name", "pos", "region_name", default="None")
    return out.select("c_custkey", "region_name")


# A small (segment, nation) -> (advantage, significance) code book;
# the second BUILDING/1 entry is a duplicate that must lose to the first.
CODE_BOOK = [("BUILDING", 1, 1, 10, 0), ("BUILDING", 1, 0, 5, 1), ("MACHINERY", 7, 1, 8, 2),
             ("HOUSEHOLD", 3, 0, 2, 3), ("AUTOMOBILE", 12, 1, 6, 4), ("FURNITURE", 20, 0, 4, 5)]
_BOOK_SQL = ", ".join(f"('{s}', {n}, {a}, {g}, {p})" for s, n, a, g, p in CODE_BOOK)


@register("lookup_composite", sql=f"""
WITH book(seg, nat, advantage, significance, pos) AS (VALUES {_BOOK_SQL}),
best AS (SELECT seg, nat, arg_min(advantage, pos) AS advantage, arg_min(significance, pos) AS significance
         FROM book GROUP BY seg, nat)
SELECT c_custkey, coalesce(advantage, 0) AS advantage, coalesce(significance, 0) AS significance
FROM customer LEFT JOIN best ON c_mktsegment = seg AND c_nationkey = nat""")
def lookup_composite(spark, d):
    book = spark.createDataFrame(CODE_BOOK, "c_mktsegment string, c_nationkey int, advantage int, "
                                            "significance int, pos int")
    c = tbl(spark, d, "customer")
    out = J.composite_lookup(c, ["c_mktsegment", "c_nationkey"], book, {"advantage": 0, "significance": 0}, pos="pos")
    return out.select("c_custkey", "advantage", "significance")


@register("lookup_ranges", sql="""
WITH book AS (SELECT s_nationkey AS nat, (s_suppkey * 37) % 1000 AS lo, (s_suppkey * 37) % 1000 + s_suppkey % 90 AS hi,
                     s_suppkey AS supplier, s_suppkey AS pos FROM supplier),
hits AS (SELECT c_custkey, arg_min(supplier, pos) AS supplier FROM customer
         JOIN book ON c_nationkey = nat AND c_custkey % 1000 BETWEEN lo AND hi GROUP BY c_custkey)
SELECT c_custkey, coalesce(supplier, -1) AS supplier FROM customer LEFT JOIN hits USING (c_custkey)""")
def lookup_ranges(spark, d):
    """Customers' numbers in the suppliers' overlapping ranges per nation; the first listed wins."""
    lo = (F.col("s_suppkey") * 37) % 1000
    book = tbl(spark, d, "supplier").select(F.col("s_nationkey").alias("nat"), lo.alias("lo"), (lo + F.col("s_suppkey") % 90).alias("hi"),
                                            F.col("s_suppkey").alias("supplier"), F.col("s_suppkey").alias("pos"))
    c = tbl(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nat"), (F.col("c_custkey") % 1000).alias("number"))
    return J.range_lookup(c, ["nat"], "number", book, "lo", "hi", {"supplier": -1}, pos="pos").select("c_custkey", "supplier")


@register("daily_side_join", sql="""
WITH ev AS (SELECT CAST(ts AS DATE) AS day, event_id, value, event_type FROM events),
side AS (SELECT day, min(event_id) AS event_id FROM ev GROUP BY day),
side2 AS (SELECT s.day, s.event_id, e.value, e.event_type FROM side s JOIN ev e USING (event_id)),
q AS (SELECT quantile_cont(value, 0.9) AS p90, quantile_cont(value, 0.5) AS p50 FROM side2),
days AS (SELECT CAST(unnest(generate_series(min(day) - INTERVAL 3 DAY, max(day) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS DATE)
         AS day FROM ev)
SELECT days.day, side2.event_id, side2.value, side2.event_type,
       CAST(side2.value > p90 AS INTEGER) AS hi90, CAST(side2.value > p50 AS INTEGER) AS hi50
FROM days LEFT JOIN side2 USING (day) CROSS JOIN q""")
def daily_side_join(spark, d):
    ev = tbl(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id", "value", "event_type")
    side = J.dedup_by_key(ev, "day", "event_id")
    side = J.quantile_flags(side, "value", {"hi90": 0.9, "hi50": 0.5})
    days = ev.agg(F.explode(F.sequence(F.date_sub(F.min("day"), 3), F.date_add(F.max("day"), 3))).alias("day"))
    return days.join(side, "day", "left").select("day", "event_id", "value", "event_type", "hi90", "hi50")
