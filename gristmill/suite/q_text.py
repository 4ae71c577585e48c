"""String and text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import strings as S
from ..operators.text import TfidfLong
from ..plans import math_prob
from .inputs import OC, OC_SQL, T as tbl, wide
from .registry import register

WS_SQL = r"[\s\p{Z}]"


def _tokens_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{WS_SQL}+'), lambda t: t <> '')"


# ---- T1, T2, T5 ----------------------------------------------------------------------

@register("split_delimited", sql="""
SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS prio_num,
       NULLIF(split_part(o_orderpriority, '-', 2), '') AS prio_label
FROM orders""")
def split_delimited(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", S.split_part("o_orderpriority", "-", 0).cast("int").alias("prio_num"),
                    S.split_part("o_orderpriority", "-", 1).alias("prio_label"))


@register("split_fixed", sql="""
SELECT c_custkey, substr(c_name, 1, 1) AS head, substr(c_name, 2, 3) AS mid,
       CAST(substr(c_name, 10) AS BIGINT) AS num, substr(c_name, 1, 1) || substr(c_name, 2, 3) AS combo,
       split_part(c_name, '#', 1) AS name_prefix
FROM customer""")
def split_fixed(spark, d):
    c = tbl(spark, d, "customer")
    head, mid = S.slice_fixed("c_name", 0, 1), S.slice_fixed("c_name", 1, 3)
    return c.select("c_custkey", head.alias("head"), mid.alias("mid"),
                    S.slice_fixed("c_name", 9).cast("long").alias("num"), F.concat(head, mid).alias("combo"),
                    S.split_part("c_name", "#", 0).alias("name_prefix"))


@register("first_last_token", sql=f"""
WITH t AS (SELECT p_partkey, {_tokens_sql('p_name')} AS tk FROM part)
SELECT p_partkey, CASE WHEN len(tk) > 1 THEN tk[1] ELSE 'No' END AS first_tok,
       CASE WHEN len(tk) > 0 THEN tk[-1] ELSE '0' END AS last_tok
FROM t""")
def first_last_token(spark, d):
    p = tbl(spark, d, "part")
    return p.select("p_partkey", S.first_token_or("p_name").alias("first_tok"),
                    S.last_token_or("p_name").alias("last_tok"))


# ---- T3, T4, P20 -----------------------------------------------------------------------

NAME_PATTERN = r"(small|large|red|blue|old|new|hot)"


@register("regex_extract", sql=f"""
SELECT p_partkey, NULLIF(regexp_extract(p_name, '{NAME_PATTERN}', 1), '') AS word FROM part""")
def regex_extract(spark, d):
    p = tbl(spark, d, "part")
    return p.select("p_partkey", S.extract_first("p_name", NAME_PATTERN).alias("word"))


@register("canonicalise_rules", sql=f"""
WITH a AS (SELECT p_partkey, NULLIF(regexp_extract(p_name, '{NAME_PATTERN}', 1), '') AS w0,
                  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size END AS size_n FROM part),
b AS (SELECT p_partkey, size_n, CASE WHEN w0 IN ('old', 'new') THEN 'small' WHEN w0 IN ('hot', 'blue') THEN 'large'
      ELSE w0 END AS w1 FROM a),
c AS (SELECT *, CASE WHEN size_n IS NOT NULL THEN CAST(size_n >= 21 AS INTEGER)
      ELSE CAST(NOT coalesce(w1 IN ('small', 'red'), false) AS INTEGER) END AS big FROM b),
r1 AS (SELECT *, CASE WHEN w1 = 'red' AND big = 1 THEN 'large' ELSE w1 END AS w2 FROM c),
r2 AS (SELECT *, CASE WHEN w2 = 'large' AND big = 0 THEN 'red' ELSE w2 END AS w3 FROM r1),
r3 AS (SELECT *, CASE WHEN w3 = 'small' AND big = 1 THEN 'blue' ELSE w3 END AS w4 FROM r2),
r4 AS (SELECT *, CASE WHEN w4 = 'blue' AND big = 0 THEN 'small' ELSE w4 END AS w5 FROM r3)
SELECT p_partkey, w5 AS word, big FROM r4""")
def canonicalise_rules(spark, d):
    p = tbl(spark, d, "part")
    size_n = F.when(F.col("p_partkey") % 6 == 0, F.lit(None).cast("int")).otherwise(F.col("p_size"))
    w = S.extract_first("p_name", NAME_PATTERN)
    w = F.when(w.isin("old", "new"), "small").when(w.isin("hot", "blue"), "large").otherwise(w)
    df = p.select("p_partkey", size_n.alias("size_n"), w.alias("w"))
    big = C.rule_flag_with_fallback("size_n", 21, ~F.coalesce(F.col("w").isin("small", "red"), F.lit(False)))
    df = df.withColumn("big", big)
    rules = [("red", 1, "large"), ("large", 0, "red"), ("small", 1, "blue"), ("blue", 0, "small")]
    word = F.col("w")
    for src, flag_v, dst in rules:
        word = F.when((word == src) & (F.col("big") == flag_v), F.lit(dst)).otherwise(word)
    return df.select("p_partkey", word.alias("word"), "big")


# ---- T6, T7 ----------------------------------------------------------------------------

CODE_SQL = """CASE p_partkey % 5 WHEN 0 THEN NULL
  WHEN 1 THEN 'C' || CAST(p_partkey % 100 AS VARCHAR)
  WHEN 2 THEN 'C' || CAST(p_partkey % 50 AS VARCHAR) || ' C' || CAST(p_partkey % 50 + 2 AS VARCHAR)
              || ' C' || CAST(p_partkey % 50 + 4 AS VARCHAR)
  WHEN 3 THEN 'F G' || CAST(p_partkey % 90 AS VARCHAR)
  ELSE 'T' END"""


def _code_col():
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    return (F.when(k % 5 == 0, F.lit(None).cast("string"))
             .when(k % 5 == 1, F.concat(F.lit("C"), s(k % 100)))
             .when(k % 5 == 2, F.concat(F.lit("C"), s(k % 50), F.lit(" C"), s(k % 50 + 2), F.lit(" C"), s(k % 50 + 4)))
             .when(k % 5 == 3, F.concat(F.lit("F G"), s(k % 90)))
             .otherwise(F.lit("T")))


@register("parse_code_list", sql=f"""
WITH a AS (SELECT p_partkey, coalesce({CODE_SQL}, 'No') AS code FROM part),
b AS (SELECT p_partkey, {_tokens_sql('code')} AS tk FROM a),
c AS (SELECT p_partkey, tk, len(tk) AS n,
  list_transform(tk, lambda x: coalesce(TRY_CAST(substr(x, 2) AS BIGINT), 0)) AS nums,
  len(list_filter(tk, lambda x: substr(x, 1, 1) = 'F')) > 0 AS any_f FROM b)
SELECT p_partkey,
  CASE WHEN n < 2 AND lower(tk[-1]) = 'no' THEN 'N' WHEN n < 2 THEN substr(tk[-1], 1, 1)
       WHEN any_f THEN 'F' ELSE substr(tk[-1], 1, 1) END AS letter,
  CAST(CASE WHEN n < 2 AND lower(tk[-1]) = 'no' THEN -1 WHEN n < 2 THEN nums[-1]
       WHEN any_f THEN 0 ELSE trunc(list_sum(nums) / n) END AS BIGINT) AS number
FROM c""")
def parse_code_list(spark, d):
    p = tbl(spark, d, "part").select("p_partkey", _code_col().alias("code"))
    letter, number = S.code_list_letter_number("code")
    return p.select("p_partkey", letter.alias("letter"), number.alias("number"))


PHRASE_SQL = """CASE WHEN p_size % 12 = 0 THEN '< 1 year' WHEN p_size % 12 = 11 THEN '10+ years'
  WHEN p_size % 12 = 10 THEN NULL ELSE CAST(p_size % 12 AS VARCHAR) || ' years' END"""


@register("parse_phrase_number", sql=f"""
WITH a AS (SELECT p_partkey, {PHRASE_SQL} AS phrase FROM part),
b AS (SELECT p_partkey, {_tokens_sql('phrase')}[1] AS tok FROM a)
SELECT p_partkey, CASE WHEN tok = '<' THEN 0.5 WHEN tok = '10+' THEN 10.5 ELSE TRY_CAST(tok AS DOUBLE) END AS years
FROM b""")
def parse_phrase_number(spark, d):
    p = tbl(spark, d, "part")
    m = F.col("p_size") % 12
    phrase = (F.when(m == 0, "< 1 year").when(m == 11, "10+ years").when(m == 10, F.lit(None).cast("string"))
               .otherwise(F.concat(m.cast("string"), F.lit(" years"))))
    return p.select("p_partkey", S.phrase_to_number(phrase).alias("years"))


# ---- T9 --------------------------------------------------------------------------------

@register("concat_keys", sql=f"""
WITH {OC_SQL}
SELECT o_orderkey, c_mktsegment || '_' || o_orderpriority AS seg_prio,
       c_mktsegment || '_' || o_orderpriority || '_' || o_orderstatus AS seg_prio_status,
       CAST(c_nationkey AS VARCHAR) || '_' || o_orderstatus AS nation_status
FROM OC""")
def concat_keys(spark, d):
    oc = OC(spark, d)
    return oc.select("o_orderkey", S.concat_keys("c_mktsegment", "o_orderpriority").alias("seg_prio"),
                     S.concat_keys("c_mktsegment", "o_orderpriority", "o_orderstatus").alias("seg_prio_status"),
                     S.concat_keys("c_nationkey", "o_orderstatus").alias("nation_status"))


# ---- T10-T12 ---------------------------------------------------------------------------

@register("flag_repeated_chars", sql="""
SELECT o_orderkey, CAST(len(list_distinct(string_split(CAST(o_orderkey AS VARCHAR), ''))) <
       length(CAST(o_orderkey AS VARCHAR)) AS INTEGER) AS repeated FROM orders""")
def flag_repeated_chars(spark, d):
    return tbl(spark, d, "orders").select("o_orderkey", S.has_repeated_chars("o_orderkey").alias("repeated"))


@register("flag_palindrome", sql="""
SELECT o_orderkey, CAST(CAST(o_orderkey AS VARCHAR) = reverse(CAST(o_orderkey AS VARCHAR)) AS INTEGER) AS mirror
FROM orders""")
def flag_palindrome(spark, d):
    return tbl(spark, d, "orders").select("o_orderkey", S.is_palindrome("o_orderkey").alias("mirror"))


_RUNS = "|".join(S.DIGIT_RUNS)


@register("flag_digit_run", sql=f"""
WITH a AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS s FROM orders)
SELECT o_orderkey, CAST(regexp_matches(CASE WHEN length(s) < 3 THEN lpad(s, 3, '0') ELSE s END, '{_RUNS}')
       AS INTEGER) AS digit_run FROM a""")
def flag_digit_run(spark, d):
    return tbl(spark, d, "orders").select("o_orderkey", S.has_digit_run("o_orderkey").alias("digit_run"))


# ---- T13 -------------------------------------------------------------------------------

EXTRA_MATH = r" $x^2+1=0$ \frac{a}{b} √2 π∑∫∞ 3x y2 a<b>c*d/e-f"


def _clean_sql(expr: str) -> str:
    s = expr
    for sym, word in S.MATH_SYMBOLS:
        s = f"replace({s}, '{sym}', '{word}')"
    for pat, rep in S.MATH_CLEAN_STEPS:
        rep_sql = rep.replace("$1", "\\1").replace("$2", "\\2")
        s = f"regexp_replace({s}, '{pat}', '{rep_sql}', 'g')"
    return f"lower(trim({s}))"


@register("clean_text", sql=f"""
SELECT item_id, {_clean_sql("coalesce(text, '') || '" + EXTRA_MATH + "'")} AS cleaned FROM benchmark""")
def clean_text(spark, d):
    b = wide(spark, tbl(spark, d, "benchmark"))
    return b.select("item_id", S.clean_math_text(F.concat(F.coalesce("text", F.lit("")), F.lit(EXTRA_MATH)))
                    .alias("cleaned"))


# ---- T14-T17 ---------------------------------------------------------------------------

@register("text_length", sql="""
SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS length,
       round(ln(1 + length(coalesce(text, ''))), 6) AS log_length FROM documents""")
def text_length(spark, d):
    doc = wide(spark, tbl(spark, d, "documents"))
    n = S.text_length("text")
    return doc.select("doc_id", n.alias("length"), F.round(F.log1p(n), 6).alias("log_length"))


@register("word_count", sql=f"""
SELECT doc_id, CAST(len({_tokens_sql("coalesce(text, '')")}) AS BIGINT) AS word_count FROM documents""")
def word_count(spark, d):
    return wide(spark, tbl(spark, d, "documents")).select("doc_id", S.word_count("text").cast("long").alias("word_count"))


TOPIC_PATTERNS = {"num_count": r"\p{Nd}+", "symbol_count": math_prob.SYMBOLS, **math_prob.TOPICS}


@register("regex_counts", sql="SELECT doc_id, " + ", ".join(
    f"CAST(len(regexp_extract_all(lower(coalesce(text, '')), '{p}')) AS BIGINT) AS {n}"
    for n, p in TOPIC_PATTERNS.items()) + " FROM documents")
def regex_counts(spark, d):
    doc = wide(spark, tbl(spark, d, "documents"))
    low = F.lower(F.coalesce("text", F.lit("")))
    return doc.select("doc_id", *[S.regex_count(low, p).alias(n) for n, p in TOPIC_PATTERNS.items()])


KEYWORDS = math_prob.FLAGS


@register("keyword_flags", sql="SELECT doc_id, " + ", ".join(
    "CAST(" + " OR ".join(f"contains(lower(coalesce(text, '')), '{w}')" for w in ws) + f" AS INTEGER) AS {n}"
    for n, ws in KEYWORDS.items()) + " FROM documents")
def keyword_flags(spark, d):
    doc = wide(spark, tbl(spark, d, "documents"))
    low = F.lower(F.coalesce("text", F.lit("")))
    return doc.select("doc_id", *[S.contains_any(low, ws).alias(n) for n, ws in KEYWORDS.items()])


# ---- T18 -------------------------------------------------------------------------------

TOKEN_SQL = r"[\p{L}\p{N}_]{2,}"


@register("tfidf_terms", sql=f"""
WITH tok AS (SELECT item_id, item_id % 4 <> 0 AS is_train,
               regexp_extract_all(lower(coalesce(text, '')), '{TOKEN_SQL}') AS t FROM benchmark),
grams AS (
  SELECT item_id, is_train, unnest(t) AS term FROM tok
  UNION ALL
  SELECT item_id, is_train, t[i] || ' ' || t[i + 1] AS term
  FROM (SELECT item_id, is_train, t, unnest(range(1, len(t))) AS i FROM tok WHERE len(t) > 1)),
tf AS (SELECT item_id, is_train, term, count(*) AS tf FROM grams GROUP BY ALL),
ndocs AS (SELECT count(*) AS n FROM benchmark WHERE item_id % 4 <> 0),
stats AS (SELECT term, sum(tf) AS freq, count(*) AS df FROM tf WHERE is_train GROUP BY term),
vocab AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM stats, ndocs
          ORDER BY freq DESC, term ASC LIMIT 5000),
w AS (SELECT item_id, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
norms AS (SELECT item_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY item_id)
SELECT item_id, term, round(w / norm, 6) AS weight FROM w JOIN norms USING (item_id)""")
def tfidf_terms(spark, d):
    b = wide(spark, tbl(spark, d, "benchmark"))
    model = TfidfLong("item_id", "text", 5000).fit(b.where(F.col("item_id") % 4 != 0))
    return model.transform(b).select("item_id", "term", F.round("weight", 6).alias("weight"))
