"""TF-IDF over uni- and bi-grams (T18) and the sparse feature block.

Long form first: (doc, term, tf) rows from ``explode``, corpus statistics by
aggregation, the vocabulary as a top-k (each task keeps only its best k), the
idf and the L2 norm as joins of small or per-document tables.  The text is
never cut: every token of every document counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core import Estimator, Model, col_of, cut_lineage, materialize

# Python's (?u)\b\w\w+\b: maximal runs of two or more word characters.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def word_tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(col_of(c), F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def uni_bi_grams(c) -> Column:
    t = word_tokens(c)
    bigrams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - 1, F.lit(1))),
                          lambda i: F.concat(F.element_at(t, i), F.lit(" "), F.element_at(t, i + 1)))
    bigrams = F.when(F.size(t) > 1, bigrams).otherwise(F.array().cast("array<string>"))
    return F.concat(t, bigrams)


#: Counters per row of the summary, and its rows.
COUNTERS, COUNTER_ROWS = 1 << 18, 2
#: Corpora with no more terms than this are counted directly.
DIRECT_TERMS = 5_000_000


def _counter(term, row: int, counters: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), term), F.lit(counters)).cast("int")


def _recount(grams: DataFrame) -> DataFrame:
    """Exact (term, freq, df) of (term, first) rows; ``first`` marks a term's first place in its document."""
    return grams.groupBy("term").agg(F.count(F.lit(1)).alias("freq"), F.sum(F.col("first").cast("long")).alias("df"))


def top_terms(grams: DataFrame, size: int, counters: int = COUNTERS) -> DataFrame:
    """The ``size`` most frequent terms (ties: the smaller term) with exact freq and df, without a
    shuffle of all terms.

    1. A summary of ``COUNTER_ROWS`` x ``counters`` hash counters: every task adds its terms up in
       them, so the shuffle is bounded by counters x tasks.  A term's counter is never below
       its frequency.
    2. Terms in the heaviest counters of every row are recounted exactly.  The ``size``-th frequency
       among them is a lower bound of the true one.
    3. If no other counter reaches the bound, these are the top terms.  Otherwise all terms whose
       counters reach the bound are recounted, which holds every term of that frequency.
    """
    cells = F.array(*[F.struct(F.lit(r).alias("r"), _counter(F.col("term"), r, counters).alias("c")) for r in range(COUNTER_ROWS)])
    table = cut_lineage(grams.select(F.explode(cells).alias("e")).groupBy("e.r", "e.c").agg(F.count(F.lit(1)).alias("n")))

    def recounted(least: int) -> DataFrame:
        rows = grams
        for r in range(COUNTER_ROWS):  # at most ``counters`` numbers a row
            heavy = table.where((F.col("r") == r) & (F.col("n") >= least)).select(F.col("c").alias(f"c{r}"))
            rows = rows.join(F.broadcast(heavy), _counter(F.col("term"), r, counters) == F.col(f"c{r}"), "left_semi")
        return _recount(rows).orderBy(F.desc("freq"), F.asc("term")).limit(size)
    rank = min(4 * size, counters)
    edge = table.where("r = 0").orderBy(F.desc("n")).limit(rank).agg(F.count("*").alias("k"), F.min("n").alias("n")).first()
    least = edge["n"] if edge["k"] == rank else 1  # fewer counters in use: all of them
    top = cut_lineage(recounted(least))
    if least > 1:
        got = top.agg(F.count("*").alias("k"), F.min("freq").alias("n")).first()
        bound = got["n"] if got["k"] == size else 1
        if bound < least:  # terms of this frequency may lie in lighter counters
            top = cut_lineage(recounted(bound))
    return top


def gram_rows(df: DataFrame, text: str) -> DataFrame:
    """(term, first) per term of every document; in a sorted bag of terms a term's first place
    differs from the place before it."""
    bags = df.select(F.array_sort(uni_bi_grams(text)).alias("g"))
    marked = F.transform("g", lambda t, i: F.struct(t.alias("term"), ((i == 0) | (F.get("g", i - 1) != t)).alias("first")))
    return bags.select(F.explode(marked).alias("e")).select("e.term", "e.first")


class TfidfLong(Estimator):
    """sklearn-style TF-IDF: raw counts, vocabulary = ``max_features`` most
    frequent terms of the fitting corpus (ties by term), smooth idf
    ``ln((1+n)/(1+df)) + 1``, L2 norm per document over the kept terms.
    One row is one document; ``doc`` tells documents apart when scoring."""

    def __init__(self, doc: str, text: str, max_features: int = 5000, direct_terms: int = DIRECT_TERMS):
        self.doc, self.text, self.max_features, self.direct_terms = doc, text, max_features, direct_terms

    def fit(self, df: DataFrame) -> "TfidfLongModel":
        grams = gram_rows(df, self.text)
        size = df.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size(uni_bi_grams(self.text))).alias("terms")).first()
        if (size["terms"] or 0) <= self.direct_terms:
            top = _recount(grams).orderBy(F.desc("freq"), F.asc("term")).limit(self.max_features)
        else:
            top = top_terms(grams, self.max_features)
        vocab = top.withColumn("idf", F.log((F.lit(1.0) + size["docs"]) / (F.lit(1.0) + F.col("df"))) + 1.0)
        return TfidfLongModel(self.doc, self.text, materialize(vocab.select("term", "idf"), max_rows=max(self.max_features, 1)))


class TfidfLongModel(Model):
    def __init__(self, doc, text, vocab):
        self.doc, self.text, self.vocab = doc, text, vocab

    def transform(self, df: DataFrame) -> DataFrame:
        """(doc, term, weight) for every document and kept term it contains.

        Only kept terms leave the scan; counts and norms share one shuffle by document."""
        kept = self.vocab.attach(df.select(self.doc, F.explode(uni_bi_grams(self.text)).alias("term")), ["term"], "inner")
        tf = (kept.repartition(self.doc).groupBy(self.doc, "term", "idf").agg(F.count(F.lit(1)).alias("tf"))
              .withColumn("w", F.col("tf") * F.col("idf")))
        # a document holds at most max_features kept terms
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(self.doc)))
        return tf.select(self.doc, "term", (F.col("w") / norm).alias("weight"))


def tfidf_vector_pipeline(text: str, output: str = "tfidf", max_features: int = 5000):
    """Spark ML stages producing the sparse TF-IDF block for a model.

    ``RegexTokenizer`` with the word pattern, ``NGram(2)``, one
    ``CountVectorizer`` over both, ``IDF`` whose weights get the +1 of the
    smooth form through an ``ElementwiseProduct`` fitted after the IDF, then
    ``Normalizer(2)``.  Returns an estimator-like object with ``fit``.
    """
    return _TfidfVectorizer(text, output, max_features)


class _TfidfVectorizer(Estimator):
    def __init__(self, text, output, max_features):
        self.text, self.output, self.max_features = text, output, max_features

    def fit(self, df: DataFrame):
        from pyspark.ml import Pipeline, PipelineModel
        from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, NGram, Normalizer,
                                        RegexTokenizer, SQLTransformer)
        from pyspark.ml.linalg import Vectors
        tok = RegexTokenizer(inputCol=self.text, outputCol="__tok", pattern=TOKEN_PATTERN, gaps=False,
                             toLowercase=True)
        bi = NGram(n=2, inputCol="__tok", outputCol="__bi")
        both = SQLTransformer(statement="SELECT *, concat(__tok, __bi) AS __terms FROM __THIS__")
        cv = CountVectorizer(inputCol="__terms", outputCol="__tf", vocabSize=self.max_features)
        idf = IDF(inputCol="__tf", outputCol="__unused")
        fitted = Pipeline(stages=[tok, bi, both, cv, idf]).fit(df)
        idf_vec = fitted.stages[-1].idf.toArray() + 1.0
        scale = ElementwiseProduct(scalingVec=Vectors.dense(idf_vec), inputCol="__tf", outputCol="__w")
        norm = Normalizer(p=2.0, inputCol="__w", outputCol=self.output)
        return PipelineModel(stages=fitted.stages[:-1] + [scale, norm])
