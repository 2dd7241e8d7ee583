"""TF-IDF space over the most frequent words, and its top terms."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions.text import has_text, words
from postweave.operators.terms import top_terms


def vector_words(posts: DataFrame) -> Column:
    """Words for the vector space: prepared tokens as they are, other text by runs of two or more
    letters, digits or underscores."""
    if "tokens" in posts.columns:
        return words(posts)
    text = F.lower(F.coalesce(F.col("clean_text").cast("string"), F.lit("")))
    return F.regexp_extract_all(text, F.lit(r"(?U)(\w{2,})"), F.lit(1))


def _documents(posts: DataFrame, *keep: str) -> DataFrame:
    """Posts with text, as the kept columns and ``tokens``."""
    filled = F.size("tokens") > 0 if "tokens" in posts.columns else has_text(F.coalesce("clean_text", F.lit("")))
    return posts.where(filled).select(*keep, vector_words(posts).alias("tokens"))


@dataclass(frozen=True)
class TfidfSpace:
    """Vocabulary (most frequent first), inverse document frequencies and number of documents.

    Its size is fixed by the number of features, not by the data.
    """

    vocabulary: tuple[str, ...]
    idf: tuple[float, ...]
    documents: int

    def leading(self, max_features: int) -> TfidfSpace:
        """The space of the most frequent words only; a word's weight does not depend on the others."""
        return TfidfSpace(self.vocabulary[:max_features], self.idf[:max_features], self.documents)

    def vectors(self, posts: DataFrame, *keep: str) -> DataFrame:
        """The kept columns and ``features``: weights scaled to length 1 within the vocabulary."""
        counted = self._counts(_documents(posts, *keep))
        weighted = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weights"
        ).transform(counted)
        unit = Normalizer(p=2.0, inputCol="_weights", outputCol="features").transform(weighted)
        return unit.select(*keep, "features")

    def _counts(self, documents: DataFrame) -> DataFrame:
        model = CountVectorizerModel.from_vocabulary(list(self.vocabulary), inputCol="tokens", outputCol="_counts")
        return model.transform(documents)


def fit_tfidf(
    posts: DataFrame, max_features: int = settings.TFIDF_VOCABULARY, vocabulary: list[str] | None = None
) -> TfidfSpace:
    """Fit the space: the ``max_features`` most frequent words and their document counts.

    Two jobs: one word count, one pass for the document counts (word counts of a post are made row
    by row from the broadcast vocabulary, so no text is shuffled). Only the vocabulary and its
    weights, at most ``max_features`` of each, come to the driver.
    """
    documents = _documents(posts)
    if vocabulary is None:
        vocabulary = [row.term for row in top_terms(documents, max_features).collect()]
    else:
        vocabulary = list(vocabulary[:max_features])
    if not vocabulary:
        return TfidfSpace((), (), 0)
    counted = TfidfSpace(tuple(vocabulary), (), 0)._counts(documents)
    found = counted.agg(F.count(F.lit(1)).alias("n"), Summarizer.numNonZeros(F.col("_counts")).alias("df")).first()
    n = int(found.n)
    idf = tuple(log((1 + n) / (1 + df)) + 1 for df in found.df)
    return TfidfSpace(tuple(vocabulary), idf, n)


def top_tfidf_terms(
    posts: DataFrame,
    n: int = settings.TOP_WORDS,
    max_features: int = settings.TFIDF_VOCABULARY,
    space: TfidfSpace | None = None,
) -> DataFrame:
    """The words with the highest mean weight over all posts with text.

    The posts are read three times when no fitted space is given; pass a stored frame.
    """
    spark = posts.sparkSession
    space = fit_tfidf(posts, max_features) if space is None else space
    if not space.vocabulary:
        return spark.createDataFrame([], "term string, score double")
    means = space.vectors(posts).agg(Summarizer.mean(F.col("features")).alias("mean"))
    scores = means.select(F.posexplode(vector_to_array("mean")).alias("i", "score"))
    terms = spark.createDataFrame(list(enumerate(space.vocabulary)), "i int, term string")
    return scores.join(F.broadcast(terms), "i").select("term", "score").orderBy(F.desc("score"), "term").limit(n)
