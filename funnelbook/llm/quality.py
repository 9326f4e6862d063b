"""Quality classifier with hierarchical empirical Bayes: what a text says, what its path says, what its host says.

A logistic regression gives each document its evidence, a log-likelihood ratio for "bad" (low quality or toxic). Grouped sums of the
soft decisions give every host and every path below it a posterior rate. A path is shrunk towards its host, a host towards
the global rate, each as strongly as the spread between sites says. The path's rate is then the prior of its documents.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Labelled documents that the classifier is fitted on at most: those with the smallest hashed ids.
SAMPLE = 20_000
FEATURES = 1 << 15
#: Probability of "bad" above which a document is rejected.
REJECT = 0.5
_EPS = 1e-6


def _bucket(name: str, share: Column) -> Column:
    return F.concat(F.lit(name), F.least(F.floor(20 * share), F.lit(20)).cast("string"))


def with_features(df: DataFrame) -> DataFrame:
    """Adds ``__words``: distinct words, their beginnings, and bucketed shares of capitals, signs and repeated words of ``text``.

    Only presence counts, so a word is taken once. Words are made in steps of their own, which are not merged, so each text is
    split once.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = df.withColumn("__all", F.array_remove(F.split(F.lower(text), r"\s+"), "")).withColumn("__once", F.array_distinct("__all"))
    n, once = F.size("__all"), F.col("__once")
    chars = F.greatest(F.length(text), F.lit(1))
    taken = lambda pattern: (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / chars
    shape = F.array(
        _bucket("capitals ", taken(r"\p{Lu}+")),
        _bucket("signs ", taken(r"[!-/:-@\[-`{-~]+")),
        _bucket("repeats ", 1 - F.size(once) / F.greatest(n, F.lit(1))),
        F.concat(F.lit("size "), F.floor(F.log2(1.0 + n)).cast("string")),
    )
    starts = lambda k: F.transform(F.filter(once, lambda w: F.length(w) > k), lambda w: F.concat(F.lit("^"), F.substring(w, 1, k)))
    return split.withColumn("__words", F.concat(once, starts(4), starts(6), shape)).drop("__all", "__once")


def _hashed() -> HashingTF:
    return HashingTF(inputCol="__words", outputCol="__features", numFeatures=FEATURES, binary=True)


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Text and class (0 good, 1 low quality or toxic) of at most ``sample`` labelled documents.

    Labels of one id are united: the worst counts. Labels with both values null are none. The sampled labels are
    at most ``sample`` rows of two numbers, so they may go to every task.
    """
    one = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("doc_id IS NOT NULL AND (q IS NOT NULL OR t IS NOT NULL)")
    bad = (F.coalesce("t", F.lit(0)) > 0) | (F.coalesce("q", F.lit(1)) < 1)
    chosen = one.select("doc_id", bad.cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def evidence(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents with ``llr``: log-odds of bad against good from the text alone, without the base rate."""
    train = written(_hashed().transform(with_features(labelled(docs, labels, sample))).select("__features", "label"))
    bad, rows = train.agg(F.sum("label"), F.count("*")).first()  # two numbers
    if not bad or bad == rows:
        return docs.withColumn("llr", F.lit(0.0))
    model = LogisticRegression(
        featuresCol="__features", labelCol="label", probabilityCol="__p", rawPredictionCol="__r", predictionCol="__k",
        family="binomial", regParam=0.02, maxIter=40,
    ).fit(train)
    p = F.least(F.greatest(vector_to_array("__p")[1], F.lit(_EPS)), F.lit(1 - _EPS))
    scored = model.transform(_hashed().transform(with_features(docs)).drop("__words"))
    return scored.withColumn("llr", F.log(p / (1 - p)) - F.log(F.lit(bad / (rows - bad)))).drop("__features", "__p", "__r", "__k")


def _strength(rates: DataFrame, rate: str, mean: str, n: str) -> DataFrame:
    """Weight of the prior by the method of moments: how many documents of a site the common rate is worth.

    The variance of site rates beyond what their sizes explain is the spread between sites; large spread, weak prior.
    """
    inside = F.col(mean) * (1 - F.col(mean))
    spread = F.greatest(
        F.sum(F.col(n) * ((F.col(rate) - F.col(mean)) ** 2 - inside / F.col(n))) / F.sum(n), F.avg(inside) * 1e-3
    )
    return rates.agg(F.least(F.greatest(F.avg(inside) / spread - 1, F.lit(1.0)), F.lit(1000.0)).alias("m"))


def site_rates(scored: DataFrame) -> DataFrame:
    """``host``, ``path``, ``prior``: posterior rate of bad documents of every path. ``scored`` has host, path and llr."""
    soft = 1 / (1 + F.exp(-F.col("llr")))
    paths = written(scored.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum(soft).alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()  # one row
    mean = min(max((total["s"] or 0.0) / (total["n"] or 1.0), _EPS), 1 - _EPS)
    hosts = hosts.withColumn("rate", F.col("hs") / F.col("hn")).withColumn("mean", F.lit(mean))
    m = _strength(hosts, "rate", "mean", "hn").first()["m"] or 1.0  # one number
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("hs") + m * mean) / (F.col("hn") + m)).alias("mean"))
    below = paths.join(hosts, F.expr("host <=> h")).select("host", "path", "n", "s", "mean", (F.col("s") / F.col("n")).alias("rate"))
    k = _strength(below, "rate", "mean", "n").first()["m"] or 1.0
    return below.select("host", "path", ((F.col("s") + k * F.col("mean")) / (F.col("n") + k)).alias("prior"))


def judge(
    docs: DataFrame, labels: DataFrame, *, host: str = "source", path: str = "lang", sample: int = SAMPLE, reject: float = REJECT,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``host``, ``path``, ``llr``, ``prior``, ``p_bad`` and ``rejected`` of every row, with its columns ``keep``.

    ``docs`` has doc_id, text and the columns named as ``host`` and ``path`` (whatever groups texts below a host: a
    directory, a section, a language). Null and empty texts are judged by their shape and site like any other; null hosts and
    paths are a site of their own. A document counts in the rate of its own site. Repeated rows each give a row and count each time. Without labels of both kinds the
    evidence is 0 and nothing is rejected unless its site says so, which it then cannot. Empty tables give no rows.

    Scores are written once to the shared folder; sites are summed in each task before the shuffle, so a host with a third
    of all rows costs one row a task. Only the fit sees a sample, of at most ``sample`` labelled rows; sums cover all rows.
    """
    kept = docs.select("doc_id", "text", F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), *(c for c in keep if c != "text"))
    scored = written(evidence(kept, labels, sample).select("doc_id", "host", "path", "llr", *keep))
    rates = site_rates(scored.select("host", "path", "llr")).withColumnsRenamed({"host": "__h", "path": "__p"})
    both = scored.join(rates, F.expr("host <=> __h AND path <=> __p"), "left")
    odds = F.col("llr") + F.log(F.col("prior") / (1 - F.col("prior")))
    return both.select("doc_id", "host", "path", "llr", "prior", *keep, (1 / (1 + F.exp(-odds))).alias("p_bad")).withColumn("rejected", F.col("p_bad") > reject)
