"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Everything here is a DataFrame expression or a Spark ML estimator on the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = LOWER + "0123456789-_./"

#: The default rules, (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Labelled urls that the trees are fitted on, about, suffixes whose statistics are kept, and folds that these are taken over.
TRAIN_ROWS, SUFFIXES, FOLDS = 20_000, 2_000, 5
#: Places to which the first label of a host and the first word of a path are hashed, each with a column of its own.
PLACES = 16
FEATURES = [
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_longest_label", "f_first_word", "f_letters", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_suffix_rate", "f_suffix_count",
    *[f"f_host_{k}" for k in range(PLACES)], *[f"f_path_{k}" for k in range(PLACES)],
]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path. Null, or a url without ://, has both empty."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def first_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host + path) and its verdict; null if none does. ``rules`` is a short list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Bits a symbol over letters, digits and - _ . / of a lower-case text; 0 for the empty text."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def term(c: str) -> Column:
        p = (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))) / n
        return F.when(p > 0, -p * F.log2(p)).otherwise(0.0)

    return reduce(lambda a, b: a + b, (term(c) for c in SYMBOLS))


def features(urls: DataFrame) -> DataFrame:
    """``urls`` has page_id, url, host, path; adds the lexical columns but for suffix statistics."""
    url = F.coalesce("url", F.lit(""))
    count = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    first_label, first_word = F.element_at(F.split("host", r"\."), 1), F.lower(F.regexp_extract("path", "^/+([^/]*)", 1))
    place = lambda c, k: (F.pmod(F.xxhash64(c), F.lit(PLACES)) == k).cast("double")
    return urls.select(
        "*",
        F.length("host").cast("double").alias("f_host_length"),
        F.array_max(F.transform(F.split("host", r"\."), F.length)).cast("double").alias("f_longest_label"),
        F.length(first_word).cast("double").alias("f_first_word"),
        (count(F.col("host"), "[a-z]") / F.greatest(F.length("host"), F.lit(1)).cast("double")).alias("f_letters"),
        *[place(first_label, k).alias(f"f_host_{k}") for k in range(PLACES)],
        *[place(first_word, k).alias(f"f_path_{k}") for k in range(PLACES)],
        F.length(url).cast("double").alias("f_length"),
        F.length("path").cast("double").alias("f_path_length"),
        count(F.col("path"), "/").cast("double").alias("f_depth"),
        F.size(F.split("host", r"\.")).cast("double").alias("f_labels"),
        (count(url, "[0-9]") / n).alias("f_digits"),
        entropy(F.concat("host", F.translate("path", UPPER, LOWER))).alias("f_entropy"),
        count(F.regexp_extract(url, r"\?([^#]*)", 1), "=").cast("double").alias("f_params"),
        count(F.col("host"), "-").cast("double").alias("f_hyphens"),
        F.element_at(F.split("host", r"\."), -1).alias("suffix"),
    )


def suffix_rates(labelled: DataFrame, suffixes: int = SUFFIXES) -> DataFrame:
    """(suffix, fold, f_suffix_rate, f_suffix_count): smoothed share of blocked urls and their number, for the ``suffixes`` most frequent
    host suffixes of the labelled urls; of a fold, without the urls of that fold; of fold -1, over all.

    In fold 0 no suffix is known, so that the trees also learn what to say where they have met none."""
    sums = labelled.groupBy("suffix", "fold").agg(F.sum("label").alias("_b"), F.count(F.lit(1)).alias("_n"))
    total = sums.groupBy("suffix").agg(F.sum("_b").alias("_blocked"), F.sum("_n").alias("_all")).orderBy(F.desc("_all"), "suffix").limit(suffixes)
    every = total.select("suffix", "_blocked", "_all", F.explode(F.array(*[F.lit(k) for k in (-1, *range(1, FOLDS))])).alias("fold")).join(sums, ["suffix", "fold"], "left").fillna(0, ["_b", "_n"])
    n = F.col("_all") - F.col("_n")
    return every.select("suffix", "fold", ((F.col("_blocked") - F.col("_b") + 1) / (n + 2)).alias("f_suffix_rate"), F.log1p(n.cast("double")).alias("f_suffix_count"))


def _known(urls: DataFrame, rates: DataFrame, fold: Column) -> DataFrame:
    """``urls`` with their features as a vector; an unknown suffix has rate one half of no url. ``rates`` has 5 rows a suffix, so at most 5 * ``suffixes``."""
    joined = urls.withColumn("fold", fold).join(F.broadcast(rates), ["suffix", "fold"], "left").fillna({"f_suffix_rate": 0.5, "f_suffix_count": 0.0})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)


def _learned(labelled: DataFrame, total: int, train_rows: int, suffixes: int):
    """The trees, fitted on about ``train_rows`` of the labelled urls (label, suffix, features), their calibration on a fifth of these that the trees
    have not seen (None where it has one class), and the suffix table; None where one class is left."""
    folded = labelled.withColumn("fold", F.pmod(F.xxhash64("url", "page_id", F.lit(1)), F.lit(FOLDS)).cast("int"))
    rates = materialize(suffix_rates(folded, suffixes), "url-suffixes")
    share = min(1.0, train_rows / max(1, total))
    sample = folded.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1_000_000)) < F.lit(round(share * 1_000_000)))
    late = F.pmod(F.xxhash64("url", F.lit(3)), F.lit(5)) == 0
    train = materialize(_known(sample.withColumn("late", late), rates, F.col("fold")).select("features", "label", "late"), "url-train")
    classes = {(r["late"], r["label"]) for r in train.select("late", "label").distinct().collect()}
    whole = len({c for x, c in classes if not x}) < 2  # too few for a part of their own
    if len({c for _, c in classes}) < 2:
        return None
    model = GBTClassifier(maxIter=40, maxDepth=4, stepSize=0.15, seed=7).fit(train if whole else train.where(~F.col("late")))
    calibration = None
    if not whole and len({c for x, c in classes if x}) == 2:
        calibration = IsotonicRegression(featuresCol="probability", featureIndex=1, labelCol="label", predictionCol="score").fit(model.transform(train.where("late")).drop("prediction"))
    return model, calibration, rates


def _scored(urls: DataFrame, learned, fold: Column) -> DataFrame:
    """``urls`` with score, the probability that a url is to be blocked."""
    model, calibration, rates = learned
    found = model.transform(_known(urls, rates, fold)).drop("prediction")
    return calibration.transform(found) if calibration else found.withColumn("score", vector_to_array("probability")[1])


def _ruled(pages: DataFrame, rules, id_col: str, url_col: str) -> tuple[DataFrame, DataFrame]:
    """All urls with their rule, its verdict and their features; and those of them that a rule labels."""
    host, path = parts(F.col(url_col))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    urls = features(base.select("*", rule.alias("rule"), verdict.alias("ruled")))
    return urls, urls.where("ruled is not null").withColumn("label", F.when(F.col("ruled") == "block", 1.0).otherwise(0.0))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", train_rows: int = TRAIN_ROWS, suffixes: int = SUFFIXES) -> DataFrame:
    """One row for each row of ``pages``: id, host, path, rule, verdict.

    Urls that a rule fits are the labelled ones; the trees are fitted on a sample of about
    ``train_rows`` of them, chosen by hash. Rows without a rule take the trees' verdict. With
    labels of one class only, or none, there is no tree and that class, or allow, is the verdict.
    Null, empty, very long and repeated urls are judged like any other; of rules of one length that fit, the last in
    ``rules`` holds; an empty table gives no row; extra columns are left aside.
    """
    urls, labelled = _ruled(pages, rules, id_col, url_col)
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = lambda df, other: df.select(F.col("page_id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", other).alias("verdict"))
    if len(counts) < 2:
        return out(urls, F.lit("block" if counts.get(1.0) else "allow"))
    learned = _learned(labelled, sum(counts.values()), train_rows, suffixes)
    if learned is None:
        return out(urls, F.lit("block" if counts[1.0] > counts[0.0] else "allow"))
    return out(_scored(urls, learned, F.lit(-1)), F.when(F.col("score") > 0.5, "block").otherwise("allow"))


def measured(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", train_rows: int = TRAIN_ROWS, suffixes: int = SUFFIXES) -> tuple[DataFrame, list[float]]:
    """How the trees do on labelled urls that they have not seen, a fifth by hash: by suffix n, n_block, n_right, n_majority (right if the verdict that most
    labelled urls of the learning part have were always given) and log_loss, and the importance of each of ``FEATURES``. Needs urls of both classes."""
    _, labelled = _ruled(pages, rules, id_col, url_col)
    kept = F.pmod(F.xxhash64("url", F.lit(2)), F.lit(5)) == 0
    learning = labelled.where(~kept)
    seen = learning.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("block")).first()
    learned = _learned(learning, seen["n"], train_rows, suffixes)
    scored = _scored(labelled.where(kept), learned, F.lit(-1))
    p = F.greatest(F.least("score", F.lit(0.999)), F.lit(0.001))
    loss = -F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p))
    found = scored.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("n_block"), F.count_if((F.col("score") > 0.5) == (F.col("label") == 1)).alias("n_right"), F.count_if(F.col("label") == F.lit(float(seen["block"] >= 0.5))).alias("n_majority"), F.avg(loss).alias("log_loss"))
    return found, list(learned[0].featureImportances.toArray())
