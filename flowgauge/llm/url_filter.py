"""URL filter: host rules first, then gradient-boosted trees on lexical features. DataFrame and SQL functions only."""

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.tables import stored

#: (host, path, verdict): the longest rule that fits decides.
Rule = tuple[str, str, str]
#: Labelled URLs that a suffix's block rate is drawn toward the overall one by.
PRIOR = 20.0

FEATURES = (
    "url_length", "host_length", "path_length", "path_depth", "host_labels", "hyphens", "host_hyphens", "digit_ratio",
    "host_digit_ratio", "letter_entropy", "host_entropy", "longest_label", "vowel_ratio", "parameters", "query_length",
    "has_fragment", "is_https", "marks", "suffix_share", "suffix_rate",
)


def url_host(url: str | Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z as a-z; empty without ``://`` or for null."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: str | Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_rule(host: str, path: str, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule as ``host/path``, its verdict) of the longest rule that fits; null if none does.

    A rule fits its host and the hosts below it, if the path starts with the rule's. The rules are a list that a person
    keeps: they become one expression, so a page is judged without a join.
    """
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = (F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)
        fits = fits & F.col(path).startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    chars = F.array_distinct(F.split(text, ""))

    def part(c: Column) -> Column:
        share = (size - F.length(F.replace(text, c))) / size
        return F.when((c == "") | (share <= 0), F.lit(0.0)).otherwise(-share * F.log2(share))

    return F.when(size > 0, F.aggregate(F.transform(chars, part), F.lit(0.0), lambda a, b: a + b)).otherwise(F.lit(0.0))


def _share(text: Column, kept: str) -> Column:
    """Share of the characters of a class."""
    return F.coalesce(F.length(F.regexp_replace(text, f"[^{kept}]", "")) / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def lexical_features(urls: DataFrame) -> DataFrame:
    """``urls`` (with url, host and path), the features that a URL alone says, and its suffix, the host's last label."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    numbers = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "path_depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "host_labels": F.size(labels),
        "hyphens": F.length(url) - F.length(F.replace(url, F.lit("-"))),
        "host_hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"))),
        "digit_ratio": _share(url, "0-9"),
        "host_digit_ratio": _share(host, "0-9"),
        "letter_entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "longest_label": F.array_max(F.transform(labels, F.length)),
        "vowel_ratio": _share(host, "aeiou"),
        "parameters": F.when(query == "", F.lit(0)).otherwise(F.size(F.split(query, "&"))),
        "query_length": F.length(query),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "is_https": F.startswith(F.lower(url), F.lit("https://")).cast("int"),
        "marks": F.length(F.regexp_replace(url, r"[A-Za-z0-9/.:]", "")),
    }
    return urls.withColumns({k: v.cast("double") for k, v in numbers.items()}).withColumn("suffix", F.element_at(labels, -1))


@dataclass
class UrlModel:
    """Trees, what all labelled URLs say about suffixes, and what is added to the trees' log odds for the true shares."""

    trees: PipelineModel | None
    suffixes: DataFrame
    rate: float
    shift: float = 0.0


def _with_statistics(df: DataFrame, model: UrlModel) -> DataFrame:
    """Suffix figures. There may be any number of suffixes, so the optimizer decides by size how they are joined."""
    joined = df.join(model.suffixes, F.col("suffix") == F.col("_suffix"), "left").drop("_suffix")
    return joined.fillna({"suffix_share": 0.0, "suffix_rate": model.rate})


def fit_urls(labelled: DataFrame, sample: int = 20_000, seed: int = 5, trees: int = 20, depth: int = 4) -> UrlModel:
    """Learn from ``labelled`` (url, host, path, label 0 or 1): trees from at most ``sample`` distinct URLs of each label.

    Shares and smoothed block rates of suffixes are counted on all labelled URLs. The trees' URLs are taken by a hash; their
    log odds are shifted back to the labels' shares among all, so that a score is a probability. A URL that comes with both
    labels counts as 1; other labels and null URLs are passed over. Without both labels no trees are grown and every URL
    scores the smoothed share of label 1.
    """
    rows = labelled.where("label in (0, 1) and url is not null").groupBy("url", "host", "path").agg(F.max("label").cast("double").alias("label"))
    rows = stored(rows.withColumn("suffix", F.element_at(F.split("host", r"\."), -1)), "labelled_urls")
    counts = stored(rows.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("label").alias("bad")), "suffix_counts")
    n, bad = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0.0))).first()
    rate = (bad + 0.5) / (n + 1)
    figures = counts.select(
        F.col("suffix").alias("_suffix"),
        (F.col("n") / F.lit(max(n, 1))).alias("suffix_share"),
        ((F.col("bad") + F.lit(PRIOR * rate)) / (F.col("n") + F.lit(PRIOR))).alias("suffix_rate"),
    )
    model = UrlModel(None, stored(figures, "suffixes"), rate)
    if 0 < bad < n:
        one = [rows.where(F.col("label") == y).orderBy(F.xxhash64("url"), "url").limit(sample) for y in (0, 1)]
        gbt = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, seed=seed, featuresCol="features", labelCol="label")
        steps = Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), gbt])
        # Its rows are few and fixed in number, so their order, which the trees depend on, can be fixed as well.
        train = _with_statistics(lexical_features(one[0].unionAll(one[1])), model).orderBy("url").select(*FEATURES, "label").coalesce(1)
        model.trees = steps.fit(train)
        taken_bad, taken_good = min(bad, sample), min(n - bad, sample)
        model.shift = math.log(bad / (n - bad)) - math.log(taken_bad / taken_good)
    return model


def url_scores(pages: DataFrame, model: UrlModel) -> DataFrame:
    """page_id, url, host, path and ``score``, the chance of label 1, of every row."""
    keep = ["page_id", "url", "host", "path"]
    parts = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns({"host": url_host("url"), "path": url_path("url")})
    if model.trees is None:
        return parts.select(*keep, F.lit(model.rate).alias("score"))
    scored = model.trees.transform(_with_statistics(lexical_features(parts), model))
    # The trees' raw value is half of the log odds.
    odds = 2 * vector_to_array("rawPrediction")[1] + F.lit(model.shift)
    return scored.select(*keep, (1 / (1 + F.exp(-odds))).alias("score"))


def judge_urls(pages: DataFrame, rules: list[Rule], model: UrlModel, limit: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of ``pages`` (page_id, url).

    The longest rule that fits decides; other URLs are blocked if the trees score them ``limit`` or more. A null URL, or
    one without ``://``, has an empty host and path, fits no rule and is judged by its features like any. Repeated rows
    come back once each; other columns are not read.
    """
    scores = url_scores(pages, model)
    name, verdict = url_rule("host", "path", rules)
    by_trees = F.when(F.col("score") >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return scores.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_trees).alias("verdict"), "score")


def labelled_by_words(pages: DataFrame, words: list[str]) -> DataFrame:
    """url, host, path, label: 1 for hosts in which one of the words stands between dots and hyphens.

    A labelled table for ``fit_urls`` where no one has labelled URLs by hand. The words are no feature of the model: it
    learns what such URLs look like.
    """
    parts = pages.select(F.col("url").cast("string").alias("url")).where("url is not null")
    parts = parts.withColumns({"host": url_host("url"), "path": url_path("url")})
    bad = F.arrays_overlap(F.split("host", r"[.\-]"), F.array(*[F.lit(w) for w in words]))
    return parts.withColumn("label", bad.cast("double"))
