"""URL filter: host and path rules, then gradient-boosted trees on lexical features.

The trees learn from labelled URLs.  Their features are lexical (lengths,
depth, digit share, entropy, parameter counts) plus smoothed block rates of
the host's suffixes and of the first path segment, counted on other labelled
rows than those the trees see, so a tree cannot read a row's own label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_TRAIN_ROWS = 20_000      # labelled rows the trees are fitted on, about; suffixes are counted on all others
TREES, DEPTH, SEED = 10, 4, 7
PRIOR = 4.0                  # rows by which a rate is drawn to the mean


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Host of a URL, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), "^([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """Path of a URL up to ``?`` or ``#``; empty for null or without ``://``."""
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def first_rule(rules: tuple[Rule, ...], host_: Column, path_: Column, part) -> Column:
    """``part`` of the longest fitting rule (ties: by its text), else null.
    ``rules`` is a hand-written list: each is one branch of the expression."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host_ == rule.host) | host_.endswith(f".{rule.host}")) & path_.startswith(rule.path)
        chosen = F.when(fits, F.lit(part(rule))).otherwise(chosen)
    return chosen


def _entropy(text: Column) -> Column:
    """Bits per character over printable ASCII (94 kinds at most)."""
    plain = F.regexp_replace(text, r"[^\x21-\x7e]", "")

    def of(s: Column) -> Column:
        shares = F.transform(
            F.array_distinct(F.split(s, "")),
            lambda c: F.when(c == "", F.lit(0.0)).otherwise(
                (F.length(s) - F.length(F.replace(s, c, F.lit("")))) / F.length(s)))
        return F.aggregate(shares, F.lit(0.0), lambda t, p: t - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))

    return F.when(F.length(plain) > 0, let(plain, of)).otherwise(F.lit(0.0))


def _longest(text: Column) -> Column:
    parts = F.transform(F.split(text, r"[/.?&=#_-]"), lambda p: F.length(p))
    return F.coalesce(F.array_max(parts), F.lit(0))


LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digit_share", "host_digit_share", "hyphens",
           "parameters", "query_length", "fragment", "escapes", "secure", "longest_part", "entropy", "host_entropy")
STATISTICS = ("top_rate", "domain_rate", "host_rate", "segment_rate")


def features(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, the lexical features and the keys of
    the suffix statistics.  A null URL has the features of an empty one."""
    text = F.coalesce(F.col(url), F.lit(""))

    def count_of(c: Column, characters: str) -> Column:
        return (F.length(c) - F.length(F.translate(c, characters, ""))).cast("double")

    def share(c: Column) -> Column:
        return count_of(c, "0123456789") / F.greatest(F.length(c), F.lit(1))

    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    h, p = F.col("host"), F.col("path")
    labels = F.split(h, "[.]")
    named = urls.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    values = {
        "length": F.length(text), "host_length": F.length(h), "path_length": F.length(p),
        "depth": F.size(F.filter(F.split(p, "/"), lambda s: s != "")), "labels": F.size(labels),
        "digit_share": share(text), "host_digit_share": share(h), "hyphens": count_of(h, "-_"),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda s: s != "")), "query_length": F.length(query),
        "fragment": F.instr(text, "#") > 0, "escapes": count_of(text, "%"), "secure": F.lower(text).startswith("https:"),
        "longest_part": _longest(text), "entropy": _entropy(text), "host_entropy": _entropy(h)}
    return named.withColumns({k: v.cast("double") for k, v in values.items()} | {
        "k_top": F.element_at(labels, -1), "k_domain": F.substring_index(h, ".", -2), "k_host": h,
        "k_segment": F.element_at(F.split(F.concat(p, F.lit("/")), "/"), 2)})


class UrlModel:
    """Suffix statistics and boosted trees; ``default`` where the labels hold one class or none."""

    def __init__(self, rates: dict[str, DataFrame], base: float, trees, default: int):
        self.rates, self.base, self.trees, self.default = rates, base, trees, default

    def with_rates(self, rows: DataFrame) -> DataFrame:
        """Equi joins with the statistics; an unseen suffix has the mean rate."""
        for name, rate in self.rates.items():
            rows = rows.join(rate, f"k_{name}", "left").withColumn(
                f"{name}_rate", F.coalesce(f"{name}_rate", F.lit(self.base)))
        return rows

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``features`` with ``blocked`` (0 or 1)."""
        if self.trees is None:
            return rows.withColumn("blocked", F.lit(self.default))
        scored = self.trees.transform(_assembled(self.with_rates(rows)))
        return scored.withColumn("blocked", F.col("prediction").cast("int")).drop(
            "features", "rawPrediction", "probability", "prediction")


def _assembled(rows: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features").transform(rows)


def fit(labelled: DataFrame, label: str = "label", url: str = "url", max_rows: int = MAX_TRAIN_ROWS,
        trees: int = TREES, depth: int = DEPTH) -> UrlModel:
    """Fit on labelled URLs (``label`` 1: block, 0: allow; null: not used).

    The trees are fitted on about ``max_rows`` rows taken by hash of the URL, at most half of them; the suffix
    statistics are counted on all others.
    """
    from pyspark.ml.classification import GBTClassifier

    known = labelled.where(F.col(label).isNotNull())
    n = known.count()
    part = F.pmod(F.xxhash64(F.coalesce(F.col(url), F.lit(""))), F.lit(1 << 20))
    wanted = min(1 << 19, -(-(1 << 20) * max_rows // max(n, 1)))
    known = known.select(F.col(url), F.col(label).cast("int").alias("label"), (part < wanted).alias("fitted"))
    means = {r["fitted"]: r for r in known.groupBy("fitted").agg(F.avg("label").alias("m"), F.count("*").alias("n")).collect()}
    total = sum(r["n"] for r in means.values())
    base = sum(r["m"] * r["n"] for r in means.values()) / total if total else 0.0
    default = int(base > 0.5)
    if len(means) < 2 or not 0 < means[True]["m"] < 1:
        return UrlModel({}, base, None, default)
    names = ("top", "domain", "host", "segment")
    counted = stored(features(known.where("not fitted"), url).groupBy(*(f"k_{name}" for name in names)).agg(
        F.sum("label").alias("hits"), F.count("*").alias("n")), "url-counts")
    rates = {
        name: stored(counted.groupBy(f"k_{name}").agg(
            ((F.sum("hits") + PRIOR * base) / (F.sum("n") + PRIOR)).alias(f"{name}_rate")), f"{name}-rates")
        for name in names}
    model = UrlModel(rates, base, None, default)
    train = _assembled(model.with_rates(features(known.where("fitted"), url))).select("features", "label")
    model.trees = GBTClassifier(maxIter=trees, maxDepth=depth, seed=SEED, maxBins=32).fit(stored(train, "url-train"))
    return model


def judge(urls: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None,
          url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (text of the rule that decides, else
    null) and ``verdict`` (``allow`` or ``block``), which replace columns of those names.

    A rule decides where one fits, the trees elsewhere.  Without ``labelled`` the trees learn from the
    URLs that a rule judged.  Null and malformed URLs have empty host and path and are judged by
    the trees; an empty table gives no rows.
    """
    asked = urls.select(F.struct(*urls.columns).alias("__row"), F.col(url).alias("__url")).withColumns(
        {"host": host(F.col("__url")), "path": path(F.col("__url"))})
    ruled = asked.withColumns({"rule": first_rule(rules, F.col("host"), F.col("path"), lambda r: r.text),
                               "ruled": first_rule(rules, F.col("host"), F.col("path"), lambda r: r.verdict)})
    if labelled is None:
        label = F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("int"))
        model = fit(ruled.select("__url", label.alias("label")), url="__url")
    else:
        model = fit(labelled, url=url)
    guessed = model.predict(features(ruled, "__url"))
    guess = F.when(F.col("blocked") == 1, F.lit("block")).otherwise(F.lit("allow"))
    keep = [F.col(f"__row.{c}") for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    return guessed.select(*keep, "host", "path", "rule", F.coalesce("ruled", guess).alias("verdict"))
