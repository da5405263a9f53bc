"""URL filter: host and path rules first, boosted trees over lexical features for the rest.

Everything is a column expression or a Spark ML model; no Python runs on rows.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host_: Column, path_: Column) -> Column:
    """A rule fits its host and all subdomains, where the path starts with the rule's."""
    return ((host_ == rule.host) | host_.endswith("." + rule.host)) & path_.startswith(rule.path)


def longest(rules: list[Rule], host_: Column, path_: Column, value: str) -> Column:
    """The longest fitting rule's ``name`` or ``verdict``, else NULL."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        out = F.when(fits(rule, host_, path_), F.lit(getattr(rule, value))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)

    def part(symbol: Column) -> Column:
        share = (size - F.length(F.replace(text, symbol, F.lit("")))) / size
        return -share * F.log2(share)

    symbols = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(F.transform(symbols, part), F.lit(0.0), lambda a, b: a + b)


def lexical(url: Column, host_: Column, path_: Column) -> dict[str, Column]:
    """Features that a URL's letters give by themselves."""
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))
    found = {
        "url_length": F.length(text), "host_length": F.length(host_), "path_length": F.length(path_),
        "path_depth": F.regexp_count(path_, F.lit("/[^/]")), "host_labels": F.size(F.split(host_, r"\.")),
        "digits": share("[0-9]"), "signs": share("[^A-Za-z0-9]"), "hyphens": F.regexp_count(host_, F.lit("-")),
        "url_entropy": _entropy(text), "host_entropy": _entropy(host_), "path_entropy": _entropy(path_),
        "parameters": F.when(query == "", F.lit(0)).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        "fragment": F.contains(text, F.lit("#")).cast("int"),
        "secure": F.lower(text).startswith("https:").cast("int"),
        "extension": path_.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"),
    }
    return {name: F.coalesce(c.cast("double"), F.lit(0.0)) for name, c in found.items()}


def suffix(host_: Column, labels: int) -> Column:
    """The last labels of a host."""
    return F.substring_index(host_, ".", -labels)


class Filter:
    """Rules, and a model trained on the URLs that they label."""

    SUFFIXES = (1, 2)

    def __init__(self, rules: list[Rule], model: PipelineModel | None, suffixes: dict[int, DataFrame], usual: str,
                 prior: float):
        self.rules, self.model, self.suffixes, self.usual, self.prior = rules, model, suffixes, usual, prior

    def judge(self, pages: DataFrame, url: str = "url") -> DataFrame:
        """Add ``host, path, rule, verdict, block_score``.

        A NULL url, or one without ``://``, has an empty host and path, fits no
        rule and is judged by its features. Repeated rows get equal answers.
        """
        out = _described(pages, url, self.rules)
        if self.model is None:
            scored = out.withColumn("_score", F.lit(1.0 if self.usual == BLOCK else 0.0))
        else:
            for labels, known in self.suffixes.items():
                out = _with_suffixes(out, known, labels, self.prior)
            from pyspark.ml.functions import vector_to_array

            scored = self.model.transform(out).withColumn("_score", vector_to_array("probability")[1])
        verdict = F.coalesce("_label", F.when(F.col("_score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
        return scored.select("_row.*", F.col("_host").alias("host"), F.col("_path").alias("path"),
                             F.col("_rule").alias("rule"), verdict.alias("verdict"),
                             F.col("_score").alias("block_score"))


def _described(pages: DataFrame, url: str, rules: list[Rule]) -> DataFrame:
    clash = {"host", "path", "rule", "verdict", "block_score"}
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in clash])
    out = pages.select(row.alias("_row"), F.col(f"`{url}`").alias("_url"))
    out = out.withColumns({"_host": host(F.col("_url")), "_path": path(F.col("_url"))})
    return out.withColumns({
        "_rule": longest(rules, F.col("_host"), F.col("_path"), "name"),
        "_label": longest(rules, F.col("_host"), F.col("_path"), "verdict"),
        **{f"_{k}": v for k, v in lexical(F.col("_url"), F.col("_host"), F.col("_path")).items()}})


def _with_suffixes(out: DataFrame, known: DataFrame, labels: int, prior: float) -> DataFrame:
    """Join what training knows of each host's suffix: how many URLs it had, and what share was blocked."""
    key = f"_suffix{labels}"
    out = out.withColumn(key, suffix(F.col("_host"), labels)).join(known, key, "left")
    return out.withColumns({f"_seen{labels}": F.log1p(F.coalesce(f"_seen{labels}", F.lit(0)).cast("double")),
                            f"_rate{labels}": F.coalesce(f"_rate{labels}", F.lit(prior))})


def fit(
    pages: DataFrame, rules: list[Rule], url: str = "url", sample: int = 20_000, trees: int = 20, depth: int = 4,
) -> Filter:
    """Train on the distinct URLs that the rules label: about ``sample`` of them, chosen by hash.

    Suffix statistics count every labelled URL; a suffix is taken in with weight
    ``count / (count + 20)`` against the overall share. Without URLs of both
    verdicts there is nothing to tell apart, and the one verdict seen (else
    ``allow``) is everyone's.
    """
    from rillstone.session import stage

    # a URL that many rows repeat counts once; copies are combined before the shuffle
    urls = pages.select(F.col(f"`{url}`").alias("url")).distinct()
    labelled = _described(urls, "url", rules).filter("_label is not null")
    labelled = stage(labelled.drop("_row").withColumn("_block", (F.col("_label") == BLOCK).cast("double")))
    total, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("_block"), F.lit(0.0))).first()
    if not total or blocked in (0, total):
        return Filter(rules, None, {}, BLOCK if total and blocked else ALLOW, 0.0)
    prior = blocked / total
    suffixes = {}
    out = labelled
    for n in Filter.SUFFIXES:
        counted = labelled.groupBy(suffix(F.col("_host"), n).alias(f"_suffix{n}")).agg(
            F.count(F.lit(1)).alias(f"_seen{n}"),
            ((F.sum("_block") + 20 * prior) / (F.count(F.lit(1)) + 20)).alias(f"_rate{n}"))
        suffixes[n] = stage(counted)  # stored, so that the optimizer knows its size
        out = _with_suffixes(out, suffixes[n], n, prior)
    parts = -(-total // sample)
    chosen = out.filter(F.pmod(F.xxhash64("_url"), F.lit(parts)) == 0) if parts > 1 else out
    names = [f"_{k}" for k in lexical(F.col("_url"), F.col("_host"), F.col("_path"))]
    names += [f"_{kind}{n}" for n in Filter.SUFFIXES for kind in ("seen", "rate")]
    chosen = stage(chosen.select("_block", *names))
    trees_ = GBTClassifier(featuresCol="_features", labelCol="_block", maxIter=trees, maxDepth=depth, seed=5)
    steps = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="_features"), trees_])
    both = chosen.agg(F.min("_block"), F.max("_block")).first()
    if both[0] == both[1]:
        return Filter(rules, None, {}, BLOCK if both[0] else ALLOW, prior)
    return Filter(rules, steps.fit(chosen), suffixes, ALLOW, prior)
