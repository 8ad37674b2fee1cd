"""URL filter: allow and block rules, and gradient-boosted trees where no rule fits.

Rules name a host and a path; they fit the host and its subdomains where the path begins so,
and the longest that fits decides. The trees learn from labelled URLs: length, depth, digit
ratio, entropy, parameter counts, and what is known of the host's suffix. Features and
trees are column expressions.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.tables import hashed_sample, written

ALLOW, BLOCK = "allow", "block"
SUFFIX_BUCKETS = 1024
# Labelled rows a suffix's block rate is smoothed with.
SMOOTHING = 5.0
# Parts of the labelled urls; what a url knows of its suffix comes from the other parts.
FOLDS = 5
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "host_labels", "hyphens", "digit_ratio", "entropy",
    "parameters", "suffix_rate", "suffix_rows",
]


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled URLs the trees are grown from."""

    sample: int = 20_000
    rounds: int = 30
    depth: int = 3
    bins: int = 32
    rate: float = 0.3
    ridge: float = 1.0


@dataclass(frozen=True)
class Node:
    """A split (value at most ``cut`` goes left), or a leaf with a ``value``."""

    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None
    value: float = 0.0


@dataclass(frozen=True)
class Model:
    prior: float
    trees: list[Node]
    suffixes: dict[int, tuple[float, float]]
    unknown: tuple[float, float]


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host mark."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits, else null. The rules are a short list given by hand."""
    found = [F.lit(None).cast("string")]
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        of_host = (host == rule.host) | host.endswith("." + rule.host)
        found.insert(-1, F.when(of_host & path.startswith(rule.path), F.lit(rule.name)))
    return F.coalesce(*found)


def verdict_of(rule: Column, rules: Sequence[Rule]) -> Column:
    verdict = F.lit(None).cast("string")
    for r in rules:
        verdict = F.when(rule == r.name, F.lit(r.verdict)).otherwise(verdict)
    return verdict


def suffix_bucket(host: Column) -> Column:
    return F.pmod(F.xxhash64(F.element_at(F.split(host, r"\."), -1)), F.lit(SUFFIX_BUCKETS))


def with_features(rows: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``rows`` with a struct column ``__x`` of the lexical features and the bucket of the suffix."""
    u = F.coalesce(F.col(url), F.lit(""))
    length = F.length(u)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    share = "aggregate(array_distinct(split(__u, '')), 0D, (a, c) -> a + (length(__u) - length(replace(__u, c, ''))) / length(__u) * log2((length(__u) - length(replace(__u, c, ''))) / length(__u)))"
    x = [
        length, F.length(host), F.length(path),
        F.length(path) - F.length(F.replace(F.col(path), F.lit("/"))),
        F.when(F.col(host) == "", 0).otherwise(F.length(host) - F.length(F.replace(F.col(host), F.lit("."))) + 1),
        F.length(host) - F.length(F.replace(F.col(host), F.lit("-"))),
        F.when(length == 0, 0.0).otherwise(F.length(F.regexp_replace(u, "[^0-9]", "")) / length),
        F.when(length == 0, 0.0).otherwise(-F.expr(share)),
        F.when(query == "", 0).otherwise(F.length(query) - F.length(F.replace(query, F.lit("&"))) + 1),
    ]
    named = [v.cast("double").alias(n) for v, n in zip(x, FEATURES, strict=False)]
    spelled = rows.withColumn("__u", u)
    return spelled.select(*rows.columns, F.struct(*named, suffix_bucket(F.col(host)).alias("suffix")).alias("__x"))


def fit(
    x: np.ndarray, y: np.ndarray, settings: Settings = Settings(), weight: np.ndarray | None = None
) -> tuple[float, list[Node]]:
    """Logistic boosting on histograms: (prior margin, trees). One class only gives no trees.

    ``y`` is the share of blocked among the ``weight`` rows that a row stands for.
    """
    weight = np.ones(len(y)) if weight is None else weight
    share = ((weight * y).sum() + 0.5) / (weight.sum() + 1.0)
    prior = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return prior, []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, settings.bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(x.shape[1])], axis=1)
    margin, trees = np.full(len(y), prior), []

    def grow(rows: np.ndarray, depth: int) -> Node:
        g, h = gradient[rows], curvature[rows]
        value = -settings.rate * g.sum() / (h.sum() + settings.ridge)
        margin[rows] += value
        if depth == 0 or len(rows) < 2:
            return Node(value=float(value))
        whole = g.sum() ** 2 / (h.sum() + settings.ridge)
        best = (1e-6, -1, 0)
        for f in range(x.shape[1]):
            if not len(cuts[f]):
                continue
            gs = np.cumsum(np.bincount(binned[rows, f], g, len(cuts[f]) + 1))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, f], h, len(cuts[f]) + 1))[:-1]
            gain = gs**2 / (hs + settings.ridge) + (g.sum() - gs) ** 2 / (h.sum() - hs + settings.ridge) - whole
            at = int(np.argmax(gain))
            best = max(best, (float(gain[at]), f, at), key=lambda b: b[0])
        if best[1] < 0:
            return Node(value=float(value))
        _, f, at = best
        goes = binned[rows, f] <= at
        if goes.all() or not goes.any():
            return Node(value=float(value))
        margin[rows] -= value
        return Node(f, float(cuts[f][at]), grow(rows[goes], depth - 1), grow(rows[~goes], depth - 1))

    for _ in range(settings.rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = weight * (p - y), weight * p * (1 - p)
        trees.append(grow(np.arange(len(y)), settings.depth))
    return prior, trees


def known_suffixes(counts: Sequence[tuple[int, int, int]], rate: float) -> dict[int, tuple[float, float]]:
    """{bucket: (block rate, log of rows)} from (bucket, blocked, rows), of buckets with rows of both verdicts."""
    totals: dict[int, tuple[int, int]] = {}
    for s, block, n in counts:
        held = totals.get(s, (0, 0))
        totals[s] = held[0] + block, held[1] + n
    return {
        s: ((block + SMOOTHING * rate) / (n + SMOOTHING), float(np.log1p(n)))
        for s, (block, n) in totals.items() if 0 < block < n
    }


def train(
    labelled: DataFrame, url: str, host: str, path: str, verdict: str, settings: Settings = Settings()
) -> Model:
    """Learn from labelled URLs; rows without a verdict are left out.

    What is known of suffixes counts every labelled row, in a fixed number of buckets, and for the
    urls learned from every row of other folds, so that no url sees its own label. A suffix
    with rows of one verdict only says no more than that the rules name it: it counts as unknown. The
    trees are grown on the driver from at most ``settings.sample`` different urls, chosen by
    their hash and weighted with the rows they have.
    """
    rows = labelled.where(F.col(verdict).isin(ALLOW, BLOCK))
    blocks = F.sum((F.col(verdict) == BLOCK).cast("long"))
    # The features follow from the url, so copies are counted before features are taken.
    named = [F.col(url).alias("url"), F.col(host).alias("host"), F.col(path).alias("path")]
    rows = rows.groupBy(*named).agg(blocks.alias("block"), F.count("*").alias("n"))
    rows = written(with_features(rows, "url", "host", "path").select("url", "block", "n", "__x"), "labelled-urls")
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("url", F.lit(5)), F.lit(FOLDS)).cast("int"))
    totals = rows.groupBy(F.col("__x.suffix").alias("s"), "fold").agg(
        F.sum("block").alias("block"), F.sum("n").alias("n"), F.count("*").alias("urls")
    )
    counts = totals.collect()  # at most FOLDS rows for each of SUFFIX_BUCKETS
    n = sum(r.n for r in counts)
    rate = (sum(r.block for r in counts) + 0.5) / (n + 1.0)
    unknown = (rate, 0.0)
    suffixes = known_suffixes([(r.s, r.block, r.n) for r in counts], rate)
    of_others = [known_suffixes([(r.s, r.block, r.n) for r in counts if r.fold != f], rate) for f in range(FOLDS)]
    different = sum(r.urls for r in counts)
    seen = hashed_sample(rows, "url", settings.sample, different).select("block", "n", "fold", "__x.*").toPandas()
    of_suffix = [of_others[f].get(s, unknown) for f, s in zip(seen["fold"], seen["suffix"], strict=True)]
    of_suffix = np.array(of_suffix).reshape(-1, 2)
    x = np.column_stack([seen[FEATURES[:-2]].to_numpy(float), of_suffix])
    weight = seen["n"].to_numpy(float)
    prior, trees = fit(x, seen["block"].to_numpy(float) / weight, settings, weight)
    return Model(prior, trees, suffixes, unknown)


def _expression(node: Node) -> str:
    if node.feature < 0:
        return f"{node.value!r}D"
    name = FEATURES[node.feature]
    return f"CASE WHEN {name} <= {node.cut!r}D THEN {_expression(node.left)} ELSE {_expression(node.right)} END"


def scored(rows: DataFrame, model: Model, url: str, host: str, path: str, score: str) -> DataFrame:
    """``rows`` with the probability of ``block`` in a new column."""
    own = rows.columns
    filled = with_features(rows, url, host, path)
    rates = F.lit(model.unknown[0])
    counts = F.lit(model.unknown[1])
    if model.suffixes:
        of = F.create_map(*[F.lit(v) for s, (a, _) in model.suffixes.items() for v in (s, a)])
        n_of = F.create_map(*[F.lit(v) for s, (_, b) in model.suffixes.items() for v in (s, b)])
        rates = F.coalesce(of[F.col("__x.suffix")], rates)
        counts = F.coalesce(n_of[F.col("__x.suffix")], counts)
    lexical = [F.col(f"__x.{n}").alias(n) for n in FEATURES[:-2]]
    ready = filled.select(
        F.struct(*own).alias("__row"), *lexical, rates.alias("suffix_rate"), counts.alias("suffix_rows")
    )
    margin = " + ".join([f"{model.prior!r}D", *map(_expression, model.trees)])
    return ready.select("__row.*", (1 / (1 + F.exp(-F.expr(margin)))).alias(score))


def judged(pages: DataFrame, rules: Sequence[Rule], url: str = "url", settings: Settings = Settings()) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict.

    Pages that a rule decides are the labelled URLs from which the trees learn to judge the
    others. A null url or one without ``://`` has an empty host and path. With no page
    that a rule decides, the score is one half and every page is allowed.
    """
    if any(name in pages.columns for name in ("host", "path", "rule", "score", "verdict")):
        raise ValueError("the result's column names are taken; select what is needed first")
    hosted = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    ruled = hosted.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    labelled = ruled.select(F.col(url), "host", "path", verdict_of(F.col("rule"), rules).alias("verdict"))
    model = train(labelled, url, "host", "path", "verdict", settings)
    rated = scored(ruled, model, url, "host", "path", "score")
    guess = F.when(F.col("score") > 0.5, BLOCK).otherwise(ALLOW)
    return rated.withColumn("verdict", F.coalesce(verdict_of(F.col("rule"), rules), guess))
