"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Everything here is DataFrame expressions: the features, the training (each level of a tree is one
aggregation of gradients over binned features) and the model, which becomes one expression per tree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Host suffix, path prefix, verdict. A rule fits its host and all subdomains; the longest wins.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
FEATURES = ("length", "host_length", "labels", "depth", "digit_ratio", "entropy", "params", "hyphens", "longest_label", "host_digits", "suffix_rate")
TREES, DEPTH, RATE, BINS = 12, 2, 0.4, 12
#: Most labelled URLs that a model is fitted on.
TRAINING_ROWS = 4_000


# ---------------------------------------------------------------- parts of a URL

def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty for null or without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does. Ties go to the longer host, then to block."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for suffix, prefix, what in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block")):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(suffix + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The lexical features of a URL but for the suffix statistics."""
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    digits = F.length(text) - F.length(F.translate(text, "0123456789", ""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    letters = "abcdefghijklmnopqrstuvwxyz0123456789-"
    size = F.greatest(F.length(host), F.lit(1))
    entropy = F.lit(0.0)
    for c in letters:
        p = (F.length(host) - F.length(F.translate(host, c, ""))) / size
        entropy = entropy - F.when(p > 0, p * F.log2(p)).otherwise(0.0)
    return {
        "length": F.length(text).cast("double"),
        "host_length": F.length(host).cast("double"),
        "labels": F.size(labels).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": digits / n,
        "entropy": entropy,
        "params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "hyphens": (F.length(host) - F.length(F.translate(host, "-", ""))).cast("double"),
        "longest_label": F.array_max(F.transform(labels, F.length)).cast("double"),
        "host_digits": (F.length(host) - F.length(F.translate(host, "0123456789", ""))).cast("double"),
    }


def suffix_of(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


# ---------------------------------------------------------------- labelled URLs

def labelled_urls(spark: SparkSession, rows: int = TRAINING_ROWS) -> DataFrame:
    """(url, label) made by a rule: label 1 for hosts of hyphenated lures, digit runs and long random labels, 0 for plain sites.

    Both kinds share suffixes, schemes, paths, page numbers and tracking parameters, so that none of these
    alone decides; the lure words are joined two or three to a host as mass-registered names are.
    """
    pick = lambda words, salt: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(words))) + 1).cast("int"))
    lure = ("cheap", "pills", "casino", "bonus", "free", "win", "loan", "spam", "farm", "deal", "bet", "viagra", "replica", "click", "prize", "crypto")
    syllable = ("th", "er", "an", "on", "lo", "mi", "ta", "re", "es", "wh", "ion", "ble", "our", "ing", "de", "st")
    plain = F.concat(pick(syllable, 1), pick(syllable, 2), F.when(F.col("id") % 3 == 0, pick(syllable, 3)).otherwise(""), F.when(F.col("id") % 12 == 0, F.concat(F.lit("-"), pick(syllable, 4))).otherwise(""))
    number = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(9000)).cast("string")
    bad = (
        F.when(F.col("id") % 5 == 0, F.concat(pick(lure, 5), F.lit("-"), pick(lure, 6), F.lit("-"), pick(lure, 7)))
        .when(F.col("id") % 5 == 1, F.concat(pick(lure, 5), number, pick(lure, 6)))
        .when(F.col("id") % 5 == 2, F.concat(pick(lure, 5), F.lit("-"), pick(lure, 6), number))
        .otherwise(F.concat(pick(lure, 5), F.lit("-"), pick(lure, 6)))
    )
    label = (F.pmod(F.xxhash64("id", F.lit(0)), F.lit(100)) < 40).cast("int")
    suffix = F.when((F.col("label") == 1) & (F.pmod(F.xxhash64("id", F.lit(10)), F.lit(4)) == 0), pick(("top", "xyz", "click"), 11)).otherwise(pick(("com", "net", "org", "org", "net", "com"), 12))
    host = F.concat(pick(("", "", "www.", "blog.", "m."), 13), F.when(F.col("label") == 1, bad).otherwise(plain), pick((".", ".example.", ".site."), 14), suffix)
    path = F.concat(F.lit("/"), pick(("en", "fr", "de", "es", "a"), 15), F.lit("/"), F.pmod(F.xxhash64("id", F.lit(16)), F.lit(1000)).cast("string"), pick(("", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed"), 17))
    return spark.range(rows).withColumn("label", label).select(F.concat(pick(("http://", "https://"), 18), host, path).alias("url"), "label")


# ---------------------------------------------------------------- gradient-boosted trees

@dataclass
class Tree:
    value: float = 0.0
    feature: str = ""
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def column(self, x: dict[str, Column]) -> Column:
        if self.low is None:
            return F.lit(self.value)
        return F.when(x[self.feature] <= F.lit(self.cut), self.low.column(x)).otherwise(self.high.column(x))


@dataclass
class Model:
    base: float
    suffixes: dict[str, float]
    rate: float  # of suffixes that training didn't hold
    trees: list[Tree] = field(default_factory=list)

    def features(self, url: Column, host: Column, path: Column) -> dict[str, Column]:
        x = lexical(url, host, path)
        known = F.lit(self.rate)
        for suffix, rate in sorted(self.suffixes.items()):
            known = F.when(suffix_of(host) == suffix, F.lit(rate)).otherwise(known)
        return x | {"suffix_rate": known}

    def probability(self, x: dict[str, Column]) -> Column:
        z = F.lit(self.base)
        for tree in self.trees:
            z = z + tree.column(x)
        return 1.0 / (1.0 + F.exp(-z))


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, rows: int = TRAINING_ROWS) -> Model:
    """Fit boosted trees to (url, label 0 or 1), at most about `rows` of them chosen by a hash of the url.

    Rows with null url or label are not used. Cuts lie at quantiles; a level's splits come from one
    aggregation of gradient and curvature by node, feature and bin. A table without both labels gives a
    model of its base rate alone.
    """
    labelled = labelled.where("url is not null and label in (0, 1)").select("url", F.col("label").cast("double").alias("label"))
    total = labelled.count()
    if total > rows:
        labelled = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(1e6 * rows / total))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    with_host = labelled.withColumn("host", host).withColumn("path", path).coalesce(1).cache()
    n, ones = with_host.agg(F.count("*"), F.sum("label")).first()
    share = min(max((ones or 0) / n, 1e-4), 1 - 1e-4) if n else 0.5
    # suffix statistics, drawn towards the base rate
    by_suffix = with_host.groupBy(suffix_of(F.col("host")).alias("s")).agg(F.count("*").alias("n"), F.sum("label").alias("k")).orderBy(F.desc("n"), "s").limit(50).collect()
    model = Model(math.log(share / (1 - share)), {r["s"]: (r["k"] + 10 * share) / (r["n"] + 10) for r in by_suffix}, share)
    if not n or not 0 < ones < n:
        with_host.unpersist()
        return model
    x = model.features(F.col("url"), F.col("host"), F.col("path"))
    data = with_host.select("label", *[c.alias(f) for f, c in x.items()]).cache()
    at = [k / bins for k in range(1, bins)]
    quantiles = data.agg(*[F.percentile_approx(f, at).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(quantiles[f])) for f in FEATURES}
    named = {f: F.col(f) for f in FEATURES}
    binned = F.array(*[F.struct(F.lit(f).alias("f"), sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias("b")) for f in FEATURES])
    data = data.withColumn("binned", binned).groupBy("label", *FEATURES, "binned").agg(F.count("*").alias("w")).coalesce(1).cache()
    for _ in range(trees):
        p = model.probability(named)
        leaves = [Tree()]
        root = leaves[0]
        for level in range(depth + 1):
            node = _leaf_index(root, leaves, named)
            stats = data.withColumn("node", node).withColumn("p", p)
            grads = stats.select("node", (F.col("w") * (F.col("label") - F.col("p"))).alias("g"), (F.col("w") * F.col("p") * (1 - F.col("p"))).alias("h"), "binned")
            rows_ = grads.select("node", "g", "h", F.explode("binned").alias("e")).groupBy("node", "e.f", "e.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            leaves = _grow(leaves, rows_, cuts, rate, last=level == depth)
            if not leaves:
                break
        model.trees.append(root)
    for df in (with_host, data):
        df.unpersist()
    return model


def _leaf_index(tree: Tree, leaves: list[Tree], x: dict[str, Column]) -> Column:
    if tree.low is None:
        return F.lit(next((i for i, leaf in enumerate(leaves) if leaf is tree), -1))
    return F.when(x[tree.feature] <= F.lit(tree.cut), _leaf_index(tree.low, leaves, x)).otherwise(_leaf_index(tree.high, leaves, x))


def _grow(leaves: list[Tree], rows: list, cuts: dict[str, list[float]], rate: float, last: bool) -> list[Tree]:
    """Give each leaf its value from the sums by bin, or split it where that gains most; returns the new leaves."""
    out = []
    for i, leaf in enumerate(leaves):
        sums: dict[str, dict[int, tuple[float, float]]] = {}
        for r in rows:
            if r["node"] == i:
                sums.setdefault(r["f"], {})[r["b"]] = (r["g"], r["h"])
        if not sums:
            continue
        first = next(iter(sorted(sums)))
        g, h = (sum(v[k] for v in sums[first].values()) for k in (0, 1))
        leaf.value = rate * g / (h + 1.0)
        best = (1e-3, "", 0.0)
        for f in () if last else FEATURES:
            gl = hl = 0.0
            for b, cut in enumerate(cuts[f]):
                dg, dh = sums[f].get(b, (0.0, 0.0))
                gl, hl = gl + dg, hl + dh
                if min(hl, h - hl) < 1.0:
                    continue
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut)
        if best[1]:
            _, leaf.feature, leaf.cut = best
            leaf.low, leaf.high = Tree(leaf.value), Tree(leaf.value)
            out += [leaf.low, leaf.high]
    return out


def judge(pages: DataFrame, model: Model, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of pages: the rule's verdict, else the trees'.

    score is the trees' probability of a bad URL. A null url, or one without ://, has an empty host and path
    and fits no rule. Repeated rows are judged one by one; html and other columns are not read.
    """
    parts = pages.select("page_id", "url").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    score = model.probability({f: F.col(f"x.{f}") for f in FEATURES})
    x = model.features(F.col("url"), F.col("host"), F.col("path"))
    scored = parts.withColumn("x", F.struct(*[c.alias(f) for f, c in x.items()])).withColumn("score", score)
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
