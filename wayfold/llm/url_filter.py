"""URL filter: rules, and gradient-boosted trees on lexical features for the rest.

Native: hosts, paths, rules, features and the trees' votes are Column expressions.
The trees are grown on the driver from a bounded sample of labelled URLs, with
logistic loss on binned features, and become one SQL expression each.

Edge cases: a null URL or one without `://` has an empty host and path, fits no
rule, and is judged by its features like any other; without labelled URLs of both
kinds all votes are equal, so what rules don't decide is allowed; repeated rows and
null ids keep their rows; empty tables give empty results; URLs of any length are
taken whole. What judge adds (host, path, rule, score, verdict) replaces columns of
these names; names that begin with _wf_ are reserved.

The rules' URLs are the only labels. The share of blocked URLs of a suffix is told to
the trees from the other FOLDS of the learned URLs, so that they can't read a URL's
own label back from it (leaving out that one URL would tell it, the wrong way round);
all suffixes of the learned URLs count, drawn to the mean where few were seen.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled URLs, about, that trees are grown from, chosen by a hash of the URL.
LEARN_ROWS = 20_000
TREES, DEPTH, BINS, RATE = 30, 3, 32, 0.1
#: Rows of a leaf at least, as a share of those learned from and as a number: trees that follow single URLs say little of others.
LEAF_SHARE, LEAF_ROWS = 0.05, 20
#: Weight of the mean in a suffix's share, in URLs, and folds of the learned URLs.
PRIOR_URLS, FOLDS = 20, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_length(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1]), r))


def rule(rules: list[tuple[str, str]], host_col: Column, path_col: Column) -> Column:
    """The longest rule (verdict, "host/path") that fits, as its text; else null.

    A rule fits its host and all subdomains where the path starts with the rule's.
    """
    out = F.lit(None).cast("string")
    for _, text in reversed(_by_length(rules)):
        at, _, rest = text.partition("/")
        fits = ((host_col == at) | host_col.endswith("." + at)) & path_col.startswith("/" + rest)
        out = F.when(fits, F.lit(text)).otherwise(out)
    return out


def suffix(host_col: Column) -> Column:
    return F.regexp_extract(host_col, r"([^.]*)$", 1)


def features(url: Column, host_col: Column, path_col: Column, rate: Column) -> dict[str, Column]:
    """Lexical features; rate is the share of blocked URLs among those learned from with that suffix."""
    text = F.coalesce(url, F.lit(""))

    def counted(where: Column, characters: str) -> Column:
        return (F.length(where) - F.length(F.translate(where, characters, ""))).cast("double")

    size = F.length(text).cast("double")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.greatest(F.length(text), F.lit(1)))
    entropy = F.aggregate(share, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return {
        "length": size,
        "host_length": F.length(host_col).cast("double"),
        "path_length": F.length(path_col).cast("double"),
        "depth": counted(path_col, "/"),
        "labels": counted(host_col, "."),
        "digit_ratio": counted(text, "0123456789") / F.greatest(size, F.lit(1.0)),
        "path_digits": counted(path_col, "0123456789"),
        "parameters": F.when(query == "", 0.0).otherwise(counted(query, "&") + 1),
        "fragment": F.when(text.contains("#"), 1.0).otherwise(0.0),
        "hyphens": counted(text, "-_"),
        "entropy": entropy,
        "secure": F.when(text.startswith("https"), 1.0).otherwise(0.0),
        "suffix_rate": rate,
        "suffix_length": F.length(suffix(host_col)).cast("double"),
    }


def _grow(x, y):
    """Boosted trees with logistic loss: the base log-odds and nested (feature, cut, low, high)."""
    import numpy as np

    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)  # bin b: x <= cuts[b]
    raw, trees, least = np.full(len(y), base), [], max(LEAF_ROWS, int(LEAF_SHARE * len(y)))

    def grow(rows, depth, g, h):
        value = RATE * float(g[rows].sum() / (h[rows].sum() + 1.0))
        if depth == 0 or len(rows) < 2 * least:
            raw[rows] += value
            return value
        best, total_g, total_h = (1e-6, None, None), g[rows].sum(), h[rows].sum()
        for j, c in enumerate(cuts):
            if not len(c):
                continue
            left_g = np.bincount(binned[rows, j], g[rows], BINS + 1).cumsum()[: len(c)]
            left_h = np.bincount(binned[rows, j], h[rows], BINS + 1).cumsum()[: len(c)]
            size = np.bincount(binned[rows, j], minlength=BINS + 1).cumsum()[: len(c)]
            gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
            gain[(size < least) | (len(rows) - size < least)] = 0
            b = int(np.argmax(gain))
            if gain[b] > best[0]:
                best = (gain[b], j, b)
        if best[1] is None:
            raw[rows] += value
            return value
        _, j, b = best
        low = binned[rows, j] <= b
        return j, float(cuts[j][b]), grow(rows[low], depth - 1, g, h), grow(rows[~low], depth - 1, g, h)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        trees.append(grow(np.arange(len(y)), DEPTH, y - p, p * (1 - p)))
    return base, trees


def learn(urls: DataFrame, rules: list[tuple[str, str]], url_col: str = "url") -> dict:
    """Trees from the URLs that rules label; about LEARN_ROWS of them reach the driver."""
    import numpy as np

    urls = urls.select(url_col)
    verdicts = dict((text, verdict) for verdict, text in rules)
    h, p = host(F.col(url_col)), path(F.col(url_col))
    labelled = urls.select(url_col, h.alias("h"), p.alias("p")).select("*", rule(rules, F.col("h"), F.col("p")).alias("rule")).where("rule IS NOT NULL")
    total = labelled.count()
    chosen = labelled.where(F.pmod(F.xxhash64(url_col), F.lit(1 << 20)) < int(min(1.0, LEARN_ROWS / max(1, total)) * (1 << 20)) + 1)
    bad = F.col("rule").isin([t for t, v in verdicts.items() if v == "block"]).cast("double")
    chosen = chosen.select(F.col(url_col).alias("u"), "h", "p", bad.alias("y"), suffix(F.col("h")).alias("s"), F.pmod(F.xxhash64(F.lit(1), url_col), F.lit(FOLDS)).alias("fold"))
    told = chosen.groupBy("s").agg(F.sum("y").alias("bad"), F.count("*").alias("n")).collect()  # at most a row for each learned URL
    n, blocked = sum(r.n for r in told), sum(r.bad for r in told)
    prior = blocked / n if n else 0.0
    suffixes = {r.s: (r.bad + PRIOR_URLS * prior) / (r.n + PRIOR_URLS) for r in told}
    part = chosen.groupBy("s", "fold").agg(F.sum("y").alias("bad"), F.count("*").alias("n"))
    whole = chosen.groupBy("s").agg(F.sum("y").alias("all_bad"), F.count("*").alias("all_n"))
    others = part.join(F.broadcast(whole), "s").select("s", "fold", ((F.col("all_bad") - F.col("bad") + PRIOR_URLS * prior) / (F.col("all_n") - F.col("n") + PRIOR_URLS)).alias("share"))
    named = features(F.col("u"), F.col("h"), F.col("p"), F.col("share"))
    rows = chosen.join(F.broadcast(others), ["s", "fold"]).select(F.xxhash64("u").alias("k"), "y", *(c.alias(k) for k, c in named.items())).collect()
    rows = np.array(sorted([tuple(r[1:]) for r in rows]), float).reshape(-1, 1 + len(named))
    if not len(rows) or rows[:, 0].min() == rows[:, 0].max():
        return {"base": -1.0, "trees": [], "suffixes": suffixes, "prior": prior}
    base, trees = _grow(rows[:, 1:], rows[:, 0])
    return {"base": base, "trees": trees, "suffixes": suffixes, "prior": prior}


def _votes(tree, names: list[str]) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    feature, cut, low, high = tree
    return f"CASE WHEN {names[feature]} <= {cut!r}D THEN {_votes(low, names)} ELSE {_votes(high, names)} END"


def judge(urls: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", model: dict | None = None) -> DataFrame:
    """urls with host, path, rule, score (chance to be blocked, by features) and verdict."""
    model = model or learn(urls, rules, url_col)
    verdicts = dict((text, verdict) for verdict, text in rules)
    rows = urls.select("*", F.col(url_col).alias("_wf_url"), host(F.col(url_col)).alias("_wf_host"), path(F.col(url_col)).alias("_wf_path"))
    rows = rows.withColumns({"host": F.col("_wf_host"), "path": F.col("_wf_path"), "rule": rule(rules, F.col("_wf_host"), F.col("_wf_path")), "_wf_suffix": suffix(F.col("_wf_host"))})
    # the learned shares, at most LEARN_ROWS of them, as rows that travel to the URLs
    shares = urls.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(model["suffixes"])), "map<string,double>")).alias("_wf_suffix", "_wf_share"))
    rows = rows.join(F.broadcast(shares), "_wf_suffix", "left")
    named = {f"_wf_f_{k}": c for k, c in features(F.col("_wf_url"), F.col("_wf_host"), F.col("_wf_path"), F.coalesce("_wf_share", F.lit(float(model["prior"])))).items()}
    total = " + ".join([f"{float(model['base'])!r}D", *(f"({_votes(t, list(named))})" for t in model["trees"])])
    rows = rows.withColumns(named).withColumn("score", F.expr(f"1 / (1 + exp(-({total})))")).drop(*named, "_wf_url", "_wf_host", "_wf_path", "_wf_suffix", "_wf_share")
    by_rule = F.lit(None).cast("string")
    for text, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(by_rule)
    return rows.withColumn("verdict", F.coalesce(by_rule, F.when(F.col("score") >= 0.5, "block").otherwise("allow")))
