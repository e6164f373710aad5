"""URL filter: path rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host, registered domain (last two labels
of the host) and suffix (last label).  Each level is a beta-binomial whose prior
mean comes from the level above and whose strength is estimated from the spread
between its groups (analysis-of-variance estimate of the intra-class
correlation).  A host is blocked if the lower bound of its posterior rate of bad
pages, mean - z standard deviations, lies above `max_bad`.

Only DataFrame functions.  Outcomes are combined per host before the shuffle, and
what reaches the driver is one row of sums per level.

Defined cases: a NULL url or one without "://" has empty host and path, fits no
rule and is judged as the host ""; a host without labelled pages has its domain's
prior; without any label every such page is allowed; repeated pages and labels
count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.frames import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rules = list[tuple[str, str]]  # (block or allow, host/path prefix)
MAX_RULES = 500  # rules are one expression; a longer list belongs in a table


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first "://", or an empty text."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path starts the url's."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, path_part = rule.partition("/")
        owner = (host == name) | host.endswith("." + name)
        fits.append(F.when(owner & path.startswith(slash + path_part), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _strength(groups: DataFrame, least: float = 1.0, most: float = 1000.0, default: float = 10.0) -> tuple[float, float]:
    """(overall rate, prior strength) of a level from its groups' n and bad."""
    seen = groups.where("n > 0")
    row = seen.agg(
        F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("bad").alias("bad"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("between"),
        F.sum(F.col("bad") * (F.col("n") - F.col("bad")) / F.col("n")).alias("within"),
    ).first()
    g, n = row["g"], row["n"] or 0
    if not n:
        return 0.0, default
    rate = row["bad"] / n
    if g < 2 or n == g:
        return rate, default
    size = (n - row["nn"] / n) / (g - 1)
    between, within = (row["between"] - n * rate * rate) / (g - 1), row["within"] / (n - g)
    total = between + (size - 1) * within
    share = (between - within) / total if total > 0 else 0.0
    return rate, min(most, max(least, 1 / share - 1)) if share > 0 else most


def host_reputation(outcomes: DataFrame, z: float = 1.645, max_bad: float = 0.3) -> DataFrame:
    """Per host of outcomes(host, bad 0/1 or NULL for unlabelled): host, n, n_bad, rate, lower, blocked."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    labels = F.split("host", r"\.")
    hosts = hosts.withColumn("domain", F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)))
    # Stored, since the strengths and the posteriors all read it: pages and labels are joined once.
    hosts = stored(hosts.withColumn("suffix", F.element_at(labels, -1)), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rate, k_suffix = _strength(suffixes)
    _, k_domain = _strength(domains)
    _, k_host = _strength(hosts)
    suffixes = suffixes.select("suffix", ((F.col("bad") + k_suffix * rate) / (F.col("n") + k_suffix)).alias("above"))
    domains = domains.join(suffixes, "suffix").select("domain", ((F.col("bad") + k_domain * F.col("above")) / (F.col("n") + k_domain)).alias("prior"))
    a, b = F.col("bad") + k_host * F.col("prior"), F.col("n") - F.col("bad") + k_host * (1 - F.col("prior"))
    mean = a / (a + b)
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(domains, "domain").select(
        "host", "n", F.col("bad").alias("n_bad"), mean.alias("rate"), (mean - z * spread).alias("lower"), (mean - z * spread > max_bad).alias("blocked"))


def filter_urls(
    pages: DataFrame, labels: DataFrame, rules: Rules, page: str = "page_id", url: str = "url", label_page: str = "doc_id",
    bad: Column | None = None, z: float = 1.645, max_bad: float = 0.3,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, n_labelled and n_bad of its host.

    `bad` says which rows of `labels` are bad outcomes (default: not of quality, or toxic).
    """
    bad = F.expr("quality = 0 or toxic = 1") if bad is None else bad
    known = labels.select(F.col(label_page).alias("page_id"), bad.cast("int").alias("bad"))
    parsed = pages.select(F.col(page).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    hosts = host_reputation(parsed.select("page_id", "host").join(known, "page_id", "left"), z, max_bad)
    ruled = parsed.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    blocked_rules = [r for verdict, r in rules if verdict == "block"]
    verdict = F.when(F.col("rule").isNull(), F.col("blocked")).otherwise(F.col("rule").isin(blocked_rules))
    return ruled.join(hosts, "host").select(
        "page_id", "host", "path", "rule", F.when(verdict, "block").otherwise("allow").alias("verdict"), F.col("n").alias("n_labelled"), "n_bad")
