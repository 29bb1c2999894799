"""URL filters (operator 5, DataFrame functions only).

Host rules come first: the longest rule that fits a url's host and path decides.
Other urls are judged by pattern rules. Each pattern rule names the literal tokens
that any url it matches must hold; it is indexed by the one that is rarest in the
urls at hand. The tokens of a url fetch the few rules indexed by them, and only
those rules' regular expressions run.

Cases: a null url, or one without ``://``, has empty host and path and is allowed. A
token is a run of a-z and 0-9 in the lower-cased url. Equal urls are judged once and
joined back. A pattern that holds no literal token is refused, because no token
could fetch it. Repeated rows have their verdict as often as they come; a very long url is cut into
tokens as a whole. An empty table gives an empty table.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickermood.llm.common import ascii_lower

# (verdict, host, path)
HOST_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

# (name, regular expression on the lower-cased url, literal tokens any match must hold)
PATTERN_RULES = [
    ("spam-farm", r"://([^/?#]*[.])?spam-farm[.]", ["spam", "farm"]),
    ("cheap-pills", r"://([^/?#]*[.])?cheap-pills[.]", ["cheap", "pills"]),
    ("casino", r"://[^/?#]*\bcasino\b", ["casino"]),
    ("adult", r"://[^/?#]*\bporn[.]", ["porn"]),
    ("ad-server", r"://ads[.]", ["ads"]),
    ("doubleclick", r"\bdoubleclick[.]net\b", ["doubleclick", "net"]),
    ("tracking-pixel", r"/pixel[.]gif\b", ["pixel", "gif"]),
    ("free-download", r"\bfree-download\b", ["free", "download"]),
    ("phishing-login", r"\bsecure-login\b[^/]*/verify\b", ["secure", "login", "verify"]),
    ("wp-login", r"/wp-login[.]php\b", ["wp", "login", "php"]),
]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return ascii_lower(F.coalesce(F.regexp_extract(rest, r"\A([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda t: t != ""))


def host_rule(rules=HOST_RULES) -> Column:
    """Struct ``(size, rule, verdict)`` of the longest rule that fits ``host`` and ``path``."""
    fits = []
    for verdict, host, path in rules:
        fit = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.struct(
            F.lit(len(host) + len(path)).alias("size"), F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict")
        )
        fits.append(F.when(fit, rule))
    return F.array_max(F.array(*fits))


def pattern_index(spark: SparkSession, url_tokens: DataFrame, rules=PATTERN_RULES) -> DataFrame:
    """``(token, name, pattern)``: each rule under its rarest token (ties: the first by name)."""
    for name, pattern, literals in rules:
        if not literals or any(not re.fullmatch("[a-z0-9]+", t) for t in literals):
            raise ValueError(f"pattern rule {name} needs literal tokens")
    needed = spark.createDataFrame(
        [(name, pattern, token) for name, pattern, literals in rules for token in literals],
        "name string, pattern string, token string",
    )
    counts = (
        url_tokens.where(F.col("token").isin(sorted({t for *_, literals in rules for t in literals})))
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        needed.join(counts, "token", "left")
        .groupBy("name", "pattern")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).alias("rarest"))
        .select("rarest.token", "name", "pattern")
    )


def pattern_hits(urls: DataFrame, rules=PATTERN_RULES) -> DataFrame:
    """``(url, pattern_rule)`` for each distinct url that a pattern rule matches; the first rule by name."""
    # Tokens that no rule names, such as those of every url, do not move.
    literals = sorted({token for *_, named in rules for token in named})
    spread = urls.where(F.col("url").isNotNull()).select("url").distinct().select(
        "url", F.explode(tokens(F.col("url"))).alias("token")
    ).where(F.col("token").isin(literals))
    index = pattern_index(urls.sparkSession, spread, rules)
    return (
        spread.join(index, "token")
        .where(F.expr("lower(url) rlike pattern"))
        .groupBy("url").agg(F.min("name").alias("pattern_rule"))
    )


def url_verdicts(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict, pattern_rule)`` for every row of ``pages``."""
    urls = pages.select("page_id", "url")
    hits = pattern_hits(urls, pattern_rules).withColumnRenamed("url", "hit")
    parts = urls.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    judged = parts.withColumn("fit", host_rule(host_rules)).join(hits, F.col("url") == F.col("hit"), "left")
    by_pattern = F.when(F.col("pattern_rule").isNotNull(), "block").otherwise("allow")
    return judged.select(
        "page_id", "url", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", by_pattern).alias("verdict"), "pattern_rule",
    )
