"""URL filters: pattern rules indexed by their rarest literal token.

A rule names a host and the beginning of a path, and holds for all subdomains. Every rule needs
certain tokens (its host's labels, the parts between dots of its path's whole segments) in a URL.
Rules and URLs are cut at the same marks. A rule is filed under the token that is rarest in the URLs at hand; the tokens of a URL fetch the rules filed under them, and only
those rules' regular expressions run. Of the rules that fit, the longest decides.

Verdicts depend on the URL alone, so each different URL is judged once and joined back.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm.common import stage

DEFAULT = "allow"  # the verdict where no rule fits
_TOKEN_BREAK = r"[./]"


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rows (rule, verdict, regex, tokens, length) from pairs of verdict and host/path.

    Of equal rules the blocking one counts.
    """
    rows = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule.strip("/") + "/" or rule.startswith("/"):
            raise ValueError(f"not a rule: {verdict} {rule}")
        host, slash, path = rule.partition("/")
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        whole = path.split("/")[:-1]  # the last segment may go on in the URL
        tokens = sorted({t for part in [host, *whole] for t in re.split(_TOKEN_BREAK, part) if t})
        # Java and Python agree on these escapes. Host and path are matched as one string.
        regex = rf"\A(?:[^/]*\.)?{_literal(host)}{_literal(slash + path)}"
        rows[rule] = ("block" if rows.get(rule, ("",))[0] == "block" else verdict, regex, tokens, len(rule))
    schema = "rule string, verdict string, regex string, tokens array<string>, length int"
    return spark.createDataFrame([(rule, *rest) for rule, rest in rows.items()], schema)


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/\-_])", r"\\\1", text)


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.col(url), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict added.

    Null, empty and malformed URLs have empty host and path, fit no rule and get ``default``.
    Repeated rows each get their verdict. With no rules every URL gets ``default``. Columns of
    ``pages`` named like an added one are replaced; all others come back as they are.
    """
    urls = stage(
        pages.where(F.col(url_col).contains("://"))
        .select(F.col(url_col).alias("url"))
        .distinct()
        .select("url", host_of("url").alias("host"), path_of("url").alias("path")),
        "urls",
    )
    place = F.concat("host", "path")
    tokens = urls.select(
        "url", place.alias("place"), F.explode(F.array_distinct(F.split(place, _TOKEN_BREAK))).alias("token")
    )
    needed = rules.select("rule", F.explode("tokens").alias("token"))
    # How many URLs have each token that some rule needs.
    counts = tokens.join(needed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    # A rule with a token that no URL has is filed there, and so never fetched.
    rarest = needed.join(counts, "token", "left").groupBy("rule").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")
    )
    index = rules.join(rarest, "rule").select("token", "rule", "verdict", "regex", "length")
    fits = tokens.join(index, "token").where(F.regexp_like("place", F.col("regex")))
    best = fits.groupBy("url").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct("length", "rule")).alias("best")
    )
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    page, judged = pages.alias("page"), best.alias("judged")
    return page.join(judged, F.col(f"page.`{url_col}`") == F.col("judged.url"), "left").select(
        *[F.col(f"page.`{c}`") for c in kept],
        host_of(f"page.`{url_col}`").alias("host"),
        path_of(f"page.`{url_col}`").alias("path"),
        F.col("judged.best.rule").alias("rule"),
        F.coalesce("judged.best.verdict", F.lit(default)).alias("verdict"),
    )
