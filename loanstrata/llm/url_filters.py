"""URL filters: rules indexed by their rarest literal token, regular expressions only for candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, pattern) pairs as a table of columns verdict and pattern."""
    return spark.range(1).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(v).alias("verdict"), F.lit(p).alias("pattern")) for v, p in rules]
            )
        )
    )


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def _labels(host: Column) -> Column:
    return F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))


def _segments(path: Column) -> Column:
    return F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x))


def _quoted(text: Column, star: str) -> Column:
    inner = F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("\\Q"), F.replace(inner, F.lit("*"), F.lit(f"\\E{star}\\Q")), F.lit("\\E"))


def _compiled(rules: DataFrame) -> DataFrame:
    """Per rule: verdict, pattern, its regular expression over host and path, its literal tokens."""
    host = F.translate(F.regexp_extract("pattern", r"^[^/]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract("pattern", r"^[^/]*(.*)$", 1)
    # The last segment of a prefix may go on in the url, and a star stands for anything: neither
    # is a whole token there.
    segments = _segments(path)
    tokens = F.filter(
        F.concat(_labels(host), F.slice(segments, 1, F.size(segments) - 1)),
        lambda t: (F.length(t) > 2) & ~F.contains(t, F.lit("*")),
    )
    return (
        rules.filter(F.col("pattern").isNotNull() & F.col("verdict").isNotNull())
        .select("verdict", "pattern")
        .distinct()
        .select(
            "verdict",
            "pattern",
            F.concat(
                F.lit("(?s)\\A"),
                F.when(host == "", F.lit("[^/]*")).otherwise(
                    F.concat(F.lit("(?:[^/]*\\.)?"), _quoted(host, "[^/]*"))
                ),
                F.when(path == "", F.lit("(?:/|\\z)")).otherwise(_quoted(path, ".*")),
            ).alias("regex"),
            # A rule without a literal token is fetched by the empty token, which every url has.
            F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(""))).alias("tokens"),
        )
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Judge every url by the longest rule that fits: (page_id, host, path, rule, verdict).

    ``rules`` has the columns verdict and pattern. A pattern is a host, which stands for its
    subdomains too, and a prefix of the path; ``*`` stands for any characters. Of several rules
    that fit, the longest pattern decides, then the longest host in it, then the later pattern and
    verdict in text order. Without one, rule is null and the verdict is ``default``.

    Tokens are host labels and whole path segments. The distinct (host, path) pairs are counted by
    token, each rule is filed under the one of its tokens that the fewest of them have, and a pair
    runs the expressions only of the rules that its tokens fetch. A host or url that fills a third
    of the table is one pair. The result joins back by (host, path).

    A null url or one without ``://`` has an empty host and path. Every row is returned, repeated
    rows and null ids included; no other column of ``pages`` is read. An empty table gives none.
    """
    urls = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    pairs = urls.select("host", "path").distinct()
    tokens = pairs.select(
        "host",
        "path",
        F.explode(
            F.array_distinct(
                F.concat(F.array(F.lit("")), _labels(F.col("host")), _segments(F.col("path")))
            )
        ).alias("token"),
    )
    compiled = _compiled(rules)
    literals = compiled.select("pattern", "verdict", "regex", F.explode("tokens").alias("token"))
    counts = tokens.join(literals.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    index = (
        literals.join(counts, "token", "left")
        .groupBy("pattern", "verdict", "regex")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    rank = F.struct(
        F.length("pattern"), F.length(F.regexp_extract("pattern", r"^[^/]*", 0)), "pattern", "verdict"
    )
    verdicts = (
        tokens.join(index, "token")
        .filter(F.expr("concat(host, path) rlike regex"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("pattern", "verdict"), rank).alias("best"))
    )
    return urls.join(verdicts, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.pattern").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
