"""URL filters: rules found through the rarest literal token they contain.

A rule is either a host and path prefix (`example.com/en/`: the host and all its subdomains, paths
that start with `/en/`) or a pattern with `*` for any characters, matched anywhere in
`host + path`. Tokens are runs of `[a-z0-9]`. A token of a rule can serve as its key where
something that is no token character stands on both sides, because then every URL that the
rule fits has it as a whole token. Of those each rule is filed under the one that fewest
URLs of the corpus have; a rule without any is filed under the empty token, which every URL
has. The tokens of a URL fetch its candidates, and only those run their regular expression.

Prefix rules go before patterns, longer ones before shorter ones, then by text. A URL
without `://` and a null one have an empty host and an empty path, which only a pattern of
nothing but `*` fits. Judged are distinct addresses; rows of any number may share one, and
each row gets its verdict. Columns of any name may come with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the query. (rule, verdict)
PREFIX_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
# What decides where no prefix rule fits.
PATTERN_RULES = (
    ("*spam-farm.*", "block"),
    ("*cheap-pills.*", "block"),
    ("*ads-track.*", "block"),
    ("*.casino.*", "block"),
    ("*/adserver/*", "block"),
    ("*/porn/*", "block"),
)
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", -1), lambda t: t != ""))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, r"([^A-Za-z0-9/\x80-￿])", r"\\$1")


def rule_table(spark: SparkSession, prefixes: Sequence[tuple[str, str]], patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """-> (rule, verdict, is_prefix, regex, keys), keys being the tokens it can be filed under."""
    listed = [(r, v, True) for r, v in prefixes] + [(r, v, False) for r, v in patterns]
    entries = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(p).alias("is_prefix")) for r, v, p in listed])
    return compiled(spark.range(1).select(F.inline(entries)))


def compiled(rules: DataFrame) -> DataFrame:
    """(rule, verdict, is_prefix) -> the same with `regex` and `keys`."""
    prefix = F.concat(F.lit(r"^([^/]*\.)?"), _quoted(F.col("rule")))
    pieces = F.transform(F.split("rule", r"\*", -1), _quoted)
    pattern = F.concat(F.lit("(?s)"), F.array_join(pieces, ".*"))
    # In a prefix rule only the last token can go on; in a pattern those next to a `*`, and,
    # as it may begin and end anywhere, the first and the last.
    bounded = F.when(F.col("is_prefix"), F.concat(F.lit("."), F.col("rule"), F.lit("*"))).otherwise(
        F.concat(F.lit("*"), F.col("rule"), F.lit("*"))
    )
    whole = F.regexp_replace(bounded, r"[A-Za-z0-9]*\*[A-Za-z0-9]*", "*")
    return rules.withColumns({"regex": F.when(F.col("is_prefix"), prefix).otherwise(pattern), "keys": _tokens(whole)})


def token_rows(addresses: DataFrame) -> DataFrame:
    """(address) -> (address, token), the empty token included."""
    tokens = F.concat(_tokens(F.col("address")), F.array(F.lit("")))
    return addresses.select("address", F.explode(tokens).alias("token"))


def rule_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rules -> the same with `token`, the key that fewest addresses have."""
    keys = rules.select("rule", "is_prefix", F.explode("keys").alias("token"))
    wanted = keys.select("token").distinct()
    counted = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        keys.join(counted, "token", "left")
        .groupBy("rule", "is_prefix")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "token")).alias("rarest"))
    )
    filed = rules.join(rarest, ["rule", "is_prefix"], "left")
    return filed.withColumn("token", F.coalesce("rarest.token", F.lit(""))).drop("rarest", "keys")


def verdicts(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (address) -> (address, rule, verdict, is_prefix) for addresses that a rule fits."""
    tokens = token_rows(addresses)
    candidates = tokens.join(rule_index(rules, tokens), "token")
    fits = candidates.where("address rlike regex")
    first = F.struct("is_prefix", F.length("rule").alias("size"), "rule", "verdict")
    best = fits.groupBy("address").agg(F.max(first).alias("best"))
    return best.select("address", "best.rule", "best.verdict", "best.is_prefix")


def filtered(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Rows -> (page, host, path, rule, verdict), `page` being the row as a struct.

    `rule` is that of a prefix rule, null where a pattern or nothing decides.
    """
    rows = pages.select(F.struct("*").alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("address", F.concat("host", "path"))
    found = verdicts(rows.select("address").distinct(), rules)
    return rows.join(found, "address", "left").select(
        "page",
        "host",
        "path",
        F.when(F.col("is_prefix"), F.col("rule")).alias("rule"),
        F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every url of `pages`."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = filtered(pages, rule_table(spark, PREFIX_RULES, PATTERN_RULES))
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH rules(rule, verdict) AS (VALUES
    ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
), parts AS (
    SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules
), urls AS (
    SELECT row_number() OVER () AS row_no, page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), fits AS (
    SELECT row_no, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
    FROM urls JOIN parts ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY row_no
)
SELECT page_id, host, path, rule,
    CASE WHEN verdict IS NOT NULL THEN verdict
        WHEN contains(host || path, 'spam-farm.') OR contains(host || path, 'cheap-pills.') OR contains(host || path, 'ads-track.') OR contains(host || path, '.casino.')
            OR contains(host || path, '/adserver/') OR contains(host || path, '/porn/') THEN 'block'
        ELSE 'allow' END AS verdict
FROM urls LEFT JOIN fits USING (row_no)
"""
