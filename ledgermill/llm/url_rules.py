"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression over host + path, with the literal tokens that each match of it holds: `h:` and a run of
letters and digits of the host, or `p:` and one of the path. A rule is indexed under the token that occurs in the fewest
URLs, counted over all URLs. The tokens of a URL fetch the rules indexed under them, and only these run their regular
expressions. Rules without a token are tried on every URL; give each rule one.

Named rules decide first: the longest wins, then `block`. Of the URLs that no named rule fits, those that a pattern
fits are blocked, and all others are allowed.

Host: what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: what follows up to `?`, `#` or
the end. URLs are made distinct before they are cut into tokens, so a URL that a third of all pages share is one row.

Defined results: a NULL URL, or one without `://`, has an empty host and path; no rule fits it, and it is allowed. Rows
that repeat an id or a URL are judged each. NULL ids are kept. Other columns are not read.
"""

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """`name` is None for a pattern; `rank` orders named rules."""

    name: str | None
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int


def _runs(text: str) -> list[str]:
    return re.findall("[A-Za-z0-9]+", text)


def prefix_rule(name: str, verdict: str) -> Rule:
    """A rule host/path: it fits the host and its subdomains, if the path starts with the rule's path."""
    host, slash, path = name.partition("/")
    path = slash + path
    # The last run of a path may go on in the URL, so it is no whole token.
    inner = path[: re.search("[A-Za-z0-9]*$", path).start()]
    tokens = (*(f"h:{x}" for x in _runs(host)), *(f"p:{x}" for x in _runs(inner)))
    return Rule(name, rf"^(?:[^/]*\.)?\Q{host}{path}\E", tokens, verdict, len(name))


def word_pattern(where: str, *words: str) -> Rule:
    """Blocks URLs that have the words next to each other, joined by single marks, in the host ('h') or path ('p')."""
    start, gap = (r"^(?:[^/]*[^a-z0-9/])?", "[^a-zA-Z0-9/]") if where == "h" else (r"^[^/]*/(?:.*[^a-zA-Z0-9])?", "[^a-zA-Z0-9]")
    pattern = start + gap.join(words) + "(?![a-zA-Z0-9])"
    return Rule(None, "(?s)" + pattern, tuple(f"{where}:{x}" for x in words), "block", 0)


#: Names of sites that sell links, pills or bets.
SPAM_PATTERNS = (
    word_pattern("h", "spam"),
    word_pattern("h", "cheap", "pills"),
    word_pattern("h", "free", "money"),
    word_pattern("h", "online", "casino"),
    word_pattern("h", "casino"),
    word_pattern("h", "viagra"),
    word_pattern("h", "porn"),
    word_pattern("h", "xxx"),
    word_pattern("p", "casino"),
    word_pattern("p", "viagra"),
    word_pattern("p", "porn"),
)


def host_and_path(url: str) -> tuple[Column, Column]:
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _tokens(text: str, mark: str) -> Column:
    return F.transform(F.array_remove(F.split(F.col(text), "[^A-Za-z0-9]+"), ""), lambda x: F.concat(F.lit(mark), x))


def judge_urls(
    pages: DataFrame, rules: list[Rule], id_column: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule (the named rule that decided, else NULL) and verdict."""
    spark = pages.sparkSession
    host, path = host_and_path("url")
    source = pages.select(F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    urls = source.where("url IS NOT NULL").select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    listed = [(i, rule.name, rule.pattern, rule.verdict, rule.rank, list(rule.tokens)) for i, rule in enumerate(rules)]
    table = spark.createDataFrame(
        listed, "number int, name string, pattern string, verdict string, rank int, tokens array<string>"
    )
    literal = table.select("number", F.explode_outer("tokens").alias("token")).select(
        "number", F.coalesce("token", F.lit("")).alias("token")
    )
    found = F.array_distinct(F.concat(F.array(F.lit("")), _tokens("host", "h:"), _tokens("path", "p:")))
    held = common.saved(
        urls.select("url", "host", "path", F.explode(found).alias("token")).join(
            literal.select("token").distinct(), "token", "left_semi"
        ),
        "tokens",
    )
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = literal.join(counts, "token", "left").groupBy("number")
    rarest = rarest.agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).alias("rarest"))
    index = table.drop("tokens").join(rarest.select("number", F.col("rarest.token").alias("token")), "number")
    # Written, as a hot token or URL is only split where no aggregate shares the join's stage.
    index = common.saved(index, "index")
    fits = held.join(index, "token").where(F.expr("concat(host, path) RLIKE pattern"))
    order = F.struct(F.col("name").isNotNull().alias("named"), "rank", F.col("verdict") == "block", "name", "verdict")
    best = fits.groupBy("url").agg(F.max(order).alias("best"))
    best = best.select(F.col("url").alias("judged"), F.col("best.name").alias("rule"), F.col("best.verdict").alias("v"))
    best = common.saved(best, "verdicts")
    out = source.join(best, F.col("url") == F.col("judged"), "left")
    host, path = (F.coalesce(x, F.lit("")) for x in (host, path))
    return out.select(
        "page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("v", F.lit("allow")).alias("verdict")
    )


def oracle(named: list[tuple[str, str]]) -> str:
    """The same verdicts as SQL over `pages`; named rules are (host/path, verdict)."""
    cases, verdicts = [], []
    for name, verdict in sorted(named, key=lambda x: (-len(x[0]), x[1] != "block", x[0])):
        host, slash, path = name.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}')"
        cases.append(f"WHEN {fits} THEN '{name}'")
        verdicts.append(f"WHEN '{name}' THEN '{verdict}'")
    marked = " OR ".join(f"regexp_matches(host, '(^|[^a-z0-9]){w}($|[^a-z0-9])')" for w in (
        "spam", "cheap[^a-z0-9]pills", "free[^a-z0-9]money", "casino", "viagra", "porn", "xxx"))
    paths = " OR ".join(f"regexp_matches(path, '(^|[^a-zA-Z0-9]){w}($|[^a-zA-Z0-9])')" for w in ("casino", "viagra", "porn"))
    return f"""WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END
            AS rest FROM pages),
        h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM r),
        p AS (SELECT page_id, translate(host, '{UPPER}', '{LOWER}') AS host,
            regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path FROM h),
        n AS (SELECT *, CASE {" ".join(cases)} END AS rule FROM p)
        SELECT page_id, host, path, rule,
            CASE rule {" ".join(verdicts)} ELSE CASE WHEN {marked} OR {paths} THEN 'block' ELSE 'allow' END END AS verdict
        FROM n"""
