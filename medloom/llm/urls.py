"""URL filters: rules found by their rarest literal token, regular expressions for those only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small, stage

#: Rules of the query: (host and path, verdict). They hold for the host and its subdomains.
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Patterns of the query for what no rule covers: (pattern, verdict); see ``judge``.
PATTERNS = (
    ("||spam-farm.", "block"), ("||cheap-pills.", "block"), ("-casino-", "block"), ("||casino-", "block"), (".casino.", "block"), ("||*-pharmacy.", "block"), ("/porn/", "block"), ("||porn.", "block"), ("||xxx.", "block"),
    ("/wp-login.php|", "block"), ("?sessionid=", "block"), ("||ads.", "block"), ("||adserver.", "block"), ("/cgi-bin/*.exe|", "block"), ("^utm_campaign=spam^", "block"), ("||spam-farm.*/about/", "allow"), ("||ads.*/transparency/", "allow"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a rule's row at most, for the check before a broadcast.
_RULE_BYTES = 256


def lower(c: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z in lower case; empty if there is none."""
    return F.coalesce(lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def rest_of(url: Column) -> Column:
    """What follows the host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.regexp_extract(rest_of(url), r"(?s)^([^?#]*)", 1)


def tokens(c: Column) -> Column:
    """The different runs of letters a-z and digits, once A-Z are in lower case."""
    return F.array_distinct(F.filter(F.split(lower(c), "[^a-z0-9]+"), lambda t: t != ""))


def _regex(pattern: Column) -> Column:
    """The regular expression of a pattern. Literal signs are escaped."""
    body = F.regexp_replace(pattern, r"^\|\|", "")
    ends = body.endswith("|")
    body = F.when(ends, body.substr(F.lit(1), F.length(body) - 1)).otherwise(body)
    body = F.regexp_replace(body, r"([\\.\[\]{}()+?$|\-])", r"\\$1")
    body = F.regexp_replace(F.regexp_replace(body, r"\^", "(?:[^A-Za-z0-9]|\\$)"), r"\*", ".*")
    return F.concat(F.when(pattern.startswith("||"), "(?s)^(?:[^/?#]*\\.)?").otherwise("(?s)"), body, F.when(ends, "$").otherwise(""))


def _literals(pattern: Column) -> Column:
    """The tokens that every address which the pattern matches must hold: those with a
    literal sign or an anchor on either side. Beside * a token could go on."""
    marked = F.when(pattern.startswith("||"), F.regexp_replace(pattern, r"^\|\|", "/")).otherwise(F.concat(F.lit("*"), pattern))
    marked = F.when(marked.endswith("|"), marked).otherwise(F.concat(marked, F.lit("*")))
    alone = F.regexp_extract_all(lower(marked), F.lit("(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])"), 1)
    return F.array_distinct(alone)


def rules_table(spark: SparkSession, host_rules: Sequence[tuple[str, str]] = (), patterns: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(rule, verdict, is_host) of two lists, as literals of the plan."""
    rows = [(r, v, True) for r, v in host_rules] + [(r, v, False) for r, v in patterns]
    names, kind = ("rule", "verdict", "is_host"), "array<struct<rule:string,verdict:string,is_host:boolean>>"
    listed = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(row, names, strict=True)]) for row in rows]).cast(kind)
    return spark.range(1).select(F.explode(listed).alias("r")).select("r.*")


def index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(token, rule, verdict, is_host, regex): each rule under that of its literal tokens which
    the fewest of urls (address) hold, ties to the smaller; under the empty token if it has
    none. Only tokens that some rule has are counted, and they are joined by size."""
    rules = rules.where("rule is not null and rule <> '' and verdict is not null").dropDuplicates(["rule", "is_host", "verdict"])
    pattern = F.when(F.col("is_host"), F.concat(F.lit("||"), "rule", F.when(F.col("rule").contains("/"), "").otherwise("/"))).otherwise(F.col("rule"))
    escaped = F.concat(F.lit("(?s)^(?:[^/?#]*\\.)?"), F.regexp_replace("rule", r"([\\.\[\]{}()+?$|*^\-])", r"\\$1"))
    escaped = F.concat(escaped, F.when(F.col("rule").contains("/"), "").otherwise("(?:[/?#]|$)"))
    regex = F.when(F.col("is_host"), escaped).otherwise(_regex(F.col("rule")))
    own = stage(rules.select("rule", "verdict", "is_host", regex.alias("regex"), _literals(pattern).alias("literals")), "rules")
    wanted = stage(own.select(F.explode("literals").alias("token")).distinct(), "tokens")
    seen = urls.select(F.explode(tokens(F.col("address"))).alias("token")).join(small(wanted, 64), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    each = own.select("rule", "verdict", "is_host", "regex", F.explode_outer("literals").alias("token")).join(seen, "token", "left")
    rarest = F.min_by("token", F.when(F.col("token").isNotNull(), F.struct(F.coalesce("n", F.lit(0)), "token")))
    return stage(each.groupBy("rule", "verdict", "is_host", "regex").agg(F.coalesce(rarest, F.lit("")).alias("token")), "index")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) of pages (page_id, url), a row for each;
    verdict is allow or block.

    rules: (rule, verdict, is_host). A host rule is a host in lower case and a path, such as
    ``example.net/en/``: it fits that host and its subdomains where the url's path starts
    with the rule's; without a path it fits all of the host. Of several the longest
    decides, of equal ones with two verdicts ``block``. If none fits, patterns decide. They
    match anywhere in the address (host and what follows it): ``||`` in front stands for the
    beginning of the host or of one of its labels, ``|`` behind for the end, ``*`` for
    anything, ``^`` for a sign that is neither letter nor digit, or the end. One that
    allows beats all that block; ``pattern`` is the longest of those that decide. No match:
    allow. A null url, or one without ://, has an empty host, path and address.

    Each rule stands in the index under its rarest literal token; a url's tokens fetch the
    rules to try, and only those run. Urls are numbered where they are read, so repeated
    rows each give one and a common host is dealt evenly; the best of a page's rules is
    taken before the shuffle, which carries a row a page. The index is broadcast up to
    8 MB, else joined.
    """
    address = F.concat("host", rest_of(F.col("url")))
    urls = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("address", address).drop("url")
    found = small(index(rules, urls), _RULE_BYTES)
    asked = urls.withColumn("row", F.monotonically_increasing_id()).withColumn("token", F.explode(F.array_union(F.array(F.lit("")), tokens(F.col("address")))))
    tried = asked.join(found, "token", "left").where("token = '' or rule is not null")
    allows, blocks = [(F.col("verdict") == v).cast("int") for v in ("allow", "block")]
    nothing, size = F.lit(0), F.length("rule")
    rank = lambda *x: F.struct(*[c.alias(f"r{i}") for i, c in enumerate(x)])
    order = F.when(F.col("is_host"), rank(F.lit(1), nothing, size, blocks)).otherwise(rank(nothing, allows, size, nothing))
    best = F.max(F.when(F.expr("address rlike regex"), F.struct(order.alias("order"), "rule", "verdict", "is_host")))
    out = tried.groupBy("row", "page_id", "host", "path").agg(best.alias("b"))
    of = lambda c: F.when(c, F.col("b.rule"))
    return out.select("page_id", "host", "path", of(F.col("b.is_host")).alias("rule"), F.coalesce("b.verdict", F.lit("allow")).alias("verdict"), of(~F.col("b.is_host")).alias("pattern"))


def _plain(pattern: str) -> str:
    """The regular expression of a pattern, for the SQL."""
    front, body = pattern.startswith("||"), pattern.removeprefix("||").removesuffix("|")
    signs = {"*": ".*", "^": "([^A-Za-z0-9]|$)"} | {c: "[" + c + "]" for c in ".?+$(){}"}
    return ("^([^/?#]*[.])?" if front else "") + "".join(signs.get(c, c) for c in body) + ("$" if pattern.endswith("|") else "")


def _values(rows: Sequence[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


ORACLE = f"""
WITH rules(rule, v) AS (VALUES {_values(HOST_RULES)}), patterns(pattern, v, re) AS (VALUES {_values([(p, v, _plain(p)) for p, v in PATTERNS])}),
u AS (SELECT row_number() OVER () AS row, page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*(.*)$', 1, 's') AS rest FROM pages),
p AS (SELECT row, page_id, host, regexp_extract(rest, '^[^?#]*', 0, 's') AS path, host || rest AS address FROM u),
h AS (SELECT row, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v FROM p, rules
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY row),
q AS (SELECT row, max(struct_pack(a := v = 'allow', n := length(pattern), pattern := pattern, v := v)) AS best FROM p, patterns WHERE regexp_matches(address, re, 's') GROUP BY row)
SELECT page_id, host, path, h.rule, coalesce(h.v, q.best.v, 'allow') AS verdict, CASE WHEN h.rule IS NULL THEN q.best.pattern END AS pattern
FROM p LEFT JOIN h ON p.row = h.row LEFT JOIN q ON p.row = q.row
"""
