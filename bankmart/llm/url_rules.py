"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` (host lower-cased).  Its
alternatives and the whole literal tokens that every match of an alternative
must hold are read off the expression itself (``literal_tokens``).  Token counts
over all URLs choose each alternative's rarest token as its index key; a URL's
distinct tokens fetch candidate rules by an equi-join, and only those run their
regular expression.  Rules with an alternative that has no whole literal token are
tried on every URL (one row per such rule and URL, so keep them few).

Host and path: host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z lower-cased; path goes on to ``?``, ``#`` or the end; a
URL that is null or has no ``://`` has both empty and matches no host rule.

Judgement: among the matching host rules the longest decides (ties: smaller
text); without one, a URL is blocked when a block pattern matches and no allow
pattern does; else it is allowed.

Defined cases: repeated page_ids are separate pages; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "[A-Za-z0-9]+"


class Rule(NamedTuple):
    """``kind`` host: ``text`` is host/path. ``kind`` pattern: ``text`` is a
    regular expression."""
    kind: str
    action: str
    text: str


HOST_RULES = (
    Rule("host", "block", "net/"),
    Rule("host", "allow", "example.net/en/"),
    Rule("host", "block", "example.com/de/"),
    Rule("host", "allow", "org/fr/"),
)

#: patterns for URLs that no host rule decides: advertising, trackers, binaries
PATTERN_RULES = (
    Rule("pattern", "block", r"(?s)^[^/]*\bcheap-pills\b"),
    Rule("pattern", "block", r"(?s)^[^/]*\bcasino\b"),
    Rule("pattern", "block", r"(?s)^(?:[^/]*\.)?ads?\."),
    Rule("pattern", "block", r"(?s)^(?:[^/]*\.)?doubleclick\."),
    Rule("pattern", "block", r"(?s)/banner(?:/|\.)"),
    Rule("pattern", "block", r"(?s)/adserver/"),
    Rule("pattern", "block", r"(?s)/tracking/pixel"),
    Rule("pattern", "block", r"(?s)/xxx/"),
    Rule("pattern", "block", r"(?s)\.exe$"),
    Rule("pattern", "allow", r"(?s)^[^/]*/robots\.txt$"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


ANY, EDGE = "any", "edge"       # unknown text, perhaps none; what no token can go on over
MAX_ALTERNATIVES = 64


def _is_token_char(code: int) -> bool:
    return chr(code).isascii() and chr(code).isalnum()


def _can_be_token(members) -> bool:
    """Whether a character class holds a letter or digit of tokens."""
    from re import _constants as c
    negated, inside = False, set()
    for op, value in members:
        if op is c.NEGATE:
            negated = True
        elif op is c.LITERAL:
            inside.add(value)
        elif op is c.RANGE:
            inside.update(range(value[0], min(value[1], 127) + 1))
        elif op is c.CATEGORY and value is c.CATEGORY_SPACE:
            inside.update(b" \t\n\r\f\v")
        elif negated:                       # of other categories nothing is known
            continue
        else:
            return True
    return any(_is_token_char(i) and (i in inside) != negated for i in range(128))


def _alternatives(items) -> list[list]:
    """Item lists (a literal character, ANY or EDGE each) of a parsed expression's alternatives."""
    from re import _constants as c
    out = [[]]
    for op, value in items:
        if op is c.LITERAL:
            parts = [[chr(value)]]
        elif op is c.AT:
            parts = [[EDGE]]                # start, end, boundary: no token goes on over them
            if value is c.AT_NON_BOUNDARY:
                parts = [[ANY]]
        elif op is c.IN:
            parts = [[ANY if _can_be_token(value) else EDGE]]
        elif op is c.SUBPATTERN:
            parts = _alternatives(value[3])
        elif op is c.BRANCH:
            parts = [x for branch in value[1] for x in _alternatives(branch)]
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, high, sub = value
            inner = _alternatives(sub)
            if low == 0 and high == 1:
                parts = [[], *inner]
            elif low == 0:
                parts = [[ANY]]
            elif low == 1 == high:
                parts = inner
            elif all(x == [EDGE] for x in inner):
                parts = [[EDGE]]
            else:
                parts = [[*x, ANY] for x in inner]
        elif op is c.ASSERT and value[0] == 1:
            ahead = _alternatives(value[1])
            edge = all(x and (x[0] == EDGE or len(x[0]) == 1 and not _is_token_char(ord(x[0]))) for x in ahead)
            parts = [[EDGE if edge else ANY]]
        else:
            parts = [[ANY]]
        if len(out) * len(parts) > MAX_ALTERNATIVES:
            parts = [[ANY]]
        out = [x + y for x in out for y in parts]
    return out


def literal_tokens(pattern: str) -> list[tuple[str, ...]]:
    """For each alternative of a pattern the whole tokens (lower case) that each of its matches
    contains.  An expression that Python cannot parse has one alternative without tokens."""
    from re import _parser
    try:
        found = _alternatives(_parser.parse(pattern))
    except re.error:
        return [()]
    out = set()
    for items in found:
        tokens, run, whole = set(), "", False
        for x in [*items, ANY]:                             # a match may stand anywhere in the URL
            if len(x) == 1 and _is_token_char(ord(x)):
                run += x
                continue
            if run and whole and x != ANY:
                tokens.add(run.lower())
            run, whole = "", x != ANY
        out.add(tuple(sorted(tokens)))
    return sorted(out)


def host_pattern(text: str) -> str:
    """Regular expression of a host/path rule.  The rule fits its host and all subdomains,
    and paths that start with its path."""
    literal, slash = text, "/" in text
    quoted = "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else "\\" + c for c in literal)
    end = "" if slash else "(?=/|$)"
    return rf"(?s)^(?:[^/]*\.)?{quoted}{end}"


def judge(pages: DataFrame, rules=HOST_RULES + PATTERN_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages``."""
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), "page_id",
                        host.alias("host"), path.alias("path"))
    compiled = []                               # one row per rule and alternative
    for number, r in enumerate(rules):
        pattern = host_pattern(r.text) if r.kind == "host" else r.text
        for choice, tokens in enumerate(literal_tokens(pattern)):
            compiled.append((number, choice, r.kind, r.action, r.text, pattern, list(tokens)))
    table = spark.createDataFrame(
        compiled, "number int, choice int, kind string, action string, text string, pattern string, tokens array<string>")

    target = F.concat("host", "path")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit("([a-z0-9]+)"), F.lit(1)))
    # statistics over all URLs, of the rules' tokens only (bounded by the rules)
    wanted = table.select(F.explode("tokens").alias("token")).distinct()
    counts = (urls.select(F.explode(tokens).alias("token"))
              .join(F.broadcast(wanted), "token").groupBy("token").count())
    keyed = (table.select("*", F.explode("tokens").alias("token"))
             .join(counts, "token", "left")
             .groupBy("number", "choice", "kind", "action", "text", "pattern")
             .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token"))["token"].alias("token"))
             .select("number", "kind", "action", "text", "pattern", "token").distinct())
    unkeyed = table.filter(F.size("tokens") == 0).select(
        "number", "kind", "action", "text", "pattern", F.lit("").alias("token")).distinct()
    index = keyed.unionByName(unkeyed)   # one row per rule; the rule list is a parameter

    # the empty token fetches the rules without a literal, and keeps every URL
    probes = urls.select("row", "page_id", "host", "path",
                         F.explode(F.concat(F.array(F.lit("")), tokens)).alias("token"))
    fetched = probes.join(F.broadcast(index), "token", "left").withColumn(
        "hit", F.coalesce(F.expr("concat(host, path) RLIKE pattern"), F.lit(False))
        & ((F.col("kind") != "host") | (F.col("host") != "")))
    decided = F.when(F.col("hit") & (F.col("kind") == "host"),
                     F.struct((-F.length("text")).alias("l"), F.col("text").alias("t"),
                              F.col("action").alias("a")))
    best = fetched.groupBy("row", "page_id", "host", "path").agg(
        F.min(decided).alias("d"),
        F.max(F.coalesce(F.col("hit") & (F.col("kind") == "pattern") & (F.col("action") == "block"),
                         F.lit(False))).alias("blocked"),
        F.max(F.coalesce(F.col("hit") & (F.col("kind") == "pattern") & (F.col("action") == "allow"),
                         F.lit(False))).alias("allowed"))
    verdict = F.coalesce(F.col("d.a"), F.when(F.col("blocked") & ~F.col("allowed"), "block")
                         .otherwise("allow"))
    return best.select("page_id", "host", "path", F.col("d.t").alias("rule"), verdict.alias("verdict"))


def op5(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))


def op5_sql(rules=HOST_RULES + PATTERN_RULES) -> str:
    """DuckDB SQL: every rule's expression tried on every URL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {q(r.kind)}, {q(r.action)}, {q(r.text)})" for i, r in enumerate(rules))
    tests = " or ".join(
        f"(kind = 'pattern' and number = {i} and regexp_matches(host || path, {q(r.text.removeprefix('(?s)'))}, 's'))"
        for i, r in enumerate(rules) if r.kind == "pattern")
    return f"""
with parts as (
  select page_id, row_number() over () as row,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
split as (
  select row, page_id, regexp_extract(rest, '^([^/?#]*)', 1, 's') as h,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') as path from parts),
hosts as (
  select row, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    path from split),
rules(number, kind, action, text) as (values {rows}),
hits as (
  select row, kind, action, text from hosts, rules
  where (kind = 'host' and host <> ''
         and (host = split_part(text, '/', 1) or ends_with(host, '.' || split_part(text, '/', 1)))
         and starts_with(path, substr(text, strpos(text, '/'))))
     or {tests}),
agg as (
  select row, arg_min(text, (-length(text), text)) filter (kind = 'host') as rule,
    arg_min(action, (-length(text), text)) filter (kind = 'host') as decided,
    bool_or(kind = 'pattern' and action = 'block') and not bool_or(kind = 'pattern' and action = 'allow') as blocked
  from hits group by row)
select page_id, host, path, rule,
  coalesce(decided, case when blocked then 'block' else 'allow' end) as verdict
from hosts left join agg using (row)"""
