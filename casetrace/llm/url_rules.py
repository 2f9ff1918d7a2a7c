"""URL verdicts by pattern rules indexed under their rarest literal token.

A rule is a regular expression with the literal tokens (runs of letters and
digits) that any fitting URL must hold.  Each rule is filed under the one of
its tokens that the table's URLs hold least often.  A URL's distinct tokens
fetch the rules filed under them, and only those run their expressions.  Of
the fitting rules the first by (list, longest, name) decides: listed
host-and-path rules before the general patterns.

Up to ``ROW_RULES`` rules are constants of the plan: each row fetches and runs
its own, and only token counts are shuffled.  More rules are a table: distinct
URLs are judged once and joined back, rows of very frequent URLs in place.  The
rules are broadcast while there are at most ``BROADCAST_RULES`` and joined by
shuffle beyond.  All ways give the same rows.  A rule without any literal token
cannot be filed and is refused.

Result for odd input: a null URL, or one without ``://``, has an empty host
and path, fits no rule and is allowed; an empty table gives no rows; repeated
rows are each judged; other columns travel along unless named like the output.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import LOWER, UPPER, frozen, require
from casetrace.llm.skew import join_to_unique

BROADCAST_RULES = 100_000
ROW_RULES = 64
_TOKEN = r"[a-z0-9]+"
# what a rule's expression sees: the host and the path, a line feed between them
SUBJECT_BREAK = "\n"


@dataclass(frozen=True)
class Rule:
    name: str             # shown in the result; None is shown for patterns
    verdict: str          # allow or block
    pattern: str          # fits host + line feed + path, both as returned
    tokens: tuple[str, ...]
    level: int = 1        # 0: listed host and path, 1: general pattern
    length: int = 0


def listed(verdict: str, host_path: str) -> Rule:
    """A rule ``host/path``: its host and all subdomains, and every path that
    starts with its path."""
    host, slash, path = host_path.partition("/")
    path = slash + path
    # the path's last token may go on in the URL, so it is no literal token
    whole = re.findall(_TOKEN, host.lower()) + re.findall(_TOKEN + r"(?=[^A-Za-z0-9])", path)
    return Rule(host_path, verdict,
                rf"^(?:[^\n]*\.)?{re.escape(host.lower())}\n{re.escape(path)}",
                tuple(dict.fromkeys(whole)), 0, len(host_path))


def pattern(name: str, verdict: str, expression: str, tokens: Sequence[str]) -> Rule:
    return Rule(name, verdict, expression, tuple(tokens), 1, len(expression))


# Listed rules, then general patterns of unwanted hosts.
LISTED = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
          ("allow", "com/fr/"), ("block", "com/de/"))
UNWANTED = (
    ("spam-farm", r"(?:^|\.)spam-farm\.", ("spam", "farm")),
    ("cheap-pills", r"(?:^|\.)cheap-pills\.", ("cheap", "pills")),
    ("casino", r"(?:^|[.-])casino[.-]", ("casino",)),
    ("ads", r"(?:^|[.-])ads[.-]", ("ads",)),
    ("login", r"\n/(?:[^\n]*/)?login(?:/|$)", ("login",)),
)


def default_rules() -> list[Rule]:
    return ([listed(v, r) for v, r in LISTED]
            + [pattern(n, "block", e, t) for n, e, t in UNWANTED])


def with_host_path(df: DataFrame) -> DataFrame:
    """Add ``host`` (between the first ``://`` and ``/``, ``?``, ``#`` or the
    end, A-Z lower-cased) and ``path`` (from there to ``?``, ``#`` or the end)."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    out = df.withColumn("__rest", F.coalesce(rest, F.lit("")))
    raw = F.regexp_extract("__rest", r"\A[^/?#]*", 0)
    return (out.withColumn("host", F.translate(raw, UPPER, LOWER))
            .withColumn("path", F.regexp_extract(
                F.expr("substring(__rest, length(host) + 1)"), r"\A[^?#]*", 0))
            .drop("__rest"))


def _subject() -> Column:
    return F.concat("host", F.lit(SUBJECT_BREAK), "path")


def _tokens() -> Column:
    return F.array_distinct(F.regexp_extract_all(
        F.translate(_subject(), UPPER, LOWER), F.lit(f"({_TOKEN})"), 1))


def file_rules(tokens: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule with the token it is filed under: the one that the
    fewest rows of ``tokens`` hold, then the least."""
    rules = list(rules)
    for rule in rules:
        if not rule.tokens:
            raise ValueError(f"rule {rule.name} has no literal token")
    held = tokens.sparkSession.createDataFrame(
        [(i, r.name, r.verdict, r.pattern, r.level, r.length, [t.lower() for t in r.tokens])
         for i, r in enumerate(rules)],
        "rule_no int, name string, verdict string, pattern string, level int, length int, "
        "tokens array<string>")
    wanted = held.select("rule_no", F.explode("tokens").alias("token"))
    sought = wanted.select("token").distinct()
    if len(rules) <= BROADCAST_RULES:
        sought = F.broadcast(sought)
    counts = tokens.join(sought, "token", "left_semi").groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))
    rarest = (wanted.join(counts, "token", "left").groupBy("rule_no")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))["token"].alias("token")))
    return frozen(held.drop("tokens").join(rarest, "rule_no"))


def _judged_in_rows(own: DataFrame, rules: list[Rule]) -> DataFrame:
    """``own`` with ``__best``, the deciding rule, found within each row."""
    rows = with_host_path(own)
    literal = sorted({t.lower() for r in rules for t in r.tokens})
    held = rows.select(F.explode(F.array_intersect(
        _tokens(), F.array(*map(F.lit, literal)))).alias("token"))
    under: dict[str, list] = {}
    # at most ROW_RULES rows
    for r in file_rules(held, rules).orderBy("rule_no").collect():
        under.setdefault(r["token"], []).append(F.struct(
            F.lit(r["level"]).alias("level"), F.lit(-r["length"]).alias("shorter"),
            F.lit(r["name"]).alias("name"), F.lit(r["rule_no"]).alias("rule_no"),
            F.lit(r["verdict"]).alias("verdict"), F.lit(r["pattern"]).alias("pattern")))
    index = F.create_map(*[x for token, filed in under.items()
                           for x in (F.lit(token), F.array(*filed))])
    fetched = F.flatten(F.transform(
        F.array_intersect(_tokens(), F.array(*map(F.lit, under))), lambda t: index[t]))
    return (rows.withColumn("__subject", _subject())
            .withColumn("__best", F.array_min(F.filter(
                fetched, lambda r: F.call_function("rlike", F.col("__subject"), r["pattern"]))))
            .drop("__subject"))


def _judged_by_url(own: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same by joins with a table of rules."""
    some = own.where("url is not null")
    distinct = frozen(with_host_path(some.select("url").distinct()))
    tokens = distinct.select("url", "host", "path", F.explode(_tokens()).alias("token"))
    filed = file_rules(tokens, rules)
    if len(rules) <= BROADCAST_RULES:
        filed = F.broadcast(filed)
    fitting = tokens.join(filed, "token").where(F.expr("concat(host, '\\n', path) rlike pattern"))
    best = fitting.groupBy("url").agg(F.min(F.struct(
        "level", (-F.col("length")).alias("shorter"), "name", "rule_no", "verdict",
        "pattern")).alias("__best"))
    judged = frozen(distinct.join(best, "url", "left"))
    # null URLs take no part in the join, so they cannot pile up in a task
    return join_to_unique(some, judged, "url", some.count()).unionByName(
        with_host_path(own.where("url is null")), allowMissingColumns=True)


def judge(pages: DataFrame, rules: Iterable[Rule] | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (of a listed rule that
    decides, else null), ``matched`` (name of any deciding rule) and
    ``verdict`` (allow where no rule fits)."""
    require(pages, ["url"])
    rules = default_rules() if rules is None else list(rules)
    own = pages.drop("host", "path", "rule", "matched", "verdict")
    if not rules:
        return with_host_path(own).select("*", F.lit(None).cast("string").alias("rule"),
                                          F.lit(None).cast("string").alias("matched"),
                                          F.lit("allow").alias("verdict"))
    judged = (_judged_in_rows if len(rules) <= ROW_RULES else _judged_by_url)(own, rules)
    return judged.select(
        *[F.col(f"`{c}`") for c in own.columns], "host", "path",
        F.when(F.col("__best.level") == 0, F.col("__best.name")).alias("rule"),
        F.col("__best.name").alias("matched"),
        F.coalesce("__best.verdict", F.lit("allow")).alias("verdict"))
