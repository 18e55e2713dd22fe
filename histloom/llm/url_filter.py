"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression plus the literal tokens that any matching
URL must contain.  A rule is filed under the one of its tokens that is rarest
in the corpus; the tokens of a URL fetch candidate rules by an equality join,
and only those run their expression.  DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters a token is made of (in host and path alike).
_TOKEN = re.compile(r"[A-Za-z0-9]+")
_NOT_TOKEN = "[^A-Za-z0-9]+"
#: Separates host and path in the matched subject; it ends a url's path, so it occurs in neither.
_SEP = "?"


@dataclass(frozen=True)
class UrlRule:
    """``action`` ('allow' or 'block') for ``host`` and its subdomains when the
    path starts with ``path`` ('/...')."""
    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def pattern(self) -> str:
        return rf"^(?:[^?]*\.)?{_quote(self.host)}\?{_quote(self.path)}"

    def tokens(self) -> list[str]:
        """Tokens that every matching URL has whole: the host's, and those of
        the path that another character follows."""
        ended = re.match(r".*[^A-Za-z0-9]", self.path)
        return sorted(set(_TOKEN.findall(self.host)) | set(_TOKEN.findall(ended.group() if ended else "")))


@dataclass(frozen=True)
class HostWordRule:
    """``action`` for hosts with ``word`` between dots or hyphens.  It only
    settles urls that no ``UrlRule`` fits."""
    action: str
    word: str

    @property
    def name(self) -> str:
        return self.word

    def pattern(self) -> str:
        return rf"^(?:[^?]*[.-])?{_quote(self.word)}(?:[.-][^?]*)?\?"

    def tokens(self) -> list[str]:
        return _TOKEN.findall(self.word)


def _quote(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", literal)


#: The rules of the production query.
RULES = [
    UrlRule("block", "net"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
]

#: Words that mark a host as gambling, adult, drug trade, advertising or spam.
HOST_WORDS = [HostWordRule("block", w) for w in (
    "adult", "ads", "bet", "bets", "betting", "casino", "escort", "gambling", "jackpot", "pharmacy",
    "pill", "pills", "poker", "porn", "slots", "spam", "viagra", "xxx")]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host stands after the first ``://`` up to ``/ ? #``,
    A-Z lower-cased; the path goes on up to ``? #``.  Null or no ``://``: both empty."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def judge_urls(pages: DataFrame, rules: list[UrlRule] = RULES,
               words: list[HostWordRule] = HOST_WORDS, default: str = "allow") -> DataFrame:
    """Verdict of every page's url: page_id, host, path, rule (name of the
    longest fitting rule of ``rules``, null if none), verdict (that rule's
    action, else that of a fitting host word, else ``default``) and host_word
    (the word that decided, else null).  Of equally long rules or words the
    smaller name wins.

    Only page_id and url are read.  One row per page row: repeated or null
    page_ids are kept, a null url has empty host and path and gets ``default``.

    Equal (host, path) are judged once.  The rule tables are as long as the
    given lists; Spark sees their size and picks the join; a hot token or host
    is met by partial aggregation and, in shuffled joins, by AQE's skew splits."""
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    listed = [(0, r) for r in rules] + [(1, r) for r in words]
    if plain := [r for _, r in listed if not r.tokens()]:
        raise ValueError(f"rules without a whole literal token: {plain}")
    table = spark.createDataFrame(
        [(f"{tier}:{r.name}", tier, r.name, r.action, r.pattern(), len(r.name), r.tokens()) for tier, r in listed],
        "id string, tier int, name string, action string, pattern string, length int, words array<string>")

    tokens = parsed.select("host", "path").distinct().select("host", "path", F.explode(
        F.array_distinct(F.split(F.concat_ws("/", "host", "path"), _NOT_TOKEN))).alias("token"))
    literal = table.select("id", F.explode("words").alias("word"))
    found = (tokens.join(literal.select("word").distinct(), F.col("token") == F.col("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    filed = (literal.join(found, "word", "left")
             .groupBy("id").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("key")))
    index = table.drop("words").join(filed, "id")

    best = (tokens.join(index, F.col("token") == F.col("key"))
            .where(F.rlike(F.concat_ws(_SEP, "host", "path"), F.col("pattern")))
            .groupBy("host", "path")
            .agg(F.min_by(F.struct("tier", "name", "action"),
                          F.struct("tier", -F.col("length"), "name")).alias("hit")))
    return (parsed.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path",
                    F.when(F.col("hit.tier") == 0, F.col("hit.name")).alias("rule"),
                    F.coalesce(F.col("hit.action"), F.lit(default)).alias("verdict"),
                    F.when(F.col("hit.tier") == 1, F.col("hit.name")).alias("host_word")))
