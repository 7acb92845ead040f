"""URL filter: host and path rules first, then a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import map_batches

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
A_Z = str.maketrans(UPPER, UPPER.lower())
TERM_CHARACTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class UrlPolicy:
    """What to reject.

    One term of ``strict``, or ``soft_limit`` different terms of ``soft``, blocks a URL.  A term
    counts where no letter or digit touches it.  ``rules`` are (verdict, host/path): the longest that fits wins over the terms.
    """

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    soft_limit: int = 2
    rules: tuple[tuple[str, str], ...] = ()


DEFAULT = UrlPolicy(
    strict=("casino", "poker", "porn", "porno", "xxx", "adult", "escort", "escorts", "viagra", "cialis", "warez", "malware", "phishing"),
    soft=(
        "ad", "ads", "track", "tracker", "tracking", "click", "popup", "spam", "farm", "cheap", "pills", "pharmacy", "free", "bet", "bets",
        "betting", "win", "jackpot", "bonus", "loan", "loans", "crack", "keygen", "torrent", "dating", "hot", "sexy", "coupon", "replica",
    ),
    rules=(("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")),
)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty for null and for a URL without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((at for c in "/?#" if (at := rest.find(c)) >= 0), default=len(rest))
    end = min((at for c in "?#" if (at := rest.find(c, cut)) >= 0), default=len(rest))
    return rest[:cut].translate(A_Z), rest[cut:end]


class UrlJudge:
    def __init__(self, policy: UrlPolicy) -> None:
        self.policy = policy
        self.automaton = ahocorasick.Automaton()
        for strict, terms in ((False, policy.soft), (True, policy.strict)):
            for term in terms:
                self.automaton.add_word(term, (term, strict))
        self.automaton.make_automaton()
        self.rules: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in sorted(policy.rules, key=lambda r: (-len(r[1]), r[1])):
            host, slash, path = rule.partition("/")
            self.rules.setdefault(host, []).append((slash + path, rule, verdict))

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        found = []
        while host:
            found += [(rule, verdict) for start, rule, verdict in self.rules.get(host, ()) if path.startswith(start)]
            host = host.partition(".")[2]
        return max(found, key=lambda r: len(r[0]), default=None)

    def rejects(self, url: str) -> bool:
        soft: set[str] = set()
        for last, (term, strict) in self.automaton.iter(url):
            before, after = last - len(term), last + 1
            if (before >= 0 and url[before] in TERM_CHARACTERS) or (after < len(url) and url[after] in TERM_CHARACTERS):
                continue
            if strict:
                return True
            soft.add(term)
            if len(soft) >= self.policy.soft_limit:
                return True
        return False

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path = split_url(url)
        if rule := self.rule(host, path):
            return host, path, *rule
        return host, path, None, "block" if self.rejects((url or "").translate(A_Z)) else "allow"


@cache
def judge_of(policy: UrlPolicy) -> UrlJudge:
    return UrlJudge(policy)


def judge_urls(pages: DataFrame, policy: UrlPolicy = DEFAULT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict): one row per row of ``pages``.

    One scan of the two columns, no shuffle.  A null or empty URL has no host, path or rule and
    is allowed.  Repeated rows and null ids are judged like any other; other columns are not read.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def build(batch: pa.RecordBatch) -> dict:
        judge = judge_of(policy).judge
        host, path, rule, verdict = zip(*map(judge, batch.column(1).to_pylist()), strict=True)
        texts = {"host": host, "path": path, "rule": rule, "verdict": verdict}
        return {id_col: batch.column(0), **{k: pa.array(v, pa.string()) for k, v in texts.items()}}

    schema = f"{id_col} {kind}, host string, path string, rule string, verdict string"
    return map_batches(pages.select(F.col(id_col), F.col(url_col)), schema, build)


def oracle(policy: UrlPolicy = DEFAULT) -> str:
    """DuckDB SQL for ``judge_urls`` on ``pages``."""
    lower = f"translate({{}}, '{UPPER}', '{UPPER.lower()}')"
    hit = "regexp_matches(low, '(^|[^a-z0-9]){0}([^a-z0-9]|$)')".format
    strict = " OR ".join(map(hit, policy.strict))
    soft = " + ".join(f"CAST({hit(t)} AS INTEGER)" for t in policy.soft)
    fits = []
    for verdict, rule in sorted(policy.rules, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", rule, verdict))
    case = lambda k: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + " END"
    return f"""
WITH cut AS (SELECT page_id, url, substr(url, strpos(url, '://') + 3) AS rest, strpos(url, '://') > 0 AS whole FROM pages),
parts AS (SELECT page_id, coalesce({lower.format('url')}, '') AS low,
  CASE WHEN whole THEN regexp_extract(rest, '^[^/?#]*') ELSE '' END AS name,
  CASE WHEN whole THEN rest ELSE '' END AS rest FROM cut),
named AS (SELECT page_id, low, {lower.format('name')} AS host,
  regexp_extract(substr(rest, length(name) + 1), '^[^?#]*') AS path FROM parts)
SELECT page_id, host, path, {case(1)} AS rule,
  coalesce({case(2)}, CASE WHEN {strict} OR {soft} >= {policy.soft_limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM named"""
