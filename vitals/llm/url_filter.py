"""URL verdicts from pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over host and path with the literal tokens that any match must hold. Tokens are counted over
all URLs; each rule is filed under its rarest. A URL's own tokens fetch its candidate rules, and only their expressions run.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

TOKEN = re.compile(r"[A-Za-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``name``: host and path prefix of a listed rule, else None; ``tokens``: literals of every match; ``rank``: longer wins."""

    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int
    name: str | None = None


def listed(verdict: str, host: str, path: str = "/") -> Rule:
    """A rule for a host with its subdomains, and all paths that begin with ``path``."""
    # the last token of the path may go on in the URL, so it is no literal of its own
    whole = TOKEN.findall(host) + TOKEN.findall(path[: len(path) - len(re.search(r"[A-Za-z0-9]*$", path)[0])])
    return Rule(rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", verdict, tuple(whole), len(host + path), host + path)


#: The list of the query contract.
LISTED = (listed("allow", "org"), listed("block", "example.org", "/es/"), listed("block", "example.org", "/en/1"), listed("allow", "com", "/fr/"), listed("block", "com", "/de/"))
#: Rules of our own for URLs that no listed rule fits.
GENERAL = tuple(Rule(pattern, "block", tokens, 0) for pattern, tokens in (
    (r"(?:[^/]*\.)?spam-farm\.[^/]*/", ("spam", "farm")),
    (r"(?:[^/]*\.)?cheap-pills\.[^/]*/", ("cheap", "pills")),
    (r"(?:[^/]*\.)?ads-track\.[^/]*/", ("ads", "track")),
    (r"(?:[^/]*\.)?casino\.[^/]*/", ("casino",)),
    (r"[^/]*/(?:.*/)?wp-login\.php", ("wp", "login", "php")),
))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_counts(places: DataFrame, tokens: set[str]) -> dict[str, int]:
    """In how many URLs (host, path) each of the rules' tokens is; at most a row for each of these tokens comes back."""
    words = F.array_distinct(F.regexp_extract_all(F.concat_ws("/", "host", "path"), F.lit(r"([A-Za-z0-9]+)"), F.lit(1)))
    rows = places.select(F.explode(words).alias("token")).where(F.col("token").isin(sorted(tokens))).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def index(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rules by their rarest token, ties by the token; rules without a literal are under the empty string."""
    out = defaultdict(list)
    for i, rule in enumerate(rules):
        out[min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")].append(i)
    return dict(out)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = LISTED, general: tuple[Rule, ...] = GENERAL, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict, candidates, pattern: one row for each row of ``pages`` (page_id, url).

    The longest listed rule that fits decides and is named in ``rule``, ties by name; else a general rule, the first that
    fits, whose ``pattern`` is given; else ``default``. ``candidates``: expressions that ran. A URL that is null or has no
    ``://`` has an empty host and path, which no rule fits. Repeated rows stay. The rules must fit in a task's closure.
    """
    every = (*rules, *general)
    places = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = index(every, token_counts(places, {t for r in every for t in r.tokens}))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r.pattern, re.S) for r in every]
        for batch in batches:
            out: list[tuple] = []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                place = host + path
                candidates = sorted({i for t in {"", *TOKEN.findall(host), *TOKEN.findall(path)} for i in found.get(t, ())}) if host else []
                fits = [i for i in candidates if compiled[i].match(place)]
                best = max((i for i in fits if i < len(rules)), key=lambda i: (every[i].rank, every[i].name), default=None)
                if best is None:
                    best = min(fits, default=None)
                rule = every[best] if best is not None else None
                out.append((rule.name if rule else None, rule.verdict if rule else default, len(candidates), rule.pattern if rule else None))
            columns = [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["page_id", "host", "path", "rule", "verdict", "candidates", "pattern"])

    return places.mapInArrow(task, "page_id long, host string, path string, rule string, verdict string, candidates long, pattern string")
