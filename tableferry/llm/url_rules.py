"""URL rules found through their rarest literal token; only fetched rules run their pattern."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)
# Rules are held by every worker; beyond this many, split the list and combine the verdicts.
MOST_RULES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and what the path begins with."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """Matches host and path written one after the other; a host holds no slash."""
        return rf"(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}" + ("" if self.path else r"(?:/|\Z)")

    @property
    def tokens(self) -> list[str]:
        """Literal tokens of every URL the rule fits: labels of the host, closed segments of the path."""
        labels = [f"{label}." for label in self.host.split(".") if label]
        return labels + [f"/{part}" for part in self.path.split("/")[1:-1] if part]


def split_url(url: str | None) -> tuple[str, str]:
    """Host, lower-cased A-Z, and path; both empty for null or where ``://`` is missing."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search(r"[/?#]", rest)
    host, rest = (rest[: end.start()], rest[end.start() :]) if end else (rest, "")
    return host.translate(LOWERED), re.split(r"[?#]", rest, maxsplit=1)[0]


def url_tokens(host: str, path: str) -> set[str]:
    """The labels of a host and the segments of a path."""
    return {f"{x}." for x in host.split(".") if x} | {f"/{x}" for x in path.split("/")[1:] if x}


def _token_column(url: Column) -> Column:
    """:func:`url_tokens` as an expression, for counting."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(x, F.lit(".")))
    parts = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("/"), x))
    return F.array_distinct(F.concat(labels, parts))


def token_counts(pages: DataFrame, url_col: str, rules: list[Rule]) -> dict[str, int]:
    """In how many rows each token of the rules occurs; the driver gets a row per rule token at most."""
    spark = pages.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted({t for r in rules for t in r.tokens})], "token string")
    found = pages.select(F.explode(_token_column(F.col(url_col))).alias("token"))
    # every worker holds the rules' tokens anyway, and MOST_RULES bounds them
    found = found.join(F.broadcast(wanted), "token", "left_semi")
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


class RuleIndex:
    """Rules by their rarest token; those without a token are tried on every URL."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.rules = [(rule, re.compile(rule.pattern, re.DOTALL)) for rule in rules]
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for number, rule in enumerate(rules):
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
            (self.always if rarest is None else self.by_token.setdefault(rarest, [])).append(number)

    def match(self, host: str, path: str) -> tuple[Rule | None, int]:
        """The longest rule that fits, the first by name among equals, and how many patterns were run."""
        numbers = self.always + [n for t in url_tokens(host, path) for n in self.by_token.get(t, ())]
        fits = [self.rules[n][0] for n in numbers if host and self.rules[n][1].match(host + path)]
        return min(fits, key=lambda r: (-len(r.name), r.name, r.verdict), default=None), len(numbers)


OUT = ("host", "path", "rule", "verdict", "patterns_run")


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host, path, rule, verdict, patterns_run`` to every row; columns of these names are replaced.

    Where no rule fits, ``rule`` is null and the verdict is the default; that
    includes null and malformed URLs, whose host and path are empty. Repeated
    rows are judged alike. The URLs are read twice: once to count how common the
    rules' tokens are, once to judge; neither pass shuffles more than counts.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are more than {MOST_RULES}")
    counts = token_counts(pages, url_col, rules)
    others = [c for c in pages.columns if c not in OUT or c == url_col]
    kept = [c for c in others if c not in OUT]
    url_at = others.index(url_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(rules, counts)
        for batch in batches:
            parts = [split_url(u) for u in batch.column(url_at).to_pylist()]
            found = [index.match(*p) for p in parts]
            columns = [
                pa.array([h for h, _ in parts], pa.string()),
                pa.array([p for _, p in parts], pa.string()),
                pa.array([r.name if r else None for r, _ in found], pa.string()),
                pa.array([r.verdict if r else default for r, _ in found], pa.string()),
                pa.array([n for _, n in found], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *OUT])

    types = [T.StringType()] * 4 + [T.IntegerType()]
    fields = [pages.schema[c] for c in kept] + [T.StructField(n, t) for n, t in zip(OUT, types)]
    return pages.select(*[F.col(f"`{c}`") for c in others]).mapInArrow(run, T.StructType(fields))
