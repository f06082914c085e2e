"""URL rules indexed by their rarest literal token, in DataFrame functions only."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, quoted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules the index is a literal in the plan; up to so many bytes of rules it is broadcast.
LITERAL, BROADCAST_BYTES = 64, 16 << 20


class Rule(NamedTuple):
    """A rule for a host with its subdomains, and the paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """The rule as a regular expression on host + path."""
        end = "" if self.path else r"(?:/|\z)"
        return rf"\A(?:[^/]*\.)?{_literal(self.host)}{_literal(self.path)}{end}" if self.host else rf"\A[^/]*{_literal(self.path)}{end}"

    @property
    def tokens(self) -> list[str]:
        """Literals that stand as whole tokens in every url that the rule fits."""
        whole = self.path.split("/")[:-1]
        return sorted({"." + x for x in self.host.split(".") if x} | {"/" + x for x in whole if x})


def _literal(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text, flags=re.ASCII)


def host_of(url: str | Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """What stands after the host up to ``? #``; else empty."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: str | Column) -> Column:
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def tokens_of(host: Column, path: Column) -> Column:
    """The distinct labels of the host and segments of the path, told apart by their first character."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("."), x))
    # a segment counts only if it ends with a slash: a rule's path names whole segments by theirs
    whole = F.split(path, "/")
    segments = F.transform(F.slice(whole, 1, F.greatest(F.size(whole) - 1, F.lit(0))), lambda x: F.concat(F.lit("/"), x))
    return F.array_distinct(F.filter(F.concat(labels, segments), lambda x: F.length(x) > 1))


def rarest(urls: DataFrame, rules: Sequence[Rule]) -> dict[Rule, str | None]:
    """For each rule its literal token that the fewest rows of ``urls(host, path)`` hold.

    Counts cover all rows and only tokens that some rule has, so their number is bounded by the
    rules; they are combined before the shuffle.  Ties go to the smaller token.  A rule without a
    whole token has None: it is a candidate for every url.
    """
    named = sorted({t for r in rules for t in r.tokens})
    if not named:
        return {r: None for r in rules}
    seen = urls.select(F.explode(tokens_of(F.col("host"), F.col("path"))).alias("t"))
    if len(named) <= 4 * LITERAL:
        seen = seen.where(F.col("t").isin(named))
    else:  # a table of tokens, which is as small as the rules are
        seen = seen.groupBy("t").agg(F.count("*").alias("c")).join(urls.sparkSession.createDataFrame([(t,) for t in named], "t string"), "t", "left_semi")
    n = F.sum("c") if "c" in seen.columns else F.count("*")
    count = {r["t"]: r["n"] for r in seen.groupBy("t").agg(n.alias("n")).collect()}
    return {r: min(r.tokens, key=lambda t: (count.get(t, 0), t), default=None) for r in rules}


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", otherwise: str = "allow") -> DataFrame:
    """All columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    Each rule stands in an index under its rarest literal token.  The tokens of a url fetch the
    candidates, and only their regular expressions run; of those that match, the longest rule wins
    (then the longer host, then the name).  Without one, ``rule`` is null and ``otherwise`` holds.

    * Null urls and urls without ``://`` have an empty host and path.
    * Repeated rows are all judged; clashing columns of ``pages`` are replaced; an empty table gives
      an empty table.
    * Of equal rules the last one counts.

    Up to :data:`LITERAL` rules the judgement is a projection: nothing is shuffled but token counts.
    With more, distinct urls meet the index in a join: by broadcast up to :data:`BROADCAST_BYTES` of
    rules, beyond that by a shuffled join in which a token's urls are spread over salted copies of
    its rules.  The rules themselves are a list of the driver's.
    """
    rules = list({(r.host, r.path): r for r in map(lambda r: Rule(*r), rules)}.values())
    kept = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    if url.lower() in {"host", "path", "rule", "verdict"}:
        raise ValueError("the url column clashes with a column of the result")
    base = pages.select(*[F.col(quoted(c)) for c in kept], host_of(quoted(url)).alias("host"), path_of(quoted(url)).alias("path"))
    index: dict[str, list[dict]] = {}
    for r, t in rarest(base, rules).items():
        index.setdefault(t or "", []).append({"n": len(r.name), "h": len(r.host), "rule": r.name, "verdict": r.verdict, "pattern": r.pattern})
    always = [{**x} for x in index.get("", [])]
    if len(rules) <= LITERAL:
        best = _by_literal(index, always)
        win = free_name(base, "win__")
        judged = base.withColumn(win, best)
        return judged.select(*[F.col(quoted(c)) for c in base.columns], F.col(f"{win}.rule").alias("rule"), F.coalesce(F.col(f"{win}.verdict"), F.lit(otherwise)).alias("verdict"))
    return _by_join(base, index, always, otherwise)


_ENTRY = "struct<n:int,h:int,rule:string,verdict:string,pattern:string>"


def _fits(candidates: Column, host: Column, path: Column) -> Column:
    return F.array_max(F.filter(candidates, lambda c: F.rlike(F.concat(host, path), c["pattern"])))


def _by_literal(index: dict[str, list[dict]], always: list[dict]) -> Column:
    host, path = F.col("host"), F.col("path")
    table = F.from_json(F.lit(json.dumps({k: v for k, v in index.items() if k})), f"map<string,array<{_ENTRY}>>")
    every = F.from_json(F.lit(json.dumps(always)), f"array<{_ENTRY}>")
    fetched = F.flatten(F.filter(F.transform(tokens_of(host, path), lambda t: F.element_at(table, t)), lambda x: x.isNotNull()))
    return _fits(F.concat(fetched, every), host, path)


def _by_join(base: DataFrame, index: dict[str, list[dict]], always: list[dict], otherwise: str) -> DataFrame:
    spark = base.sparkSession
    rows = [(t, json.dumps(x)) for t, v in index.items() if t for x in v] or [("", "null")]
    salts = 1 if sum(len(t) + len(x) for t, x in rows) <= BROADCAST_BYTES else 16
    entries = spark.createDataFrame(rows, "t string, x string")
    entries = entries.select("t", F.from_json("x", _ENTRY).alias("c"))
    urls = base.select("host", "path").distinct()
    asked = urls.select("host", "path", F.explode(tokens_of(F.col("host"), F.col("path"))).alias("t"))
    if salts == 1:
        met = asked.join(F.broadcast(entries), "t")
    else:
        spread = entries.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = asked.withColumn("s", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int")).join(spread, ["t", "s"])
    hit = met.where(F.rlike(F.concat("host", "path"), F.col("c.pattern"))).groupBy("host", "path").agg(F.max("c").alias("w"))
    out = base.join(hit, ["host", "path"], "left")
    every = F.from_json(F.lit(json.dumps(always)), f"array<{_ENTRY}>")
    w = F.array_max(F.array_compact(F.array(F.col("w"), _fits(every, F.col("host"), F.col("path")))))
    out = out.withColumn("w", w)
    return out.select(*[F.col(quoted(c)) for c in base.columns], F.col("w.rule").alias("rule"), F.coalesce(F.col("w.verdict"), F.lit(otherwise)).alias("verdict"))
