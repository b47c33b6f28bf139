"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over host and path. `||host/path` fits the host and its subdomains if the path starts with that
path; any other pattern is looked for anywhere, in lower case, where `*` is any run and `^` a separator or an end.
Literal tokens are runs of letters and digits with a boundary on both sides, so that a URL that the rule fits holds
each of them as a token of its own. A rule is filed under the token that fewest URLs hold; a URL's tokens fetch
candidate rules, and only these run their regular expressions. Rules without such a token are always candidates.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[0-9a-z]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES_PER_PASS = 200_000


@dataclass(frozen=True)
class Rule:
    pattern: str
    verdict: str  # allow or block

    @property
    def anchored(self) -> bool:
        return self.pattern.startswith("||")

    @property
    def name(self) -> str:
        return self.pattern[2:] if self.anchored else self.pattern

    def regex(self) -> str:
        if self.anchored:
            host, _, path = self.name.partition("/")
            return rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape('/' + path)}"
        parts = {"*": ".*", "^": "(?:[^0-9a-z]|$|^)"}
        return "".join(parts.get(c, re.escape(c)) for c in self.pattern)

    def tokens(self) -> set[str]:
        """Tokens that every URL that the rule fits must hold, in lower case."""
        whole, found = self.name.lower(), set()
        for m in TOKEN.finditer(whole):
            before, after = whole[: m.start()][-1:], whole[m.end() :][:1]
            if self.anchored:
                sure = after != ""  # a path may go on where the pattern ends; a host starts at a boundary
            else:
                sure = before not in ("", "*") and after not in ("", "*")
            if sure and before.isascii() and after.isascii():
                found.add(m[0])
        return found


def best(rules: Sequence[Rule]):
    """The longest rule wins; of equally long ones the smallest pattern."""
    return min(rules, key=lambda r: (-len(r.name), r.name, r.verdict), default=None)


def split_url(url):
    """(host, path) columns: the host after the first :// in lower case A-Z, the path from there up to ? or #."""
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(there, host).otherwise(""), F.when(there, path).otherwise("")


def token_counts(urls: DataFrame, tokens: DataFrame) -> DataFrame:
    """In how many rows of urls(host, path) each of tokens(token) occurs; counted over all of them. The tokens are those
    of the rules, which the driver holds anyway, so they are broadcast."""
    held = F.array_distinct(F.split(F.lower(F.concat_ws("/", "host", "path")), "[^0-9a-z]+"))
    return urls.select(F.explode(held).alias("token")).join(F.broadcast(tokens), "token", "left_semi").groupBy("token").count()


def filed(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token, the smallest of equally rare ones; under '' those without any."""
    index = defaultdict(list)
    for r in rules:
        index[min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default="")].append(r)
    return dict(index)


def judge(urls: DataFrame, base: Sequence[Rule], patterns: Sequence[Rule], per_pass: int = RULES_PER_PASS) -> DataFrame:
    """urls with host, path, rule and verdict added, for the columns page_id and url.

    The longest base rule that fits names rule and verdict. Without one, rule is null and the verdict is that of the
    longest pattern that fits, allow without one. A null url or one without :// has an empty host and path, which no
    anchored rule fits. More rules than per_pass are run in several passes, of which the best outcome is kept.
    """
    spark = urls.sparkSession
    host, path = split_url(F.col("url"))
    out = urls.select("page_id", host.alias("host"), path.alias("path"))
    every = [(True, r) for r in base] + [(False, r) for r in patterns]
    counts: dict[str, int] = {}
    if every:
        wanted = sorted({t for _, r in every for t in r.tokens()})
        if wanted:
            table = spark.createDataFrame([(t,) for t in wanted], "token string")
            counts = {t: n for t, n in token_counts(out, table).collect()}  # a row for each token of the rules at most
    carried = ["base", "base_verdict", "pattern", "pattern_verdict"]
    out = out.select("*", *[F.lit(None).cast("string").alias(c) for c in carried])
    for at in range(0, len(every), per_pass):
        part = every[at : at + per_pass]
        out = out.mapInArrow(_pass([r for b, r in part if b], [r for b, r in part if not b], counts), out.schema)
    return out.select(
        "page_id", "host", "path",
        F.expr("substring(base, 3)").alias("rule"),
        F.coalesce("base_verdict", "pattern_verdict", F.lit("allow")).alias("verdict"),
    )


def _pass(base: list[Rule], patterns: list[Rule], counts: dict[str, int]):
    both = [filed(rules, counts) for rules in (base, patterns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[Rule, re.Pattern] = {}

        def fits(r: Rule, url: str) -> bool:
            if r not in compiled:
                compiled[r] = re.compile(r.regex(), re.S)
            return compiled[r].search(url) is not None

        for b in batches:
            hosts, paths = b.column(1).to_pylist(), b.column(2).to_pylist()
            columns: list[list] = [[], [], [], []]
            for h, p, *so_far in zip(hosts, paths, *(c.to_pylist() for c in b.columns[3:])):
                url, low = h + p, (h + p).lower()
                tokens = [*dict.fromkeys(TOKEN.findall(low)), ""]
                for k, index in enumerate(both):
                    found = [r for t in tokens for r in index.get(t, ()) if fits(r, url if r.anchored else low)]
                    if so_far[2 * k] is not None:
                        found.append(Rule(*so_far[2 * k : 2 * k + 2]))
                    won = best(found)
                    columns[2 * k].append(won and won.pattern)
                    columns[2 * k + 1].append(won and won.verdict)
            kept = [*b.columns[:3], *(pa.array(c, pa.string()) for c in columns)]
            yield pa.RecordBatch.from_arrays(kept, names=b.schema.names)

    return run
