"""URL filtering by host and path rules and by patterns.

Every rule is indexed by the rarest of its literal tokens. A URL fetches the rules
indexed under one of its own tokens, and only for those is the regular expression run.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import ascii_lower


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over host and path, and words that every match must hold."""

    name: str
    pattern: str
    literals: tuple[str, ...]


#: Host words of link farms: betting, pills. Fixed values.
SPAM_PATTERNS = (
    PatternRule("casino", r"^([^/]*[.-])?casino[.-]", ("casino",)),
    PatternRule("pills", r"^([^/]*[.-])?cheap-pills[.-]", ("cheap", "pills")),
    PatternRule("bets", r"^([^/]*[.-])?free-bets[.-]", ("free", "bets")),
)

#: A token is a run of letters and digits, so host labels and path steps split alike.
TOKEN = r"[a-z0-9]+"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path; both empty for null or a URL without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), 1))


def compile_rules(urls: DataFrame, rules: Iterable[HostRule], patterns: Iterable[PatternRule]) -> DataFrame:
    """The rule table ``(token, regex, kind, rule, action, size, host_size)``.

    ``urls`` has ``tokens``; they are counted over all rows, and each rule goes under its
    rarest one. A rule without any literal token has a null token and meets every URL.
    """
    rows = []
    for r in rules:
        regex = rf"^([^/]*\.)?{_quoted(r.host)}\n{_quoted(r.path)}"
        rows.append((r.text, regex, "host", r.action, len(r.text), len(r.host), _literals(r)))
    for p in patterns:
        rows.append((p.name, p.pattern, "pattern", "block", 0, 0, list(p.literals)))
    kinds = "rule string, regex string, kind string, action string, size int, host_size int, literals array<string>"
    table = urls.sparkSession.createDataFrame(rows, kinds)
    literals = table.select("rule", "kind", F.explode_outer("literals").alias("token")).dropDuplicates()
    wanted = literals.select("token").where("token is not null").distinct()
    counts = (
        urls.select(F.explode("tokens").alias("token"))
        .join(F.broadcast(wanted), "token", "left_semi")  # at most the literals of the given rule list
        .groupBy("token").count()
    )
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("rule", "kind")
        .agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), F.length("token") * -1, "token")).alias("token"))
    )
    return table.drop("literals").join(rarest, ["rule", "kind"])


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def _literals(rule: HostRule) -> list[str]:
    """Whole tokens that any URL under the rule must hold.

    The last path token may go on in the URL unless a separator ends it.
    """
    path = re.findall(TOKEN, re.sub(rf"{TOKEN}$", "", rule.path.lower()))
    return sorted(set(re.findall(TOKEN, rule.host.lower()) + path))


def judge_urls(
    pages: DataFrame,
    rules: Iterable[HostRule] = (),
    patterns: Iterable[PatternRule] = SPAM_PATTERNS,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added.

    The longest fitting host rule decides (ties: the longer host, then the rule's text);
    without one a fitting pattern blocks, and anything else gets ``default``. Repeated
    rows are all judged; a null or malformed URL has an empty host and path and gets
    ``default``; columns of these names in ``pages`` are replaced, others may have any name.
    An empty table gives no rows, and without rules every URL gets ``default``. The work is
    done once per distinct URL.
    """
    rules, patterns = list(rules), list(patterns)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    pages = pages.select(F.struct("*").alias("page"))
    address = F.col("page").getField(url)
    host, path = url_parts(F.col("_url"))
    urls = (
        pages.select(address.alias("_url")).where(F.col("_url").isNotNull()).distinct()
        .withColumns({"host": host, "path": path})
        .withColumn("tokens", _tokens(F.concat_ws("/", "host", "path")))
    )
    table = compile_rules(urls, rules, patterns)
    n_rules = len(rules) + len(patterns)
    fetched = urls.select("_url", "host", "path", F.explode("tokens").alias("token"))
    # one row per given rule; beyond the size Spark broadcasts by itself it is a shuffle join
    hits = fetched.join(table.where("token is not null"), "token")
    free = [r for r in rules if not _literals(r)] + [p for p in patterns if not p.literals]
    if free and n_rules:
        bare = table.where("token is null").withColumn("_all", F.lit(1))
        every = urls.select("_url", "host", "path", F.lit(1).alias("_all")).join(F.broadcast(bare), "_all")
        hits = hits.unionByName(every.drop("_all"))
    subject = F.when(F.col("kind") == "host", F.concat_ws("\n", "host", "path")).otherwise(F.concat("host", "path"))
    hits = hits.where(F.rlike(subject, F.col("regex")))
    best = F.struct("size", "host_size", "rule", "action")
    decided = hits.groupBy("_url").agg(
        F.max(F.when(F.col("kind") == "host", best)).alias("best"),
        F.max(F.col("kind") == "pattern").alias("spam"),
    )
    host, path = url_parts(address)
    judged = pages.join(decided, address == F.col("_url"), "left")
    return judged.select(
        *[F.col("page").getField(c).alias(c) for c in kept],
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.when(F.col("spam"), "block"), F.lit(default)).alias("verdict"),
    )

