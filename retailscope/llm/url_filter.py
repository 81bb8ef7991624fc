"""URL rules found by their rarest literal token.

A rule is a regular expression with literal tokens that every URL it matches must contain. Each rule is
filed under the one that is rarest among the URLs at hand; a URL's tokens fetch the rules filed under
them, and only those run their expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.llm.common import only_named

TOKEN = "[a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)
MAX_RULE_BYTES = 64 << 20  # the rule set travels with every task


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path; ``tokens`` occur in whatever it matches, A-Z lower-cased.

    ``name`` is set for host rules, which decide before patterns; the longest name wins. Host rules are
    searched in the path as it is, the others where A-Z are lower-cased.
    """

    pattern: str
    action: str
    tokens: tuple[str, ...]
    name: str | None = None


def host_rule(host: str, path: str, action: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``.

    A path's last piece is no whole token unless something ends it.
    """
    ended = re.match(r"(.*[^A-Za-z0-9])?", path)[0]
    tokens = re.findall(TOKEN, f"{host}/{ended}".lower())
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}(?=/){re.escape(path)}"
    return Rule(pattern, action, tuple(tokens), host + path)


def word_rule(words: str, action: str) -> Rule:
    """Fits wherever ``words``, in whatever case, stands between characters that are neither letters nor digits."""
    words = words.translate(ASCII_LOWER)
    return Rule(rf"(?<![a-z0-9]){re.escape(words)}(?![a-z0-9])", action, tuple(re.findall(TOKEN, words)))


def pattern_rule(parts: Sequence[str], action: str) -> Rule:
    """Fits where these literal parts follow each other, with anything between them.

    A part's first and last piece are no whole tokens unless something inside the part ends them.
    """
    parts = [p.translate(ASCII_LOWER) for p in parts if p]
    tokens = [t for p in parts for t in re.findall(r"(?<=[^a-z0-9])[a-z0-9]+(?=[^a-z0-9])", p)]
    return Rule(".*".join(map(re.escape, parts)), action, tuple(tokens))


def parse_rule(line: str) -> Rule | None:
    """A rule from a line of a filter list, None for empty lines and comments (``!`` or ``#``).

    ``||host/path`` is a host rule, ``*`` stands for anything inside a pattern, other lines are words;
    ``@@`` in front allows instead of blocking.
    """
    line = line.strip()
    if not line or line[0] in "!#":
        return None
    action = "allow" if line.startswith("@@") else "block"
    line = line.removeprefix("@@")
    if line.startswith("||"):
        host, _, path = line[2:].rstrip("^").partition("/")
        return host_rule(host.translate(ASCII_LOWER), "/" + path, action)
    if "*" in line:
        return pattern_rule(line.split("*"), action)
    return word_rule(line, action)


def read_rules(spark: SparkSession, path: str, most_bytes: int | None = None) -> list[Rule]:
    """The rules of a filter list, in the order of its lines, from any storage that Spark reads.

    A list beyond ``most_bytes`` (``MAX_RULE_BYTES``) is refused before it is brought to the driver.
    """
    lines = spark.read.text(path)
    size = lines.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    if size > (most_bytes or MAX_RULE_BYTES):
        raise ValueError(f"{path} holds {size} bytes of rules; judge by parts of it")
    return [rule for row in lines.collect() if (rule := parse_rule(row["value"])) is not None]


# The host rules that the registered query judges by.
HOST_RULES = (
    host_rule("com", "/", "allow"),
    host_rule("example.com", "/en/", "block"),
    host_rule("www.example.com", "/en/", "allow"),
    host_rule("net", "/es/", "block"),
    host_rule("net", "/fr/", "block"),
)

# What the method adds where no host rule fits: words of spam hosts.
BLOCKED_WORDS = ("spam-farm", "cheap-pills", "casino", "xxx", "free-download")
RULES = HOST_RULES + tuple(word_rule(words, "block") for words in BLOCKED_WORDS)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty where the URL is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def token_counts(places: DataFrame, tokens: Iterable[str]) -> Mapping[str, int]:
    """In how many rows of ``places`` (host, path) each of the rules' tokens stands; one row per token.

    Other tokens go before anything is counted or shuffled.
    """
    wanted = sorted(set(tokens))

    def known(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        asked = frozenset(wanted)
        both = zip(hosts.to_pylist(), paths.to_pylist())
        return pa.array([list(asked.intersection(re.findall(TOKEN, (h + p).translate(ASCII_LOWER)))) for h, p in both], pa.list_(pa.string()))

    found = places.select(F.explode(F.arrow_udf(known, "array<string>")("host", "path")).alias("token"))
    return {row["token"]: row["n"] for row in found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def token_index(rules: Sequence[Rule], counts: Mapping[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by rarest token (ties: the first by code point), and those without any token."""
    by_token: dict[str, list[int]] = {}
    always = []
    for number, rule in enumerate(rules):
        if rule.tokens:
            by_token.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(number)
        else:
            always.append(number)
    return by_token, always


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per input row.

    ``rule`` names the longest host rule that fits, else it is null. ``verdict`` is that rule's action;
    without one, ``block`` if another blocking rule fits and no allowing one does, else ``allow``. Of host
    rules of one length the last by code point counts. A null URL, or one without ``://``, has empty host
    and path, fits nothing and is allowed. Whole URLs are judged, however long; repeated rows are judged
    alike; an empty table gives no rows.
    """
    if sum(len(r.pattern) + sum(map(len, r.tokens)) for r in rules) > MAX_RULE_BYTES:
        raise ValueError(f"rules exceed {MAX_RULE_BYTES} bytes; judge by parts of them")
    narrow = only_named(pages, page_id=id_column, url=url_column)
    host, path = url_parts(F.col("url").cast("string"))
    places = narrow.select("page_id", host.alias("host"), path.alias("path"))
    by_token, always = token_index(rules, token_counts(places, [t for r in rules for t in r.tokens]))
    rules = list(rules)

    def judge(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        compiled: dict[int, re.Pattern] = {}
        names, verdicts = [], []
        for host, path in zip(hosts.to_pylist(), paths.to_pylist()):
            place = host + path
            low = place.translate(ASCII_LOWER)
            fetched = dict.fromkeys(always)
            for token in re.findall(TOKEN, low):
                fetched.update(dict.fromkeys(by_token.get(token, ())))
            best, actions = None, set()
            for number in fetched:
                rule = rules[number]
                if number not in compiled:
                    compiled[number] = re.compile(rule.pattern)
                if not compiled[number].search(low if rule.name is None else place):
                    continue
                if rule.name is None:
                    actions.add(rule.action)
                elif best is None or (len(rule.name), rule.name) > (len(best.name), best.name):
                    best = rule
            names.append(best and best.name)
            verdicts.append(best.action if best else "block" if actions == {"block"} else "allow")
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(verdicts, pa.string())], ["rule", "verdict"])

    judged = F.arrow_udf(judge, "rule string, verdict string")
    return places.withColumn("judged", judged("host", "path")).select("page_id", "host", "path", "judged.rule", "judged.verdict")
