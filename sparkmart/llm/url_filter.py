"""URL filters: host and path rules, and a weighted vocabulary of terms in the URL.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
case; the path goes on from there up to ``?``, ``#`` or the end. A rule holds a host and the
beginning of a path; it fits its host and all subdomains where the path starts like its own. The
longest rule that fits decides (of equally long ones that with the longer host, of equal ones
block). Where none fits, the vocabulary does.

Method of the vocabulary: an Aho-Corasick automaton finds all terms in host and path, in lower
case (A-Z); a term counts where neither of its neighbours is a letter or digit (any non-ASCII
character being one; percent escapes part words). Every term has a weight and counts once, however
often it is found: a strict term weighs the whole limit, a soft one half of it, so one strict term
or two different soft ones reject a URL.

Small rule sets, up to ``RULE_ROWS`` rules and ``RULE_BYTES``, travel to the tasks by broadcast;
larger ones are joined, on a host suffix first and then on the beginning of the path, with the
distinct host and path pairs.

Edge cases: a null URL or one without ``://`` has an empty host and path, fits no rule and holds no
term, so it is allowed. Repeated rows are judged alike. Rules without a host fit nothing. Columns
called like the result's give way; all others are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.joins import lookup_join

RULE_ROWS = 100_000
RULE_BYTES = 16 << 20
LIMIT = 2

STRICT = (
    "bestiality", "blowjob", "camgirl", "camgirls", "casino", "casinos", "cumshot", "escorts",
    "gangbang", "hentai", "incest", "keylogger", "milf", "phishing", "porn", "porno",
    "pornography", "ransomware", "sexcam", "slots", "sportsbook", "viagra", "cialis", "warez",
    "xvideos", "xxx",
)
SOFT = (
    "ad", "ads", "adult", "affiliate", "banner", "bet", "bets", "betting", "bonus", "cam", "cams",
    "cheap", "clickbait", "coupon", "crack", "cracked", "dating", "deal", "deals", "erotic",
    "escort", "farm", "free", "fuck", "gamble", "gambling", "hack", "hot", "jackpot", "keygen",
    "loan", "loans", "lottery", "malware", "naked", "nude", "payday", "pharmacy", "pill", "pills",
    "pirate", "poker", "replica", "sale", "sex", "sexy", "spam", "spyware", "torrent", "track",
    "tracker", "tracking", "win", "winner", "x",
)
#: Terms and their weights; ``LIMIT`` rejects.
VOCABULARY: dict[str, int] = dict.fromkeys(SOFT, 1) | dict.fromkeys(STRICT, LIMIT)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"://([^/?#]*)([^?#]*)"
_FOUND = "n_strict int, n_soft int, rejected boolean, rule string, action string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, empty where it has none."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER)
    return host, F.regexp_extract(url, _PARTS, 2)


def spaced(host: Column, path: Column) -> Column:
    """What terms are looked for in."""
    lower = F.translate(F.concat(host, path), _UPPER, _LOWER)
    return F.regexp_replace(lower, "%[0-9a-f]{2}", " ")


def _part_of_word(letter: str) -> bool:
    return letter >= "\x80" or letter.isalnum()


class Terms:
    """The vocabulary in an automaton."""

    def __init__(self, vocabulary: Mapping[str, int], limit: int) -> None:
        self.limit, self.automaton = limit, ahocorasick.Automaton()
        for term, weight in vocabulary.items():
            if term:
                self.automaton.add_word(term, (term, weight))
        if len(self.automaton):
            self.automaton.make_automaton()

    def found(self, text: str) -> set[tuple[str, int]]:
        """The different terms in the text, each as a word of its own, and their weights."""
        if not len(self.automaton):
            return set()
        out = set()
        for last, (term, weight) in self.automaton.iter(text):
            first = last + 1 - len(term)
            if first and _part_of_word(text[first - 1]):
                continue
            if last + 1 < len(text) and _part_of_word(text[last + 1]):
                continue
            out.add((term, weight))
        return out

    def judge(self, text: str) -> tuple[int, int, bool]:
        """How many strict and soft terms there are, and whether they reject."""
        found = self.found(text)
        strict = sum(w >= self.limit for _, w in found)
        return strict, len(found) - strict, sum(w for _, w in found) >= self.limit


class Rules:
    """A small set of rules, by host and path."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]) -> None:
        self.paths: dict[str, dict[str, str]] = {}
        for host, path, action in sorted(rules):  # of equal rules block comes last
            self.paths.setdefault(host, {})[path] = action
        self.hosts = sorted({len(h) for h in self.paths}, reverse=True)
        self.sizes = {
            h: sorted({len(p) for p in paths}, reverse=True) for h, paths in self.paths.items()
        }

    def fit(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, and what it says."""
        best, n = (None, None), -1
        for size in self.hosts:  # longer hosts first, so they win a tie
            if size > len(host) or size < len(host) and host[-size - 1] != ".":
                continue
            own = host[len(host) - size :]
            for length in self.sizes.get(own, ()):
                start = path[:length]
                if length <= len(path) and start in self.paths[own]:
                    if size + length > n:
                        best, n = (own + start, self.paths[own][start]), size + length
                    break
        return best


def _judging(vocabulary: Mapping[str, int], limit: int, rules) -> Callable:
    @F.pandas_udf(_FOUND)
    def judged(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        terms, known = Terms(vocabulary, limit), Rules(rules.value)
        for hosts, paths, texts in parts:
            found = [
                (*terms.judge(text), *known.fit(host, path))
                for host, path, text in zip(hosts, paths, texts, strict=True)
            ]
            yield pd.DataFrame(found, columns=["n_strict", "n_soft", "rejected", "rule", "action"])

    return judged


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules such as ``("block", "example.com/de/")`` as a table of host, path and action."""
    rows = [(a, *r.partition("/")) for a, r in rules]
    return spark.createDataFrame(
        [(host, slash + rest, a) for a, host, slash, rest in rows],
        "host string, path string, action string",
    )


def _fitting(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule for each distinct host and path, by joins alone.

    The lengths of the rules' hosts, a few numbers, tell which suffixes of a host to look up;
    those of the paths, per host, which beginnings of a path.
    """
    sizes = [r[0] for r in rules.select(F.length("host")).distinct().collect()]
    size, dot = F.col("_size"), F.expr("substr(host, -_size - 1, 1)")
    fits = (size == F.length("host")) | ((size < F.length("host")) & (dot == "."))
    suffixes = (
        pairs.select("host", "path", F.explode(F.array(*map(F.lit, sizes))).alias("_size"))
        .where(fits)
        .select("host", "path", F.expr("right(host, _size)").alias("_rule_host"))
    )
    by_host = rules.groupBy(F.col("host").alias("_rule_host")).agg(
        F.collect_set(F.length("path")).alias("_lengths")
    )
    starts = (
        lookup_join(suffixes, by_host, ["_rule_host"], "inner")
        .select("host", "path", "_rule_host", F.explode("_lengths").alias("_length"))
        .where(F.col("_length") <= F.length("path"))
        .withColumn("_rule_path", F.expr("left(path, _length)"))
    )
    known = rules.groupBy(
        F.col("host").alias("_rule_host"), F.col("path").alias("_rule_path")
    ).agg(F.max("action").alias("action"))
    fitting = lookup_join(starts, known, ["_rule_host", "_rule_path"], "inner")
    rule = F.struct(F.concat("_rule_host", "_rule_path").alias("rule"), "action")
    length = F.length("_rule_host")
    rank = F.struct((length + F.col("_length")).alias("n"), length.alias("h"))
    return fitting.groupBy("host", "path").agg(F.max_by(rule, rank).alias("_rule"))


def judge(
    urls: DataFrame,
    rules: DataFrame,
    vocabulary: Mapping[str, int] = VOCABULARY,
    limit: int = LIMIT,
    *,
    column: str = "url",
    broadcast_rows: int = RULE_ROWS,
) -> DataFrame:
    """Every row of ``urls`` with host, path, rule (or null), verdict, n_strict and n_soft.

    ``rules`` has host, path and action (allow or block). The verdict is the rule's, else block
    where the terms found weigh ``limit`` or more, else allow.
    """
    spark = urls.sparkSession
    results = ("host", "path", "rule", "verdict", "n_strict", "n_soft")
    kept = [f"`{c}`" for c in urls.columns if c not in results]
    host, path = host_and_path(F.col(f"`{column}`"))
    parted = urls.select(
        *kept, host.alias("host"), path.alias("path")
    )
    rules = rules.where("host <> ''").select(
        F.translate("host", _UPPER, _LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "action",
    )
    n, size = rules.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path")), F.lit(0))
    ).first()
    small = n <= broadcast_rows and size <= RULE_BYTES
    held = [tuple(r) for r in rules.collect()] if small else []
    sent = spark.sparkContext.broadcast(held)
    found = _judging(dict(vocabulary), limit, sent)(
        F.col("host"), F.col("path"), spaced(F.col("host"), F.col("path"))
    )
    done = parted.withColumn("_found", found)
    rule = F.col("_found.rule"), F.col("_found.action")
    if not small:
        pairs = parted.select("host", "path").where("host <> ''").distinct()
        done = lookup_join(done, _fitting(pairs, rules), ["host", "path"], "left")
        rule = F.col("_rule.rule"), F.col("_rule.action")
    method = F.when(F.col("_found.rejected"), "block").otherwise("allow")
    return done.select(
        *kept,
        "host",
        "path",
        rule[0].alias("rule"),
        F.coalesce(rule[1], method).alias("verdict"),
        F.col("_found.n_strict").alias("n_strict"),
        F.col("_found.n_soft").alias("n_soft"),
    )
