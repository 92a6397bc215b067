"""URL filters: host and path rules, then a weighted vocabulary.

A URL that no rule decides is scanned once by an Aho-Corasick automaton for
strict and soft terms. A term counts where no letter or digit stands beside it.
One strict term, or several distinct soft terms whose weights together reach a
limit, block the URL; everything else is allowed.

Defined results: a null URL, or one without ``://``, has an empty host and an
empty path, fits no rule and is scanned as it is; percent escapes are undone for
the scan; repeated rows get one result each; an empty table gives an empty
result. Columns of the input other than the named ones play no role.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Vocabulary:
    """Terms of letters and digits in lower case. One strict term blocks, or two distinct soft ones whose weights reach ``limit``."""

    # Terms for adult content, gambling, fraud and advertising; soft ones weigh 1 where clean URLs use them too.
    strict: tuple[str, ...] = (
        *("adult", "camgirls", "casino", "crackz", "hentai", "nudes", "porn", "porno", "pornstar", "sexcams", "spam", "warez", "xxx"),
    )
    soft: tuple[tuple[str, int], ...] = (
        *(("ads", 2), ("banner", 1), ("bet", 2), ("bets", 2), ("bonus", 1), ("cheap", 1), ("click", 1), ("crack", 1), ("dating", 2), ("escort", 2)),
        *(("farm", 1), ("free", 1), ("gambling", 2), ("hot", 1), ("jackpot", 2), ("keygen", 2), ("loan", 1), ("loans", 2), ("lottery", 2)),
        *(("naked", 2), ("nude", 2), ("pills", 2), ("poker", 2), ("popup", 2), ("prize", 1), ("replica", 2), ("serial", 1), ("sex", 2), ("sexy", 2)),
        *(("slots", 2), ("torrent", 2), ("track", 1), ("tracker", 2), ("tracking", 1), ("viagra", 2), ("win", 1), ("winner", 1)),
    )
    least_soft: int = 2
    limit: int = 3


def vocabulary_of(terms: DataFrame, limit: int = 3, most_terms: int = 100_000) -> Vocabulary:
    """The vocabulary of a table (term, weight), where a null weight makes a term strict; more than ``most_terms`` are an error."""
    rows = terms.select(F.lower(F.trim("term")).alias("term"), F.col("weight").cast("int").alias("weight")).filter("term <> ''").distinct().limit(most_terms + 1).collect()
    if len(rows) > most_terms:
        raise ValueError(f"more than {most_terms} terms")
    strict = {r["term"] for r in rows if r["weight"] is None}
    soft: dict[str, int] = {}
    for r in rows:
        if r["term"] not in strict:
            soft[r["term"]] = max(r["weight"], soft.get(r["term"], 0))
    return Vocabulary(tuple(sorted(strict)), tuple(sorted(soft.items())), limit=limit)


@dataclass(frozen=True)
class Rules:
    """(host/path, verdict) pairs: a rule fits its host and all subdomains where the path starts with the rule's."""

    # The rules of the query's contract.
    entries: tuple[tuple[str, str], ...] = (
        ("org/", ALLOW),
        ("example.org/es/", BLOCK),
        ("example.org/en/1", BLOCK),
        ("com/fr/", ALLOW),
        ("com/de/", BLOCK),
    )


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, up to ``/``, ``?``, ``#`` or the end; then the path, up to ``?``, ``#`` or the end."""
    rest = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting_rule(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for entry, decision in sorted(rules.entries, key=lambda e: len(e[0])):
        domain, slash, start = entry.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, F.lit(entry)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


class TermScanner:
    """Distinct strict and soft terms of a URL, and the soft ones' weight."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        weights = dict(vocabulary.soft) | dict.fromkeys(vocabulary.strict)
        for term, weight in weights.items():
            self.automaton.add_word(term, (term, weight))
        if weights:
            self.automaton.make_automaton()
        self.any = bool(weights)

    def __call__(self, url: str | None) -> tuple[int, int, int]:
        low = unquote(url or "").lower()
        found = {}
        for end, (term, weight) in self.automaton.iter(low) if self.any else ():
            start = end - len(term) + 1
            if (start == 0 or not low[start - 1].isalnum()) and (end + 1 == len(low) or not low[end + 1].isalnum()):
                found[term] = weight
        soft = [w for w in found.values() if w is not None]
        return len(found) - len(soft), len(soft), sum(soft)


def filtered(pages: DataFrame, vocabulary: Vocabulary = Vocabulary(), rules: Rules = Rules(), url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """``pages`` as ``row`` with host, path, rule, n_strict and n_soft (distinct terms), soft_weight and verdict."""
    rows = packed(pages, keep, url=url)
    row_type = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = TermScanner(vocabulary)
        for batch in batches:
            found = [scan(u) for u in batch.column("url").to_pylist()]
            counts = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("url"), *counts], ["row", "url", "n_strict", "n_soft", "soft_weight"])

    scanned = rows.mapInArrow(run, f"row {row_type}, url string, n_strict long, n_soft long, soft_weight long")
    host, path = host_and_path(F.col("url"))
    scanned = scanned.withColumn("host", host).withColumn("path", path)
    rule, decided = fitting_rule(F.col("host"), F.col("path"), rules)
    blocked = (F.col("n_strict") > 0) | ((F.col("n_soft") >= vocabulary.least_soft) & (F.col("soft_weight") >= vocabulary.limit))
    verdict = F.coalesce(decided, F.when(blocked, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return scanned.select("row", "host", "path", rule.alias("rule"), "n_strict", "n_soft", "soft_weight", verdict.alias("verdict"))
