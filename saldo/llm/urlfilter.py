"""Weighted URL vocabulary: rules by host and path first, else terms found by one Aho-Corasick pass.

A term counts where no letter stands beside it, so that "essex" does not hold "sex". One strict term
blocks a url. Soft terms block it when the weights of the distinct ones reach a limit; spellings
of one term count once, and so do repeats.

Rules and vocabulary are lists of the caller that every task gets whole; LIMIT bounds their entries.
Rows are neither moved nor dropped.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial
from urllib.parse import unquote

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import map_columns

ALLOW, BLOCK = "allow", "block"
#: Most rules, and most spellings of terms.
LIMIT = 1_000_000
#: After the first "://": up to a slash, question mark or hash; then up to a question mark or hash.
HOST, PATH = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The default vocabulary. One of these blocks a url.
STRICT = [
    "casino", "casinos", "porn", "porno", "pornhub", "xxx", "hentai", "milf", "camgirls", "escorts",
    "viagra", "cialis", "levitra", "tramadol", "spam", "warez", "phishing", "malware", "payday-loans",
    "gambling", "sportsbook", "blackjack", "x-rated",
]
# Soft terms with their spellings; each has weight 1.
SOFT = {
    "adult": ["adult", "adults"], "ads": ["ads", "adserver", "adclick"], "bet": ["bet", "bets", "betting"],
    "bonus": ["bonus", "bonuses"], "cheap": ["cheap", "cheapest"], "crack": ["crack", "cracked", "keygen"],
    "dating": ["dating", "singles"], "erotic": ["erotic", "erotica"], "free": ["free"], "hot": ["hot", "hottest"],
    "jackpot": ["jackpot", "jackpots"], "loan": ["loan", "loans"], "lottery": ["lottery", "lotto"],
    "nude": ["nude", "nudes", "naked"], "pharmacy": ["pharmacy", "rx"], "pill": ["pill", "pills"],
    "poker": ["poker"], "pop-up": ["popup", "popunder", "pop-up"], "sex": ["sex", "sexy"], "slot": ["slot", "slots"],
    "torrent": ["torrent", "torrents"], "track": ["track", "tracker", "tracking"], "win": ["win", "winner", "wins"],
    "x": ["x"],
}


@dataclass(frozen=True)
class Vocabulary:
    """strict: terms that block by themselves; soft: spellings by term; weights: 1 where not given."""

    strict: Iterable[str] = tuple(STRICT)
    soft: dict[str, list[str]] = field(default_factory=lambda: SOFT)
    weights: dict[str, float] = field(default_factory=dict)
    limit: float = 2.0

    def spellings(self) -> dict[str, tuple[bool, str]]:
        """Lower-case spelling: whether it is strict, and its term. A strict spelling is never soft."""
        found = {s.lower(): (False, term) for term, spelled in self.soft.items() for s in spelled}
        found |= {s.lower(): (True, s) for s in self.strict}
        found.pop("", None)
        if len(found) > LIMIT:
            raise ValueError(f"{len(found)} spellings, at most {LIMIT}")
        return found


class Terms:
    """The automaton of a vocabulary; made once per batch of urls, in the task that needs it."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for spelling, (strict, term) in vocabulary.spellings().items():
            self.automaton.add_word(spelling, (len(spelling), strict, term))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[list[str], list[str]]:
        """Strict terms as often as they occur, and distinct soft terms, both sorted."""
        text = text.lower()
        strict, soft = [], set()
        if self.empty:
            return strict, []
        for last, (length, is_strict, term) in self.automaton.iter(text):
            before, after = last - length, last + 1
            if (before >= 0 and text[before].isalpha()) or (after < len(text) and text[after].isalpha()):
                continue
            if is_strict:
                strict.append(term)
            else:
                soft.add(term)
        return sorted(strict), sorted(soft)

    def weight(self, soft: list[str]) -> float:
        return float(sum(self.vocabulary.weights.get(term, 1.0) for term in soft))

    def blocks(self, strict: list[str], soft: list[str]) -> bool:
        return bool(strict) or self.weight(soft) >= self.vocabulary.limit


class Rules:
    """Verdicts by host and path: (verdict, "host/path") each.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule wins,
    of equally long ones the one with the longer host.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.paths: dict[str, dict[str, str]] = {}
        for verdict, text in rules:
            host, slash, path = text.partition("/")
            if verdict not in (ALLOW, BLOCK) or not host or not slash:
                raise ValueError(f"rule {verdict} {text}: allow or block, a host and a path are needed")
            if self.paths.setdefault(host.lower(), {}).setdefault(slash + path, verdict) != verdict:
                raise ValueError(f"rule {text} both allows and blocks")
        if sum(map(len, self.paths.values())) > LIMIT:
            raise ValueError(f"more than {LIMIT} rules")
        self.lengths = {host: sorted({len(p) for p in paths}, reverse=True) for host, paths in self.paths.items()}
        self.longest_host = max(map(len, self.paths), default=0)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that wins, as text, and its verdict."""
        best, cut = None, len(host)
        while cut > 0:  # from the last label on, as long as a rule's host can be
            cut = host.rfind(".", 0, cut)
            suffix = host[cut + 1 :]
            if len(suffix) > self.longest_host:
                break
            for length in self.lengths.get(suffix, ()):
                verdict = self.paths[suffix].get(path[:length]) if length <= len(path) else None
                if verdict:
                    if best is None or len(suffix) + length >= len(best[0]):
                        best = suffix + path[:length], verdict
                    break
        return best


def with_host_and_path(frame: DataFrame, url: str = "url") -> DataFrame:
    """host (A-Z lower-cased) and path of a url; both empty without "://" and for null.

    The two take the place of columns that have their names.
    """
    text = F.col(f"`{url}`")
    found = frame.withColumn("path", F.coalesce(F.regexp_extract(text, PATH, 1), F.lit("")))
    if url.lower() == "path":
        raise ValueError("the url column cannot be called path")
    host = F.coalesce(F.regexp_extract(text, HOST, 1), F.lit(""))
    return found.withColumn("host", F.translate(host, UPPER, LOWER))


def judge_urls(
    frame: DataFrame, rules: Iterable[tuple[str, str]] = (), vocabulary: Vocabulary | None = None, url: str = "url"
) -> DataFrame:
    """Add host, path, rule, verdict, strict_terms, soft_terms and soft_weight to every row.

    rule is the rule that decided, else null. verdict is the rule's, else block if the terms in host
    and path (escapes like %61 read) say so, else allow. What follows a question mark or hash is not
    looked at. A null or empty url, or one without "://", has no host, path or term: allow. Long urls are
    read whole. Rows keep all their columns, repeated rows are judged alike, and new columns take the place
    of those that have their names. An empty table stays empty.
    """
    rules, vocabulary = list(rules), vocabulary or Vocabulary()
    Rules(rules), vocabulary.spellings()  # faults in them show before any task starts
    fields = (
        "rule string, verdict string, strict_terms array<string>, soft_terms array<string>, soft_weight double"
    )
    return map_columns(with_host_and_path(frame, url), ["host", "path"], partial(_judged, rules, vocabulary), fields)


def _judged(rules: list, vocabulary: Vocabulary, hosts: pa.Array, paths: pa.Array) -> dict[str, pa.Array]:
    table, terms = Rules(rules), Terms(vocabulary)
    texts, verdicts, stricts, softs, weights = [], [], [], [], []
    for host, path in zip(hosts.to_pylist(), paths.to_pylist()):
        strict, soft = terms.hits(unquote(host + path))
        text, verdict = table.find(host, path) or (None, BLOCK if terms.blocks(strict, soft) else ALLOW)
        texts.append(text)
        verdicts.append(verdict)
        stricts.append(strict)
        softs.append(soft)
        weights.append(terms.weight(soft))
    words = pa.list_(pa.string())
    return {
        "rule": pa.array(texts, pa.string()), "verdict": pa.array(verdicts, pa.string()),
        "strict_terms": pa.array(stricts, words), "soft_terms": pa.array(softs, words),
        "soft_weight": pa.array(weights, pa.float64()),
    }
