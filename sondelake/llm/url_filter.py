"""URL filters: rules by host and path, then host word segmentation and naive Bayes.

A host without spaces is split into words by a unigram Viterbi search; the words of host and path
are then scored by multinomial naive Bayes trained from a small labelled table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path): a rule fits its host and all subdomains.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Words that hosts are split into, the frequent ones first; a word's rank gives its probability.
WORDS = """
the of and to in for is on that by this with you it not or be are from at as your all have new more
an was we will home can us about if page my has search free but our one other do no information time
they site he up may what which their news out use any there see only so his when contact here business
who web also now help get view online first best shop store buy sale cheap deal deals price video
photo music game games play world book books blog forum wiki learn school science health care food
travel city garden paper press daily post mail cloud data open source code lab tech digital house
casino poker bet slots win adult sex porn xxx cam girls dating escort pills viagra pharma drug loan
loans credit payday replica watches ads ad track tracker click popup spam malware hack crack keygen
torrent warez download bonus money
""".split()

#: Labelled examples of hosts with paths that are unwanted (1) or ordinary (0).
EXAMPLES = (
    ("best-casino-bonus.example", "/slots/win", 1),
    ("onlinepoker.example", "/bet/now", 1),
    ("adultcams.example", "/girls/xxx", 1),
    ("adult-x.example", "/porn", 1),
    ("freepornvideo.example", "/sex", 1),
    ("sexdating.example", "/escort/girls", 1),
    ("cheap-pills.example", "/viagra/buy", 1),
    ("buycheapviagra.example", "/pharma/pills", 1),
    ("paydayloans.example", "/credit/loan", 1),
    ("replicawatches.example", "/cheap/sale", 1),
    ("ads-track.example", "/click/popup", 1),
    ("adtracker.example", "/ads/click", 1),
    ("spammail.example", "/malware", 1),
    ("crackkeygen.example", "/warez/torrent", 1),
    ("casinobonus.example", "/free/money", 1),
    ("freemoney.example", "/casino", 1),
    ("dailynews.example", "/world/page", 0),
    ("cityblog.example", "/travel/photo", 0),
    ("openscience.example", "/paper/data", 0),
    ("learnmusic.example", "/school/home", 0),
    ("gardenbooks.example", "/shop/book", 0),
    ("healthcare.example", "/information/contact", 0),
    ("techforum.example", "/code/help", 0),
    ("foodblog.example", "/home/post", 0),
    ("digitallab.example", "/search/page", 0),
    ("worldwiki.example", "/about/the", 0),
    ("opensourcecode.example", "/wiki/view", 0),
    ("bookstore.example", "/books/new", 0),
    ("schoolpress.example", "/news/video", 0),
    ("mailcloud.example", "/contact/help", 0),
    ("homegarden.example", "/blog/best", 0),
    ("gameworld.example", "/play/games", 0),
)

_LONGEST = 24


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for says, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Splits a run of letters into the likeliest words under a unigram model."""

    def __init__(self, vocabulary: Iterable[str] = WORDS):
        counts = {word: 1.0 / (rank + 10) for rank, word in enumerate(dict.fromkeys(vocabulary))}
        total = sum(counts.values())
        self.log = {word: math.log(count / total) for word, count in counts.items()}
        # An unknown word gets less with each letter, so that known words inside it win.
        self.unknown, self.per_letter = math.log(0.01 / total), math.log(0.05)

    def split(self, text: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            top, at = -math.inf, end - 1
            for start in range(max(0, end - _LONGEST), end):
                word = text[start:end]
                score = best[start] + self.log.get(word, self.unknown + self.per_letter * len(word))
                if score > top:
                    top, at = score, start
            best.append(top)
            back.append(at)
        found, end = [], len(text)
        while end:
            found.append(text[back[end] : end])
            end = back[end]
        return found[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of the host (its last label left out) and of the path."""
        labels = host.split(":")[0].rsplit(".", 1)[0]
        runs = re.findall("[a-z]+", labels) + re.findall("[a-z]+", path.lower())
        return [word for run in runs for word in self.split(run)]


class NaiveBayes:
    """Multinomial naive Bayes over words, with one added to each count."""

    def __init__(self, segmenter: Segmenter, examples: Iterable[tuple[str, str, int]] = EXAMPLES):
        counts = (Counter(), Counter())
        rows = [0, 0]
        for host, path, label in examples:
            counts[label].update(w for w in segmenter.tokens(host, path) if w in segmenter.log)
            rows[label] += 1
        known = counts[0].keys() | counts[1].keys()
        sizes = [sum(c.values()) + len(known) for c in counts]
        self.prior = math.log((rows[1] + 1) / (rows[0] + 1))
        self.odds = {w: math.log((counts[1][w] + 1) / sizes[1]) - math.log((counts[0][w] + 1) / sizes[0]) for w in known}

    def score(self, tokens: Iterable[str]) -> float:
        """Log-odds of being unwanted; words that no example holds say nothing."""
        return self.prior + sum(self.odds.get(word, 0.0) for word in tokens)


def judge(pages: DataFrame, rules: tuple = RULES, threshold: float = 0.5) -> DataFrame:
    """Host, path, rule and verdict of every page's URL.

    Needs ``page_id`` and ``url``; other columns are not looked at. Of the rules that fit, the
    longest decides; without one, the page is blocked if its score exceeds ``threshold``. A URL that
    is null or has no `://` has an empty host and path and is allowed. ``rules`` is a short
    list and becomes part of the query plan. Repeated rows and ids each give their own row, a null
    id stays null, an empty table gives an empty result. Nothing is shuffled.
    """

    def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        segmenter = Segmenter()
        model = NaiveBayes(segmenter)
        for hosts, paths in batches:
            yield pd.Series([model.score(segmenter.tokens(h, p)) for h, p in zip(hosts, paths)], dtype="float64")

    scored = F.pandas_udf(scores, "double")
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    return split.select("page_id", "host", "path", name.alias("rule"), says.alias("says"), scored("host", "path").alias("score")).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("says", F.when(F.col("score") > threshold, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
