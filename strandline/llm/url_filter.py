"""URL filters: rules by host and path, and for the rest a classifier of words in the url.

A host's labels are split into words by Viterbi under a unigram word model, so that
concatenated names fall apart into words; a multinomial naive Bayes classifier scores
these words and the path's tokens. Word counts come from the texts of all pages. Hosts are
segmented where they lie: the substrings of each distinct host meet the counted words in a
join, so no vocabulary is sent to the driver or to every task. Only the classifier
learns from a sample, of ``fit_rows`` rows. Its labels come from a caller's column, or are
weak ones: a host is marked if one of its words is among listed seed terms. These miss hosts
of the same kind, so those that a first classifier blocks are marked too for the second. What goes
with marked hosts, in their names and paths, is learnt, so hosts without a seed are blocked too.

Cases: a null url and one without "://" have an empty host and path, match no rule and
are judged by the prior alone; other columns are ignored, whatever their names; repeated
rows are all kept; with no training row of both classes every verdict of the method is "allow";
names of any length are segmented.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import discard, materialize

#: Terms that mark a host as unwanted when they stand among its words.
SEEDS = frozenset("adult ads bet bets betting casino dating escort gambling malware phishing pills poker porn sex slots spam track tracker viagra warez xxx".split())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Rules:
    """Rules like ``example.com/en/``: a host with its subdomains, and the start of the path. The longest that fits wins."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for action, rule in rules:
            host, slash, rest = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + rest, rule, action))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best: tuple[str, str] | None = None
        suffix = host
        while suffix:
            for start, rule, action in self.by_host.get(suffix, ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, action
            suffix = suffix.partition(".")[2]
        return best


class WordModel:
    """Unigram word probabilities; a word of n letters that wasn't counted has 10 / (total * 10 ** n)."""

    def __init__(self, counts: Mapping[str, int], total: int | None = None):
        self.total = (sum(counts.values()) if total is None else total) + 1
        self.logs = {w: math.log(c / self.total) for w, c in counts.items() if c > 0}
        self.sizes = sorted({len(w) for w in self.logs})

    def log_probability(self, word: str) -> float:
        known = self.logs.get(word)
        return math.log(10 / self.total) - len(word) * math.log(10) if known is None else known

    def segment(self, name: str) -> list[str]:
        """The most probable split of a name into words. A counted word is never less probable than its letters as an unknown one."""
        n, base, letter = len(name), math.log(10 / self.total), math.log(10)
        best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        lead, lead_at = -math.inf, 0  # the best start of an unknown word that ends at ``end`` or later
        for end in range(1, n + 1):
            if best[end - 1] + (end - 1) * letter > lead:
                lead, lead_at = best[end - 1] + (end - 1) * letter, end - 1
            best[end], back[end] = lead + base - end * letter, lead_at
            for size in self.sizes:
                if size > end:
                    break
                known = self.logs.get(name[end - size : end])
                if known is not None and best[end - size] + known > best[end]:
                    best[end], back[end] = best[end - size] + known, end - size
        words, end = [], n
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return words[::-1]


LETTERS, PARTS = re.compile(r"[^\W\d_]+"), re.compile(r"[^\W\d_]+|\d+")


def host_words(model: WordModel, host: str) -> list[str]:
    return [w for part in LETTERS.findall(host) for w in model.segment(part)]


def features(words: Iterable[str], path: str) -> list[str]:
    """Words of the host and tokens of the path, in name spaces of their own; a run of digits is one token for all."""
    return ["h:" + w for w in words] + ["p:" + ("#" if t[0].isdigit() else t.lower()) for t in PARTS.findall(path)]


def tokens(model: WordModel, host: str, path: str) -> list[str]:
    return features(host_words(model, host), path)


@dataclass
class Words:
    """Counts of all words of the corpus, as a table."""

    table: DataFrame  #: word, count
    total: int
    sizes: list[int]  #: lengths that counted words have
    seeds: dict[str, int]  #: counts of words that are known whether or not a text has them

    @classmethod
    def counted(cls, table: DataFrame, seeds: Iterable[str]) -> Words:
        seeds = sorted(seeds)
        row = table.agg(F.sum("count").alias("n"), F.collect_set(F.length("word")).alias("sizes")).first()
        found = {r["word"]: r["count"] for r in table.where(F.col("word").isin(seeds)).collect()}
        fixed = {w: max(found.get(w, 0), 1 + (row["n"] or 0) // 10_000) for w in seeds}
        return cls(table, (row["n"] or 0) + sum(fixed.values()) - sum(found.values()), sorted(row["sizes"]), fixed)

    def segmented(self, hosts: DataFrame) -> DataFrame:
        """host, words (joined by spaces) of each distinct host. Writes it below the shared folder."""
        sizes, total, seeds = self.sizes, self.total, self.seeds

        def pieces(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, 200):
                    whose, found = [], []
                    for host in batch.column("host").slice(i, 200).to_pylist():
                        some = {p[a : a + n] for p in LETTERS.findall(host) for n in sizes for a in range(len(p) - n + 1)}
                        some.add("")  # a host without any counted word has a row too
                        whose += [host] * len(some)
                        found += sorted(some)
                    yield pa.RecordBatch.from_arrays([pa.array(whose, pa.string()), pa.array(found, pa.string())], ["host", "word"])

        def split(batches):
            for batch in batches:
                out = []
                for host, words, counts in zip(*(batch.column(c).to_pylist() for c in ("host", "words", "counts")), strict=True):
                    known = {w: n for w, n in zip(words, counts, strict=True) if w} | {w: n for w, n in seeds.items() if w in host}
                    out.append(" ".join(host_words(WordModel(known, total), host)))
                yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.string())], ["host", "words"])

        usable = hosts.select("host").distinct().mapInArrow(pieces, "host string, word string")
        counts = self.table.unionByName(self.table.sparkSession.createDataFrame([("", 0)], "word string, count long"))
        met = usable.join(counts, "word").groupBy("host").agg(F.collect_list("word").alias("words"), F.collect_list("count").alias("counts"))
        return materialize(met.mapInArrow(split, "host string, words string"), "hosts")


class NaiveBayes:
    """Multinomial, two classes, add-one smoothing. ``score`` is the probability of class 1."""

    def __init__(self, rows: Iterable[tuple[list[str], int]]):
        counts, docs = (Counter(), Counter()), [0, 0]
        for words, label in rows:
            counts[label].update(words)
            docs[label] += 1
        vocabulary = set(counts[0]) | set(counts[1])
        totals = [sum(c.values()) + len(vocabulary) for c in counts]
        self.prior = math.log((docs[1] + 1) / (docs[0] + 1)) if docs[1] else -math.inf
        self.odds = {w: math.log((counts[1][w] + 1) / totals[1]) - math.log((counts[0][w] + 1) / totals[0]) for w in vocabulary} if docs[1] else {}

    def score(self, words: Iterable[str]) -> float:
        z = self.prior + sum(self.odds.get(w, 0.0) for w in words)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z)))) if z > -math.inf else 0.0


def sampled(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of the whole row; all if there are no more. Of equal rows one is drawn, so that no repeated row can fill the sample."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int((1 << 30) * rows / n)).distinct()


def word_counts(df: DataFrame, html_col: str) -> DataFrame:
    """word, count of all words of page texts."""
    plain = F.lower(F.regexp_replace(F.col(html_col), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&\w+;", " "))
    return df.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word")).where("word <> ''").groupBy("word").count()


def seed_labels(words: Iterable[str], seeds: frozenset[str] = SEEDS) -> list[int]:
    """1 for hosts, as words joined by spaces, that have a seed."""
    return [int(not seeds.isdisjoint(w.split())) for w in words]


@dataclass
class Filter:
    words: Words
    bayes: NaiveBayes


def fit(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", fit_rows: int = 20_000, seeds: frozenset[str] = SEEDS, id_col: str = "page_id", label_col: str | None = None
) -> Filter:
    """Word counts from all pages, and a classifier from about ``fit_rows`` rows at most. ``label_col``: 0, 1 or null for each page; else labels are
    those of the seeds. Writes the counts below the shared folder."""
    label = F.lit(None) if label_col is None else F.col(f"`{label_col}`")
    named = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"), label.cast("int").alias("label"))
    words = Words.counted(materialize(word_counts(named, "html"), "words"), seeds)
    places = named.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label")
    if label_col is not None:
        places = places.where("label IN (0, 1)")
    # At most about fit_rows rows reach the driver.
    drawn = materialize(sampled(places, fit_rows), "drawn")
    split = words.segmented(drawn)
    rows = sorted((r["words"], r["path"], r["label"]) for r in drawn.join(split, "host").select("words", "path", F.coalesce("label", F.lit(-1)).alias("label")).collect())
    discard(drawn, split)
    bags = [features(w.split(), p) for w, p, _ in rows]
    if label_col is not None:
        return Filter(words, NaiveBayes(zip(bags, (y for _, _, y in rows), strict=True)))
    labels = seed_labels((w for w, _, _ in rows), seeds)
    bayes = NaiveBayes(zip(bags, labels, strict=True))
    return Filter(words, NaiveBayes((b, int(y or bayes.score(b) >= 0.5)) for b, y in zip(bags, labels, strict=True)))


JUDGED_SCHEMA = "page_id long, host string, path string, rule string, verdict string, score double, words string"


def judge(df: DataFrame, rules: Rules, fitted: Filter, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (or null), verdict (the rule's, else by the classifier), score, words of the host."""
    urls = df.select(F.col(f"`{id_col}`").alias("page_id"), host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"))
    bayes = fitted.bayes

    def run(batches):
        for batch in batches:
            out = []
            for host, path, words in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "words")), strict=True):
                score = bayes.score(features(words.split(), path))
                rule, verdict = rules.find(host, path) or (None, "block" if score >= 0.5 else "allow")
                out.append((rule, verdict, score))
            cols = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("host"), batch.column("path"), *(pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.float64()), strict=True)), batch.column("words")],
                ["page_id", "host", "path", "rule", "verdict", "score", "words"],
            )

    return urls.join(fitted.words.segmented(urls), "host").select("page_id", "host", "path", "words").mapInArrow(run, JUDGED_SCHEMA)
