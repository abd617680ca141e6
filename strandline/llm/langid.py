"""Language identification by spans.

Words are runs of letters. The ranges of Unicode scripts narrow a word's candidate
languages to those seen with its script; hashed character 1- to 4-grams and the word
itself give each candidate a naive Bayes score. A Viterbi pass with a switching penalty
labels every word, so that a mixed text falls into spans; the text's language is the one
with most letters. Scores are computed once per distinct word of a block, and the Viterbi
steps of all texts of a block run together. Texts longer than WINDOW words are cut into
windows for that. A later window is run once from each language that the word before it may
have; the best path through all windows is then put together from these runs, so labels are
those of one pass over the whole text.

The model knows every language with a labelled text that isn't held out. It is fitted on about
``fit_docs`` of these texts, or LEAST_DOCS of each language if that's more, chosen by a hash:
all of the languages with few texts, equally many of the others.

Cases: null texts and texts without a letter are "und" with score 0; with no labelled
text at all every text is "und"; ties go to the language that sorts first; repeated rows
and ids are each handled by themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import Codes, blocks, fold, short_batches, strings, texts

# First code points of script ranges, in order, and the script from there on.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
)
# End of fixed values.

SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([a for a, _ in SCRIPTS])
_SCRIPT_OF = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

WORDS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
LONGEST_GRAM = 4
WINDOW = 2048
CHUNK = 1 << 15  #: words whose features are held at once
SMOOTHING = 0.3
WORST = 8.0  #: how far a word may put a language behind the best: one odd word doesn't outweigh a switch; a parameter of the model, alike for texts of any length
SWITCH = 10.0
LEAST_DOCS = 500  #: texts of a language that a fit may always use


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of all features, and the script of each word."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = points == 32
    number = np.cumsum(space) - 1
    n = len(points)
    who, bucket = [], []
    mixed = points * np.uint64(0x9E3779B97F4A7C15)
    rolling = np.zeros(n, np.uint64)
    blocked = np.zeros(n, bool)
    for size in range(1, LONGEST_GRAM + 1):
        m = n - size + 1
        if m <= 0:
            break
        rolling = (rolling[:m] ^ mixed[size - 1 :]) * np.uint64(0xBF58476D1CE4E5B9 + 2 * size)
        if size > 2:
            blocked = blocked[:m] | space[size - 2 : size - 2 + m]
        ok = ~blocked[:m] & ~(space[:m] & (size == 1))
        h = rolling[ok]
        who.append(number[:m][ok])
        bucket.append((h ^ h >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - 16))
    at = np.flatnonzero(~space)
    starts = np.flatnonzero(space)[:-1]
    position = np.arange(n) - starts[number.clip(0, len(starts) - 1)]
    powers = np.cumprod(np.full(int(position.max(initial=0)) + 2, 0x100000001B3, np.uint64))
    terms = np.where(space, 0, mixed * powers[position])
    whole = np.add.reduceat(terms, starts) if len(starts) else terms[:0]
    who.append(np.arange(len(words)))
    bucket.append((whole ^ whole >> np.uint64(31)) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - 16))
    script = _SCRIPT_OF[np.searchsorted(_STARTS, points[starts + 1].astype(np.int64), side="right") - 1] if len(at) else np.empty(0, np.int64)
    return np.concatenate(who), np.concatenate(bucket).astype(np.int64), script


@dataclass
class Model:
    langs: list[str]
    logs: np.ndarray  #: bucket by language
    allowed: np.ndarray  #: script by language

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row per word: how far each language is behind the best, from 0 down to -WORST."""
        return np.concatenate([self._chunk_scores(words[i : i + CHUNK]) for i in range(0, len(words), CHUNK)])

    def _chunk_scores(self, words: list[str]) -> np.ndarray:
        who, bucket, script = grams(words)
        out = np.empty((len(words), len(self.langs)))
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(who, weights=self.logs[bucket, k], minlength=len(words))
        allowed = self.allowed[script]
        unknown = ~allowed.any(axis=1)  # a script that no language was seen with tells nothing
        allowed[unknown] = True
        out[unknown] = 0
        out[~allowed] = -np.inf
        out -= out.max(axis=1, keepdims=True)
        return np.maximum(out / 2, -WORST).astype(np.float32)  # features of a word overlap: half of their evidence counts


def _lanes(scores: np.ndarray, begins: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Viterbi steps of many slices of ``scores`` side by side, each from a row of ``before``: values at the end, and by slice and word (from
    where each slice begins) whether a language stays and which one leads."""
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths)
    starts = ends - lengths
    stays = np.zeros((int(ends[-1]) if len(ends) else 0, scores.shape[1]), bool)
    leads = np.zeros(len(stays), np.int16)
    value = before[order]
    first, at_first, longest = begins[order], starts[order], int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    for t in range(longest):
        k = active[t]
        now = value[:k]
        lead = now.argmax(axis=1)
        switched = now[np.arange(k), lead][:, None] - SWITCH
        stay = now >= switched
        stays[at_first[:k] + t] = stay
        leads[at_first[:k] + t] = lead
        value[:k] = np.where(stay, now, switched) + scores[first[:k] + t]
    out = np.empty_like(value)
    out[order] = value
    return out, starts, stays, leads


def viterbi(scores: np.ndarray, bounds: np.ndarray, window: int | None = None) -> np.ndarray:
    """A label for each row of ``scores``; the sequences are the slices between bounds."""
    window = window or WINDOW
    n = scores.shape[1]
    labels = np.zeros(len(scores), np.int16)
    if not len(scores):
        return labels
    parts = [np.arange(a, b, window) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]  # where the windows of each sequence begin
    copies = [np.minimum(np.arange(len(p)) * n, 1) * (n - 1) + 1 for p in parts]  # 1 of the first, n of each other
    begins = np.concatenate([np.repeat(p, c) for p, c in zip(parts, copies, strict=True)])
    lengths = np.concatenate([np.repeat(np.minimum(p + window, b) - p, c) for p, c, b in zip(parts, copies, bounds[1:], strict=True)])
    before = np.zeros((len(begins), n))
    lane, first_lane = 0, []
    for c in copies:
        first_lane.append(lane)
        for w in range(1, len(c)):
            at = lane + 1 + (w - 1) * n
            before[at : at + n] = np.where(np.eye(n, dtype=bool), 0.0, -np.inf)
        lane += int(c.sum())
    value, starts, stays, leads = _lanes(scores, begins, lengths, before)
    chosen, exits = [], []  # the runs that make up the best paths, and the languages they end in
    for at, c in zip(first_lane, copies, strict=True):
        if not len(c):
            continue
        reached, came = value[at], []
        for w in range(1, len(c)):
            run = at + 1 + (w - 1) * n
            through = reached[:, None] + value[run : run + n]
            came.append(through.argmax(axis=0))
            reached = through.max(axis=0)
        last = int(reached.argmax())
        for w in range(len(c) - 1, 0, -1):
            entry = int(came[w - 1][last])
            chosen.append(at + 1 + (w - 1) * n + entry)
            exits.append(last)
            last = entry
        chosen.append(at)
        exits.append(last)
    chosen, now = np.array(chosen, np.int64), np.array(exits, np.int16)
    order = np.argsort(-lengths[chosen], kind="stable")
    chosen, now = chosen[order], now[order]
    sizes = lengths[chosen]
    longest = int(sizes[0])
    # From the end of each run backwards; shorter ones join in when their last word is reached.
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    for t in range(longest - 1, -1, -1):
        k = active[t]
        labels[begins[chosen[:k]] + t] = now[:k]
        at = starts[chosen[:k]] + t
        now[:k] = np.where(stays[at, now[:k]], now[:k], leads[at])
    return labels


def label(model: Model, words_of: list[list[str]]) -> list[np.ndarray]:
    """The number of a language for each word of each text."""
    return [x[0] for x in _labelled(model, words_of)]


def _labelled(model: Model, words_of: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
    codes = Codes()
    which = [np.fromiter(map(codes.__getitem__, map(str.lower, words)), np.int64, len(words)) for words in words_of]
    table = model.word_scores(list(codes)) if codes else np.zeros((0, len(model.langs)), np.float32)
    sizes = [len(w) for w in which]
    flat = np.concatenate([*which, np.empty(0, np.int64)])
    ends = np.cumsum([0, *sizes])
    scores = table[flat]
    labels = viterbi(scores, ends)
    return [(labels[a:b], scores[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def predict(model: Model, values: list[str]) -> list[tuple[str, float]]:
    """Language and score (0 to 1) of each text: the language's share of the letters, times its probability among the languages."""
    words_of = [WORDS.findall(v) for v in values]
    out = []
    if not model.langs:
        return [("und", 0.0)] * len(values)
    for words, (labels, scores) in zip(words_of, _labelled(model, words_of), strict=True):
        if not any(ch.isalpha() for w in words for ch in w):
            out.append(("und", 0.0))
            continue
        letters = np.bincount(labels, weights=np.fromiter(map(len, words), float, len(words)), minlength=len(model.langs))
        best = int(letters.argmax())
        total = scores[labels == best].sum(axis=0, dtype=np.float64)
        p = 1 / np.exp(np.clip(total - total[best], -50, 50)).sum()
        out.append((model.langs[best], float(letters[best] / letters.sum() * min(1.0, p))))
    return out


def quota(counts: Iterable[int], most: int) -> int:
    """How many texts of each language at most make ``most`` in all."""
    left, counts = most, sorted(counts)
    for k, n in enumerate(counts):
        if n * (len(counts) - k) > left:
            return left // (len(counts) - k)
        left -= n
    return most


def labelled_sample(docs: DataFrame, fit_docs: int) -> tuple[DataFrame, list[str]]:
    """Rows that a fit may see, labelled and not held out, in bounded numbers of each language, and all languages of such rows."""
    seen = docs.where(F.col("lang").isNotNull() & (fold("doc_id") != 0))
    counts = {r["lang"]: r["count"] for r in seen.groupBy("lang").count().collect()}
    each = max(LEAST_DOCS, quota(counts.values(), fit_docs))
    cut = [x for lang, n in counts.items() if n > each for x in (F.lit(lang), F.lit(int((1 << 30) * each / n)))]
    if cut:
        share = F.coalesce(F.create_map(*cut)[F.col("lang")], F.lit(1 << 30))
        seen = seen.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share)
    return seen, sorted(counts)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = 12_000) -> Model:
    """Counts features on the executors; what reaches the driver is at most BUCKETS counts a language."""
    docs = texts(df, id_col, text_col, lang=lang_col)
    sample, langs = labelled_sample(docs, fit_docs)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPT_NAMES), 0), bool))
    numbers = {lang: k for k, lang in enumerate(langs)}

    def count(batches):
        total = np.zeros((BUCKETS + len(SCRIPT_NAMES)) * len(langs), np.int64)
        for block in blocks(batches):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(block.column("lang").to_pylist(), strings(block), strict=True):
                by_lang.setdefault(lang, []).append(text.lower())
            for lang, values in by_lang.items():
                codes = Codes()
                which = np.concatenate([np.fromiter(map(codes.__getitem__, WORDS.findall(v)), np.int64) for v in values])
                if not codes:
                    continue
                all_times, all_words, k = np.bincount(which, minlength=len(codes)), list(codes), numbers[lang]
                for i in range(0, len(all_words), CHUNK):
                    times = all_times[i : i + CHUNK]
                    who, bucket, script = grams(all_words[i : i + CHUNK])
                    total[k :: len(langs)][:BUCKETS] += np.bincount(bucket, weights=times[who], minlength=BUCKETS).astype(np.int64)
                    total[k :: len(langs)][BUCKETS:] += np.bincount(script, weights=times, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    counted = sample.select("doc_id", "lang", "text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((BUCKETS + len(SCRIPT_NAMES)) * len(langs))
    total[counted["at"].to_numpy()] = counted["n"].to_numpy()
    total = total.reshape(-1, len(langs))
    features, scripts = total[:BUCKETS], total[BUCKETS:]
    logs = np.log(features + SMOOTHING) - np.log(features.sum(axis=0) + SMOOTHING * BUCKETS)
    return Model(langs, logs.astype(np.float32), scripts >= 0.01 * scripts.sum(axis=0))


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of each text."""

    def run(batches):
        for block in blocks(batches):
            out = predict(model, strings(block))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").cast(pa.int64()), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def spans(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, span, lang, start and end (code points) of each stretch of one language."""

    def run(batches):
        for block in blocks(batches):
            rows = []
            found = [list(WORDS.finditer(v)) for v in strings(block)] if model.langs else []
            for doc, places, labels in zip(block.column("doc_id").to_pylist(), found, label(model, [[m[0] for m in x] for x in found]), strict=False):
                edges = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(places)] if places else [0]
                rows += [(doc, i, model.langs[labels[a]], places[a].start(), places[b - 1].end()) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "span", "lang", "start", "end"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, span long, lang string, start long, end long")


def keep_identified(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text has a language."""

    def run(batches):
        for block in blocks(batches, text_col):
            yield block.filter(pa.array([lang != "und" for lang, _ in predict(model, strings(block, text_col))], pa.bool_()))

    short_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
