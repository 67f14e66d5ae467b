"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding: lower case, compatibility forms and accents removed, look-alike letters of other
scripts and digits or signs used as letters replaced, everything else between words one blank.
Digits and signs fold before a letter, after a letter or at a word's start; one or two at a word's
end fold only if the lexicon has the word they give (`garbag3`), and are decoration else (`stupid$$`).
The lexicon holds whole words (` word `)
and word beginnings (` begin`), each with a weight: the log-odds of documents that hold it
being labelled toxic. Phrases that are exceptions cancel the entries inside them: pairs of words
that mark clean documents although one of the two is an entry, learned from the same rows, and any
the caller names. A document's features are the logarithm of its summed weights and the weight per
word, at most 1; a logistic curve over both, fitted on the labelled rows, gives the score.

The lexicon and the curve are fitted on at most `max_rows` labelled rows; scoring reads every
row and whole texts. The lexicon is as large as those rows make it; it and three numbers travel
with the code.

Defined cases: null and empty texts score like a text without any match; without labelled rows
of both kinds the lexicon is empty and every score is 0.0; repeated rows score alike; a null
doc_id is not held out; other columns do not matter.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.llm.common import renamed_apart
from stacklore.session import materialise

MAX_ROWS = 6_000  # labelled rows the lexicon is learned from at most
MIN_DOCS = 3  # documents of the toxic side an entry must occur in
MIN_WEIGHT = 2.5
MIN_CLEAN = 1.0  # log-odds for clean documents that make a pair of words an exception
BEGINNINGS = range(4, 9)
THRESHOLD = 0.3
# Phrases in which an entry is no insult.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy")

# Letters of other scripts that look like Latin ones, and digits and signs used as letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ԁ": "d",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ε": "e", "ι": "i", "ρ": "p",
    "τ": "t", "υ": "u", "κ": "k", "ν": "v", "ı": "i", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe",
}
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_LEET = re.compile(r"(?:(?<=[a-z])|(?<![a-z0-9@$]))[0134578@$]+(?=[a-z])")
_TRAILING = re.compile(r"(?<![a-z0-9@$])[a-z]{2,}[0134578@$]{1,2}(?![a-z0-9@$])")
_LEET_TABLE = str.maketrans(LEET)
_MARKS = re.compile(r"[̀-ͯ​-‍﻿]")
_BETWEEN = re.compile(r"[^a-z0-9]+")
_GLYPH_TABLE = str.maketrans(HOMOGLYPHS)


def fold(text: str | None, known=()) -> str:
    """Folded words with one blank before, between and after them; `known` holds whole words as ` word `."""
    low = (text or "").lower()
    if not low.isascii():
        low = _MARKS.sub("", unicodedata.normalize("NFKD", low)).translate(_GLYPH_TABLE)
    low = _LEET.sub(lambda m: m[0].translate(_LEET_TABLE), low)
    if known:
        low = _TRAILING.sub(lambda m: w if f" {(w := m[0].translate(_LEET_TABLE))} " in known else m[0], low)
    return f" {_BETWEEN.sub(' ', low).strip()} "


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)  # constant, per log weight, per density
    fitted: bool = False

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            found.add_word(fold(phrase), (len(fold(phrase)), None))
        if len(found):
            found.make_automaton()
        return found


def matched(folded: str, automaton) -> tuple[float, int]:
    """(summed weights, matches); of matches starting at one place the heaviest counts once.

    Matches wholly inside an exception phrase do not count.
    """
    if not len(automaton):
        return 0.0, 0
    best: dict[int, tuple[float, int]] = {}
    excepted: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            excepted.append((start, end))
        elif start not in best or weight > best[start][0]:
            best[start] = (weight, end)
    if excepted:
        best = {
            s: (w, e) for s, (w, e) in best.items() if not any(a <= s and e <= b for a, b in excepted)
        }
    return math.fsum(w for w, _ in best.values()), len(best)


def features(text: str | None, automaton) -> tuple[float, float, int]:
    """(log of summed weights, weight per word, matches)."""
    folded = fold(text, automaton)
    total, n = matched(folded, automaton)
    words = max(1, folded.count(" ") - 1)
    return math.log1p(total), min(1.0, total / words), n


def entries_of(text: str) -> set[str]:
    out = set()
    for word in set(fold(text).split()):
        if word.isdigit():
            continue
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in BEGINNINGS if len(word) > n)
    return out


def choose_entries(counts: dict[str, tuple[int, int]], clean: int, toxic: int) -> dict[str, float]:
    """Weights from (clean, toxic) document counts per entry: log-odds with add-half smoothing.

    A beginning is taken only where it sums up several words: not if one longer entry has
    two thirds of its documents. An entry inside a taken beginning adds nothing and is left out.
    """
    weighed = {}
    for entry, (n0, n1) in counts.items():
        if n1 < MIN_DOCS:
            continue
        odds = math.log((n1 + 0.5) / (toxic - n1 + 0.5)) - math.log((n0 + 0.5) / (clean - n0 + 0.5))
        if odds >= MIN_WEIGHT:
            weighed[entry] = odds
    longest_share = Counter()
    for entry in weighed:
        for n in range(1 + BEGINNINGS.start, len(entry)):
            longest_share[entry[:n]] = max(longest_share[entry[:n]], counts[entry][1])
    kept: dict[str, float] = {}
    for entry in sorted(weighed, key=lambda e: (-counts[e][1], len(e), e)):
        if not entry.endswith(" ") and 3 * longest_share[entry] >= 2 * counts[entry][1]:
            continue
        if not any(entry[:n] in kept for n in range(1 + BEGINNINGS.start, len(entry))):
            kept[entry] = weighed[entry]
    return kept


def choose_exceptions(counts: dict[str, tuple[int, int]], clean: int, toxic: int) -> tuple[str, ...]:
    """Phrases of MIN_DOCS clean documents or more that speak for a clean document."""
    return tuple(sorted(
        phrase for phrase, (n0, n1) in counts.items()
        if n0 >= MIN_DOCS
        and math.log((n0 + 0.5) / (clean - n0 + 0.5)) - math.log((n1 + 0.5) / (toxic - n1 + 0.5)) >= MIN_CLEAN
    ))


def pairs_of(text: str | None, automaton) -> set[str]:
    """Pairs of neighbouring words of which an entry of the lexicon covers or begins one."""
    words = fold(text, automaton).split()
    hit = [bool(len(automaton)) and matched(f" {w} ", automaton)[1] > 0 for w in words]
    return {f"{a} {b}" for (a, b), (x, y) in zip(zip(words, words[1:], strict=False), zip(hit, hit[1:], strict=False), strict=True) if x or y}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, float, float]:
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        gradient = x.T @ (y - p) - ridge * beta
        hessian = (x * w[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def held_out(doc_id: Column, folds: int, fold_no: int) -> Column:
    """Rows kept out of training: CRC-32 of the id as text, by remainder; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold_no, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold_no: int, limit: int):
    """At most `limit` labelled rows outside the held-out fold, by smallest hash of the id.

    Of rows repeated with one id, the one with the smallest SHA-256 of its text is taken.

    Labels meet documents by id; the sample is chosen among label rows, which are narrow, so
    only the texts of chosen rows move.
    """
    labels = labels.select(labels["doc_id"], labels[label])
    usable = labels.filter(labels[label].isin(0, 1) & labels["doc_id"].isNotNull()).filter(
        ~held_out(labels["doc_id"], folds, fold_no)
    )
    one = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    side = F.broadcast(materialise(chosen.withColumnRenamed("doc_id", "_id"), "training-ids"))  # `limit` rows at most
    narrow = docs.select(docs["doc_id"], docs["text"])
    rows = narrow.join(side, narrow["doc_id"] == F.col("_id")).select("doc_id", "text", "_label")
    first = F.min(F.struct(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "text"))
    return rows.groupBy("doc_id", "_label").agg(first.alias("_first")).select("doc_id", F.col("_first.text").alias("text"), "_label")


def entry_counts(sample: DataFrame, entries_in: Callable[[str], set[str]]) -> DataFrame:
    """(entry, clean, toxic): sampled documents of either label that hold an entry, counted per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[label].update(entries_in(text or ""))
        entries = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(entries), 50_000):
            part = entries[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *[pa.array([c[e] for e in part], pa.int64()) for c in counts]],
                names=["entry", "clean", "toxic"],
            )

    counted = sample.select("text", "_label").mapInArrow(run, "entry string, clean long, toxic long")
    return counted.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _odds(of: str, n: int) -> Column:
    return F.log((F.col(of) + 0.5) / (F.lit(n) - F.col(of) + 0.5))


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS,
    folds: int = 4, fold_no: int = 2,
) -> Lexicon:
    """Learn from at most `max_rows` labelled rows outside the held-out fold.

    Entries are counted where the rows are; the driver gets those of several documents that
    speak for a label, and two features per sampled row.
    """
    sample = materialise(training_rows(docs, labels, "toxic", folds, fold_no, max_rows), "lexicon-rows")
    totals = {int(r[0]): r[1] for r in sample.groupBy("_label").count().collect()}
    if len(totals) < 2:
        return Lexicon(exceptions=exceptions)
    clean, toxic = totals[0], totals[1]
    # A little below the bound, which the driver applies to the few that are left.
    found = entry_counts(sample, entries_of).filter(F.col("toxic") >= MIN_DOCS).filter(
        _odds("toxic", toxic) - _odds("clean", clean) >= MIN_WEIGHT - 0.01
    )
    lexicon = Lexicon(choose_entries({r["entry"]: (r["clean"], r["toxic"]) for r in found.collect()}, clean, toxic))

    def pairs(text: str, held: list = []) -> set[str]:  # noqa: B006  (one automaton per task)
        if not held:
            held.append(lexicon.automaton())
        return pairs_of(text, held[0])

    phrases = entry_counts(sample, pairs).filter(F.col("clean") >= MIN_DOCS).filter(
        _odds("clean", clean) - _odds("toxic", toxic) >= MIN_CLEAN - 0.01
    )
    learned = choose_exceptions({r["entry"]: (r["clean"], r["toxic"]) for r in phrases.collect()}, clean, toxic)
    lexicon.exceptions = tuple(dict.fromkeys([*exceptions, *learned]))
    seen = matches(sample.withColumnRenamed("_label", "label"), lexicon, keep=["label"]).collect()
    x = np.array([(1.0, r["log_weight"], r["density"]) for r in seen])
    y = np.array([float(r["label"]) for r in seen])
    lexicon.curve, lexicon.fitted = _logistic(x, y), True
    return lexicon


def matches(docs: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` with log_weight, density and the number of matches, per row."""
    names = [*keep, "log_weight", "density", "matches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [features(content, automaton) for content in batch.column(0).to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.float64(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=names)

    chosen = docs.select(docs[text], *[docs[c] for c in keep])
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:]]
    return chosen.mapInArrow(run, ", ".join([*kept, "log_weight double, density double, matches long"]))


def probability(lexicon: Lexicon) -> Column:
    """Score of the curve over the two features."""
    if not lexicon.fitted:
        return F.lit(0.0)
    constant, per_log, per_density = lexicon.curve
    z = F.lit(constant) + per_log * F.col("log_weight") + per_density * F.col("density")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score(docs: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, log_weight, density, matches) per row of `docs`."""
    return matches(docs, lexicon, [id_column], text).select(
        F.col(id_column).alias("doc_id"), probability(lexicon).alias("score"), "log_weight", "density", "matches"
    )


def without_toxic(
    docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """Rows of `docs` that score below the threshold, all columns as they were."""
    columns, at = docs.columns, docs.columns.index(text)
    docs, _ = renamed_apart(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        constant, per_log, per_density = lexicon.curve
        for batch in batches:
            found = [features(content, automaton) for content in batch.column(at).to_pylist()]
            odds = [constant + per_log * f[0] + per_density * f[1] for f in found]
            keep = [not lexicon.fitted or 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) < threshold for z in odds]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema).toDF(*columns)
