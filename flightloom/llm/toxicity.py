"""Toxicity: a learned lexicon, matched with one spelling error, weighed by the words around it."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom.llm.common import whole_text
from flightloom.session import settle

FOLDS = 5  # fold 0 by crc32 of the id is held out
SAMPLE = {1: 2_000, 0: 4_000}  # labelled rows of each class that the model is fitted on, at most
SHORTEST, LONGEST = 4, 16  # letters of a lexicon term
LEAST_DOCS, LEAST_SHARE = 3, 0.005  # toxic documents that contain a term, also as a share of the sample's
EVIDENCE = 15.0  # -log of the chance that its words fall into toxic documents only
MOST_CLEAN = 0.02  # times as often among clean documents, at most
FUZZY_WHOLE, FUZZY_BEGINNING = 4, 5  # letters from which a whole word, or a word beginning, may have one error
BEFORE = 2  # stands for one error, a letter put in before the first
WINDOW = 6  # words on either side of a match
LEAST_CONTEXTS = 5  # clean documents that have a word beside a term, for it to be learned as a reporting word
CONTEXT_ODDS = 4.0  # times as often beside terms in clean documents as in toxic ones
SEEN_WORDS = 500_000  # words remembered in a task

WORD = re.compile(r"[^\W\d_](?:[^\W_]|[*@$](?=\w))*")

# Words that report speech, and words that address a person (English, German, French, Spanish). More
# reporting words are learned from the labelled rows.
REPORTING = frozenset(
    "said says quote quoted quotes word words term terms called wrote written meaning "
    "sagte sagt zitat zitierte wort begriff schrieb nannte dit disait cite citation mot terme écrit appelé "
    "dijo dice cita citó palabra término escribió llamó".split()
)
ADDRESSING = frozenset("you your youre yours u ur du dein tu ton vous votre tus usted".split())
QUOTES = "\"“”«»„‘’"


@dataclass(frozen=True)
class Term:
    letters: str
    whole: bool  # the word ends here; else any ending may follow

    @property
    def fuzzy(self) -> bool:
        return len(self.letters) >= (FUZZY_WHOLE if self.whole else FUZZY_BEGINNING)


class Lexicon:
    """A trie of terms run against the Levenshtein automata of distance one.

    A state is the set of (trie node, errors so far) that the letters read can have reached; an error
    is a letter changed, left out or put in; a letter put in before a word beginning makes another word. Sets are made as they are met and their
    transitions kept, so that most words are turned away after two or three look-ups. A word that
    is known to be harmless, or begins with one that is, is no misspelling.
    """

    def __init__(self, terms: Iterable[Term], harmless: Iterable[str] = ()):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[Term | None] = [None]
        self.fuzzy: list[bool] = [False]  # some term that may have an error goes through here
        for term in sorted(terms, key=lambda t: (t.letters, t.whole)):
            node, path = 0, [0]
            for letter in term.letters:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.fuzzy.append(False)
                node = self.children[node][letter]
                path.append(node)
            self.ends[node] = term
            if term.fuzzy:
                for n in path:
                    self.fuzzy[n] = True
        self.harmless = frozenset(harmless)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _closed(self, nodes: set[tuple[int, int]]) -> frozenset:
        """With the nodes reached by leaving a letter of the term out."""
        found = set(nodes)
        for node, errors in nodes:
            if not errors:
                found |= {(c, 1) for c in self.children[node].values() if self.fuzzy[c]}
        return frozenset(found)

    def _state(self, nodes: set[tuple[int, int]]) -> int:
        closed = self._closed(nodes)
        if closed not in self.states:
            self.states[closed] = len(self.sets)
            self.sets.append(closed)
            self.steps.append({})
        return self.states[closed]

    def _step(self, state: int, letter: str) -> int:
        nodes = set()
        for node, errors in self.sets[state]:
            child = self.children[node].get(letter)
            if child is not None and (not errors or self.fuzzy[child]):
                nodes.add((child, errors))
            if not errors and self.fuzzy[node]:
                nodes.add((node, 1 if node else BEFORE))
                nodes |= {(c, 1) for c in self.children[node].values() if self.fuzzy[c]}
        self.steps[state][letter] = to = self._state(nodes)
        return to

    def match(self, word: str) -> int:
        """0: no term; 1: a term; 2: a term with one error."""
        state, steps, begun = self.start, self.steps, False
        for i, letter in enumerate(word):
            to = steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            nodes = self.sets[state]
            if not nodes:
                break
            for node, errors in nodes:
                end = self.ends[node]
                if end and not errors and (not end.whole or i == len(word) - 1):
                    return 1
                if end and errors == 1 and end.fuzzy and not end.whole:
                    begun = True
        ends = (self.ends[n] for n, e in self.sets[state] if e)
        if not begun and not any(end and end.whole and end.fuzzy for end in ends):
            return 0
        return 0 if any(word[:k] in self.harmless for k in range(FUZZY_WHOLE - 1, len(word) + 1)) else 2


FEATURES = ("exact", "misspelled", "quoted", "addressed", "density")


class Scanner:
    """Turns texts into the model's features; remembers which words it has seen."""

    def __init__(self, lexicon: Lexicon, reporting: Iterable[str] = ()):
        self.lexicon = lexicon
        self.reporting = REPORTING | frozenset(reporting)
        self.seen: dict[str, int] = {}

    def hits(self, words: list[str]) -> list[tuple[int, int]]:
        """(place, kind) of the words that match a term."""
        seen = self.seen
        for w in set(words).difference(seen):
            seen[w] = self.lexicon.match(w)
        found = [(i, seen[w]) for i, w in enumerate(words) if seen[w]]
        if len(seen) > SEEN_WORDS:
            seen.clear()
        return found

    def reported(self, words: list[str], i: int) -> bool:
        """Whether a reporting word stands near word i, with no one addressed in between."""
        for side in (words[max(0, i - WINDOW) : i][::-1], words[i + 1 : i + 1 + WINDOW]):
            for w in side:
                if w in ADDRESSING:
                    break
                if w in self.reporting:
                    return True
        return False

    def features(self, text: str) -> list[float]:
        lower = text.lower()
        words = WORD.findall(lower)
        hits = self.hits(words)
        if not hits:
            return [0.0] * len(FEATURES)
        spans = [m.span() for m in WORD.finditer(lower)]
        exact = misspelled = quoted = addressed = 0.0
        for i, kind in hits:
            before = lower[max(0, spans[i][0] - 1) : spans[i][0]]
            after = lower[spans[i][1] : spans[i][1] + 1]
            in_quotes = before in QUOTES and after in QUOTES and before and after
            if in_quotes or self.reported(words, i):
                quoted += 1
                continue
            exact += kind == 1
            misspelled += kind == 2
            addressed += not ADDRESSING.isdisjoint(words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW])
        return [
            float(np.log1p(exact)), float(np.log1p(misspelled)), float(np.log1p(quoted)),
            float(np.log1p(addressed)), 100 * (exact + misspelled) / len(words),
        ]


@dataclass
class Model:
    """A fitted lexicon and the weights of a logistic regression; small, whatever the corpus."""

    terms: list[Term]
    harmless: list[str]
    reporting: list[str]
    weights: list[float]  # one per feature, then the constant

    def scanner(self) -> Scanner:
        return Scanner(Lexicon(self.terms, self.harmless), self.reporting)

    def score(self, features: np.ndarray) -> np.ndarray:
        z = features @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most SAMPLE labelled rows of each class, outside the held-out fold, in order of a hash of doc_id."""
    usable = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [usable.filter(F.col("toxic") == c).orderBy(*order).limit(n) for c, n in SAMPLE.items()]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select("doc_id", F.lower(whole_text()).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")  # at most 6,000 ids


def mined_terms(sample: DataFrame, n_toxic: int, n_clean: int) -> list[Term]:
    """Words and word beginnings that many toxic documents have and hardly any clean one.

    Counted over the documents of the sample. Of nested beginnings the longest that (nearly) all
    documents of the shorter one have is taken, and nothing that a taken one covers. The shares asked for bound
    how many there can be.
    """
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)))
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.length("w"), F.lit(LONGEST)))
    stems = F.transform(lengths, lambda k: F.substring(F.col("w"), F.lit(1), k))
    per_word = (
        sample.select("doc_id", "toxic", F.explode(words).alias("w"))
        .filter(F.length("w") >= SHORTEST)
        .select("doc_id", "toxic", F.explode(F.concat(stems, F.array(F.concat("w", F.lit("$"))))).alias("stem"))
    )
    chance = n_toxic / (n_toxic + n_clean)
    per_doc = per_word.groupBy("stem", "doc_id", "toxic").agg(F.count("*").alias("words"))
    toxic_words = F.sum(F.col("words") * F.col("toxic"))
    counts = (
        per_doc.groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"), toxic_words.alias("words"))
        .filter(F.col("toxic") >= max(LEAST_DOCS, LEAST_SHARE * n_toxic))
        .filter(F.col("clean") * n_toxic <= F.col("toxic") * MOST_CLEAN * n_clean)
        .filter(F.col("words") * -log(chance) >= EVIDENCE)
    )
    found = {r.stem: r.toxic for r in counts.collect()}  # at most (stems per document) / LEAST_SHARE
    taken: list[str] = []
    passed: set[str] = set()
    for stem in sorted(found, key=lambda s: (len(s), s)):
        if stem in passed or any(stem.startswith(t) for t in taken):
            continue
        while True:
            passed.add(stem)
            longer = [s for s in found if len(s) == len(stem) + 1 and s.startswith(stem) and found[s] >= 0.98 * found[stem]]
            if not longer:
                break
            stem = max(longer, key=lambda s: (found[s], s))
        taken.append(stem)
    return [Term(s.rstrip("$"), s.endswith("$")) for s in sorted(taken)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 50) -> list[float]:
    """Weights and constant by Newton's method with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    penalty = ridge * np.r_[np.ones(x.shape[1] - 1), 0.01]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and weights from at most 2,000 toxic and 4,000 clean labelled rows (``SAMPLE``).

    Misspellings that clean rows of the sample contain are noted as harmless words; words that stand beside
    terms in clean rows far more often than in toxic ones are reporting words, in whatever language. Without rows of
    both classes the lexicon is empty and every score is below one half.
    """
    sample = settle(training_rows(docs, labels), "toxicity-sample")
    counts = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts.get(1) or not counts.get(0):
        return Model([], [], [], [0.0] * len(FEATURES) + [-2.0])
    terms = mined_terms(sample, counts[1], counts[0])

    def misspellings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms)
        for batch in batches:
            words = {w for t in batch.text for w in WORD.findall(t)}
            yield pd.DataFrame({"word": [w for w in words if lexicon.match(w) == 2]}, dtype=object)

    clean = sample.filter("toxic = 0").select("text")
    harmless = [r.word for r in clean.mapInPandas(misspellings, "word string").distinct().collect()]

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Model(terms, harmless, [], []).scanner()
        for batch in batches:
            out = []
            for text, toxic in zip(batch.text, batch.toxic):
                words = WORD.findall(text)
                hits = [i for i, _ in scanner.hits(words)]
                around = {w for i in hits for w in words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]}
                out += [(w, toxic) for w in around]
                out += [(None, toxic)] * bool(hits)
            yield pd.DataFrame(out, columns=["word", "toxic"]).astype({"word": object, "toxic": "int32"})

    beside = sample.mapInPandas(contexts, "word string, toxic int").groupBy("word")
    beside = beside.agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).collect()
    clean_all, toxic_all = next(((r.clean, r.toxic) for r in beside if r.word is None), (0, 0))
    reporting = sorted(
        r.word for r in beside
        if r.word is not None and r.clean >= LEAST_CONTEXTS
        and r.clean * (toxic_all + 1) >= CONTEXT_ODDS * (r.toxic + 1) * clean_all
    )

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Model(terms, harmless, reporting, []).scanner()
        for batch in batches:
            out = pd.DataFrame([scanner.features(t) for t in batch.text], columns=list(FEATURES), dtype=float)
            out["toxic"] = batch.toxic.to_numpy()
            yield out

    schema = ", ".join(f"{f} double" for f in FEATURES) + ", toxic int"
    rows = np.array(sorted(sample.mapInPandas(measured, schema).collect()), float)  # the bounded sample
    return Model(terms, harmless, reporting, logistic(rows[:, :-1], rows[:, -1]))


def score_texts(model: Model):
    """A vectorised function from texts to scores."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = model.scanner()
        for batch in texts:
            features = np.array([scanner.features(t) for t in batch], float).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(features))

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For every row of ``docs``: doc_id, held_out, score (0 to 1) and predicted (1 from one half).

    Only the text enters a score; a null or empty text has no match and scores below one half. Very long texts are
    scored whole. An empty table gives an empty result.
    Labels are read outside the held-out fold only; null labels are skipped and a repeated label counts as toxic
    if any is. Rows without an id are scored and not held out. Rows that repeat score alike. Extra columns are ignored.
    """
    score = score_texts(fit(docs, labels))
    rows = docs.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), score(whole_text()).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged."""
    score = score_texts(fit(docs, labels))
    return docs.withColumn("__score", score(whole_text())).filter(F.col("__score") < threshold).drop("__score")
