"""Toxicity by Levenshtein automata over a learned lexicon.

The lexicon comes from labelled documents: words, and stems that begin words, which stand in
toxic documents and hardly elsewhere. A trie of the lexicon and the Levenshtein
automata of its terms are intersected: a state is a set of (trie node, errors),
built when a word first needs it, so misspelled terms are caught at the price of one
step for each letter. Around each hit a window of words tells quotation (quote marks on both sides,
words of reporting) from abuse (address in the second person). Counts of
hits by kind are the features of a logistic regression, which gives the score.

Lexicon and weights are learned from a bounded sample: at most ``SAMPLE`` labelled rows
of each class, taken by the hash of the id, and of rows that share an id the one whose text has the smallest hash. Weights are learned from each half of it with the
lexicon of the other half; the lexicon that scores comes from both.
Every document is scored, on its whole text and nothing else.

Defined cases: null and empty texts are scored like texts without hits; a document with several
labels counts as toxic if one says so, a null label is none; without labels of both classes the
score is the share of toxic rows, or 0; repeated rows get equal rows; a null ``doc_id`` is not held out;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import held_out, per_process, stored, strings

SAMPLE = 10_000  # labelled rows of each class
STEM = (4, 9)  # shortest and longest stem
MIN_DOCS = 3  # toxic documents of the sample with a term
MIN_ODDS = 12.0  # how much more frequent a term is in toxic documents
MAX_TERMS = 20_000
CONTEXT = 8  # words on each side of a hit
CACHED = 200_000  # tokens whose result a task keeps
STATES = 200_000  # states of the automaton kept before it starts anew
PAIRS = 25_000_000  # pairs of all its states, likewise: 100 MB

MARKS = "\"'`.,;:!?()[]{}<>*#$%&|=«»“”„‘’-_~/\\+"
OPENING, CLOSING = frozenset("\"'“„«‘`"), frozenset("\"'”“»’`")
#: Fixed words of reporting and of address.
REPORTING = frozenset("said says called calls quote quoted quotes wrote word term terms saying says reported".split())
ADDRESS = frozenset("you your youre u ur tu vous te toi du dich ihr usted vos".split())
FEATURES = ("exact", "stem", "misspelled", "quoted", "addressed", "density", "strength")


MAX_ERRORS = 2


def errors_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else MAX_ERRORS


class _State:
    """A state of the automaton: its pairs of node and errors, four bytes each, and what ends in it."""

    __slots__ = ("pairs", "moves", "found", "stem")

    def __init__(self, pairs: bytes):
        self.pairs = pairs
        self.moves: dict[str, _State] = {}
        self.found: tuple[str, int] | None = None
        self.stem: str | None = None


class Lexicon:
    """The automaton of all words within the allowed distance of a term, or that begin with a stem."""

    def __init__(self, terms: dict[str, tuple]):
        """``terms``: whether a term is a stem, its weight, and a third value if a stem is also a word."""
        self.next: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most = [0]  # errors allowed by some term below a node
        self.terms = terms
        self.words = {t for t, (stem, _, *word) in terms.items() if word or not stem}
        for term in sorted(terms):
            node = 0
            allowed = errors_allowed(term) if term in self.words else 0
            self.most[0] = max(self.most[0], allowed)
            for letter in term:
                if letter not in self.next[node]:
                    self.next[node][letter] = len(self.next)
                    self.next.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.next[node][letter]
                self.most[node] = max(self.most[node], allowed)
            self.term[node] = term
        # children of each node that may be reached with so many errors
        self.below = [[tuple(c for c in n.values() if self.most[c] >= e) for n in self.next] for e in range(MAX_ERRORS + 1)]
        self._reset()

    def _reset(self):
        self.states: dict[bytes, _State] = {}
        self.pairs = 0
        self.start = self._state([[0], [], []])

    def _state(self, levels: list[list[int]]) -> _State:
        """The state of the nodes at 0, 1 and 2 errors, with letters of terms left out at one error each."""
        best: dict[int, int] = {}
        for e, nodes in enumerate(levels):
            further = levels[e + 1] if e < MAX_ERRORS else None
            for node in nodes:
                if node not in best and self.most[node] >= e:
                    best[node] = e
                    if further is not None:
                        further.extend(self.below[e + 1][node])
        key = array("i", sorted(n << 2 | e for n, e in best.items())).tobytes()
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = _State(key)
            self.pairs += len(best)
            hits = [(e, self.term[n]) for n, e in best.items() if self.term[n] is not None]
            words = sorted((e, t) for e, t in hits if e == 0 or t in self.words and e <= errors_allowed(t))
            state.found = (words[0][1], words[0][0]) if words else None
            state.stem = min((t for e, t in hits if e == 0 and self.terms[t][0]), default=None)
        return state

    def _move(self, state: _State, letter: str) -> _State:
        levels: list[list[int]] = [[] for _ in range(MAX_ERRORS + 1)]
        for packed in memoryview(state.pairs).cast("i"):
            node, e = packed >> 2, packed & 3
            child = self.next[node].get(letter)
            if child is not None:
                levels[e].append(child)
            if e < MAX_ERRORS:
                levels[e + 1].append(node)  # a letter too many
                levels[e + 1].extend(self.below[e + 1][node])  # another letter
        state.moves[letter] = following = self._state(levels)
        return following

    def match(self, word: str) -> tuple[str, int] | None:
        """The closest term and its distance; a stem that begins the word counts as distance 0, after the word itself."""
        if len(self.states) > STATES or self.pairs > PAIRS:
            self._reset()
        state, stem = self.start, None
        for letter in word:
            state = state.moves.get(letter) or self._move(state, letter)
            if state.stem:
                stem = state.stem
            if not state.pairs:
                break
        if stem and not (state.found and state.found[1] == 0):
            return stem, 0
        return state.found


class Scorer:
    """Features of texts, and scores once there are weights."""

    def __init__(self, terms: dict[str, tuple], weights: np.ndarray | None = None):
        self.lexicon = Lexicon(terms)
        self.terms = terms
        self.weights = weights
        self.known: dict[str, tuple[str, int] | None] = {}
        self.older: dict[str, tuple[str, int] | None] = {}

    def hit(self, token: str) -> tuple[str, int] | None:
        """What a token is found as; tokens used since the last change of the two halves are kept."""
        if token not in self.known:
            if len(self.known) >= CACHED // 2:
                self.older, self.known = self.known, {}
            found = self.older.get(token, False)
            if found is False:
                word = token.strip(MARKS).lower()
                found = self.lexicon.match(word) if 3 <= len(word) <= 40 else None
            self.known[token] = found
        return self.known[token]

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        found = [self.known.get(t, False) for t in tokens]
        hits = [i for i, f in enumerate(found) if f or f is False and self.hit(tokens[i])]
        exact = stem = wrong = quoted = addressed = strength = 0.0
        for i in hits:
            term, distance = self.hit(tokens[i])
            is_stem, weight = self.terms[term][:2]
            before, after = tokens[max(0, i - CONTEXT) : i + 1], tokens[i : i + 1 + CONTEXT]
            near = {t.strip(MARKS).lower() for t in before + after}
            inside = any(t[0] in OPENING for t in before) and any(t.rstrip(".,;:!?")[-1:] in CLOSING for t in after)
            if inside or near & REPORTING:
                quoted += 1
                continue
            addressed += bool(near & ADDRESS)
            exact += distance == 0 and not is_stem
            stem += distance == 0 and is_stem
            wrong += distance > 0
            strength = max(strength, weight / (1 + distance))
        damp = lambda x: float(np.log1p(x))
        return [damp(exact), damp(stem), damp(wrong), damp(quoted), damp(addressed), damp(100 * (exact + stem + wrong) / (len(tokens) + 1)), strength]

    def score(self, text: str) -> float:
        z = float(np.dot(self.weights[:-1], self.features(text)) + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights and, last, the constant of a logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge * len(x) / 1000 + 1e-6)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(strings(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            words = {w for w in (t.strip(MARKS).lower() for t in text.split()) if 3 <= len(w) <= 40}
            stems = {w[:n] for w in words for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1)}
            counts.update((w, False, toxic) for w in words)
            counts.update((s, True, toxic) for s in stems)
    if counts:
        terms, stems, toxic = zip(*counts, strict=True)
        yield pa.RecordBatch.from_pydict({"term": list(terms), "stem": list(stems), "toxic": pa.array(toxic, pa.int32()), "n": list(counts.values())})


def learn_terms(sample: DataFrame) -> dict[str, tuple]:
    """Terms that mark toxic documents in a bounded ``sample`` (text, toxic).

    Words stay whether or not a stem begins them, as only words may be misspelled;
    of stems that begin each other the shortest stays.
    """
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.select("text", "toxic").mapInArrow(_word_counts, "term string, stem boolean, toxic int, n long")
    by_term = counts.groupBy("term", "stem").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q"))
    odds = ((F.col("p") + 0.5) / (pos + 1)) / ((F.col("q") + 0.5) / (neg + 1))
    top = by_term.filter(F.col("p") >= MIN_DOCS).withColumn("odds", odds).filter(F.col("odds") >= MIN_ODDS)
    rows = top.orderBy(F.desc("p"), "term", "stem").limit(MAX_TERMS).collect()
    terms: dict[str, tuple] = {}
    for r in sorted(rows, key=lambda r: (len(r.term), r.term, r.stem)):
        if not r.stem:
            terms[r.term] = (False, float(np.log(r.odds)))
        elif not any(terms.get(r.term[:n], (False,))[0] for n in range(STEM[0], len(r.term))):
            terms[r.term] = (True, float(np.log(r.odds)), *(["word"] if r.term in terms else []))
    return terms


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``text, toxic, part`` of at most ``size`` labelled rows of each class that are not held out, one for each id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for t in (0, 1)]
    chosen = stored(picked[0].union(picked[1]), "chosen")  # at most 2 * size rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # combined before the shuffle, so a frequent id is one row of a task
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row"))
    return stored(rows.select("row.text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).alias("part")), "labelled")


def _features(terms):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms.value)
        for batch in batches:
            rows = [scorer.features(t) for t in strings(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    return run


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[dict, np.ndarray]:
    """Lexicon and weights."""
    sample = labelled_sample(docs, labels, size)
    context, rows = docs.sparkSession.sparkContext, []
    for part in (0, 1):
        shared = context.broadcast(learn_terms(sample.filter(F.col("part") != part)))
        own = sample.filter(F.col("part") == part).select("text", "toxic")
        rows += own.mapInArrow(_features(shared), "x array<double>, toxic int").collect()
    terms = learn_terms(sample)
    y = np.array([r.toxic for r in rows], float)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        edge = min(max(share, 1e-9), 1 - 1e-9)
        return terms, np.array([0.0] * len(FEATURES) + [float(np.log(edge / (1 - edge)))])
    return terms, fit_logistic(np.array([r.x for r in rows]), y)


def _score(model, text_at: int):
    version = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_process("toxicity", lambda: Scorer(*model.value), version)
        for batch in batches:
            found = pa.array([scorer.score(t) for t in strings(batch.column(text_at))], pa.float64())
            columns = [c for i, c in enumerate(batch.columns) if i != text_at]
            names = [n for i, n in enumerate(batch.schema.names) if i != text_at]
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*names, "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, size))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", held_out().alias("held_out"), "text")
    found = rows.mapInArrow(_score(model, 2), "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _civil(model, text_at: int):
    version = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_process("toxicity", lambda: Scorer(*model.value), version)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in strings(batch.column(text_at))], pa.bool_()))

    return run


def civil(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with all their columns; nothing is shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, size))
    return docs.mapInArrow(_civil(model, docs.columns.index("text")), docs.schema)
