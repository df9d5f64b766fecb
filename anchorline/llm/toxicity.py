"""Toxicity: a learned lexicon, matched with misspellings, weighed by the words around.

Terms are whole words and word beginnings that occur in toxic texts in many contexts and
hardly in others, counted over a bounded sample of labelled documents. A word is matched by
running it through the Levenshtein automata of all terms at once: a walk over the lexicon's
trie whose states are sets of (node, edits), made deterministic as words need them. Every
hit gets the score of its window, which tells quotation from abuse; a logistic model of the
sums, fitted on the same sample, gives the document's score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import Known, arrow_map, blocks, row_key, split_words, text_of
from anchorline.llm.near_dedup import EDGES
from anchorline.sources.staging import Staging

#: Labelled rows of each class that the lexicon and the model are learned from, at most.
SAMPLE = 3000
#: Prefixes that can be terms, by length.
PREFIXES = range(4, 11)
#: Toxic texts of different wording that a term has at least, and how much larger its share of
#: them is than of other texts.
MIN_TEXTS = 6
MIN_RATIO = 30.0
#: Whole words of so many letters match with one edit, or two.
ONE_EDIT, TWO_EDITS = 5, 9
WINDOW = 6

#: Signs that stand for letters, words of address, words of report, quote marks.
SIGNS = str.maketrans("013457@$!", "oieastasi")
ADDRESS = set(
    "you your you're youre yourself u ur tu te toi vous votre du dich dir dein deine ihr euch "
    "eres usted ustedes tú ti".split()
)
REPORT = set(
    "said says say wrote writes called calls quote quoted quoting word term slur dit écrit mot "
    "appelé sagte sagt schrieb wort genannt zitat dijo dice escribió palabra llamó cita".split()
)
QUOTES = "\"“”„«»"

#: Sums of hits by kind, the share of abuse in percent, and whether there is any of a kind.
FEATURES = ["abuse", "misspelt", "quoted", "density", "any_abuse", "any_misspelt"]
SCORES = "doc_id long, score double, n_hits long"


def bare(word: str) -> str:
    """Lower-cased, without signs at the ends; signs between letters read as letters."""
    word = word.lower().strip(EDGES)
    return word.translate(SIGNS) if not word.isalpha() and re.search(r"[^\W\d]", word) else word


class Automaton:
    """Terms within their edits: whole words, and beginnings (terms without `$`) exactly.

    The first letter has to be right. States are worked out when a word first needs them.
    """

    def __init__(self, terms: list[str], ordinary: frozenset[str] = frozenset()):
        self.terms, self.ordinary = terms, ordinary
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.begin: dict[int, int] = {}
        self.room = [0]  # most edits of any term below
        for i, term in enumerate(terms):
            word, edits = term.removesuffix("$"), self.edits(term)
            node = 0
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                node = self.children[node][letter]
                self.room[node] = max(self.room[node], edits)
            (self.whole if term.endswith("$") else self.begin)[node] = i
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.results: list[tuple[int, int] | None] = []
        self.start = self.state(frozenset([(0, 0)]))

    @staticmethod
    def edits(term: str) -> int:
        n = len(term) - 1 if term.endswith("$") else 0
        return 2 if n >= TWO_EDITS else 1 if n >= ONE_EDIT else 0

    def state(self, found: frozenset) -> int:
        if found not in self.numbers:
            self.numbers[found] = len(self.states)
            self.states.append(found)
            self.moves.append({})
            ends = [
                (e, self.whole[n])
                for n, e in found
                if n in self.whole and e <= self.edits(self.terms[self.whole[n]])
            ]
            ends += [(0, self.begin[n]) for n, e in found if n in self.begin and e == 0]
            self.results.append(min(ends)[::-1] if ends else None)
        return self.numbers[found]

    def move(self, at: int, letter: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.states[at]:
            if node in self.begin and e == 0:
                out.add((node, 0))  # a beginning stays matched
            child = self.children[node].get(letter)
            if child is not None:
                out.add((child, e))
            if node and e < self.room[node]:
                out.add((node, e + 1))  # a letter too many
                for other in self.children[node].values():
                    if e < self.room[other]:
                        out.add((other, e + 1))  # another letter
        todo = list(out)
        while todo:  # letters left out
            node, e = todo.pop()
            for other in self.children[node].values() if node else ():
                if e < self.room[other] and (other, e + 1) not in out:
                    out.add((other, e + 1))
                    todo.append((other, e + 1))
        return self.state(frozenset(out))

    def find(self, word: str) -> tuple[int, int] | None:
        """The term and the edits of the nearest match. Ordinary words are no misspellings."""
        at, moves, states = self.start, self.moves, self.states
        for letter in word:
            to = moves[at].get(letter)
            if to is None:
                to = moves[at][letter] = self.move(at, letter)
            at = to
            if not states[at]:
                return None
        found = self.results[at]
        return None if found and found[1] and word in self.ordinary else found

    def values(self, words: pa.Array) -> np.ndarray:
        """0 for no match, else 1 plus four times the term plus the edits."""
        found = (self.find(bare(raw)) for raw in words.to_pylist())
        return np.array([0 if x is None else 1 + 4 * x[0] + x[1] for x in found], np.int64)


def window_score(words: list[str], at: int) -> tuple[float, bool]:
    """How much a hit counts, and whether it is quoted: in quote marks, or near a report."""
    a = max(0, at - WINDOW)
    before, after = words[a:at], words[at + 1 : at + 1 + WINDOW]
    hit = words[at]
    opened = sum(w.count(q) for w in before for q in QUOTES) + sum(
        hit[: len(hit) // 2].count(q) for q in QUOTES
    )
    closed = any(q in w for w in [hit[len(hit) // 2 :], *after] for q in QUOTES)
    near = {bare(w) for w in before[-3:] + after[:3]}
    around = {bare(w) for w in before + after}
    quoted = (opened % 2 == 1 and closed) or bool(near & REPORT)
    return (1.5 if around & ADDRESS else 1.0), quoted


def features(
    texts: pa.Array, known: Known, strengths: list[float]
) -> tuple[np.ndarray, np.ndarray]:
    """The columns of FEATURES per text, and its hits. A hit counts as its term's strength."""
    bounds, codes, words = split_words(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    hits = np.zeros(len(texts), np.int64)
    if not len(codes):
        return out, hits
    values = known(words)[codes]
    places = np.flatnonzero(values)
    docs = np.searchsorted(bounds, places, side="right") - 1
    for place, doc in zip(places.tolist(), docs.tolist(), strict=True):
        start, stop = max(int(bounds[doc]), place - WINDOW), min(int(bounds[doc + 1]), place + WINDOW + 1)
        near = words.take(pa.array(codes[start:stop])).to_pylist()
        weight, quoted = window_score(near, place - start)
        term, edits = divmod(int(values[place]) - 1, 4)
        column = 2 if quoted else 1 if edits else 0
        out[doc, column] += weight * strengths[term]
        if not quoted:
            out[doc, 4 + column] = max(out[doc, 4 + column], strengths[term])
        hits[doc] += 1
    size = np.maximum(np.diff(bounds), 1)
    out[:, 3] = np.minimum(100 * out[:, 0] / size, 10)
    out[:, :3] = np.log1p(out[:, :3])
    return out, hits


@dataclass(frozen=True)
class Model:
    terms: list[str]
    strengths: list[float]
    ordinary: frozenset[str]
    weights: list[float]

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = self.weights[0] + rows @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """Up to SAMPLE labelled rows of each class by the order of a hash, none held out.

    An id that is labelled both ways is left out. The ids, two times SAMPLE at most, are
    small enough to go to every task, so documents are read where they lie. Should ids stand
    for more rows than that, the rows are chosen by their hashes; equal rows count once.
    """
    clear = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where(F.col("toxic") == F.col("most"))
        .select("doc_id", "toxic")
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = [clear.where(F.col("toxic") == x).orderBy(*order).limit(SAMPLE) for x in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = texts.join(F.broadcast(ids[0].union(ids[1])), "doc_id")
    found = staging.table(found.select("*", *row_key(F.col("text"))), "labelled")
    key = ["toxic", "key_a", "key_b", "doc_id"]
    rows = [
        found.where(F.col("toxic") == x).select(key).distinct().orderBy(*key).limit(SAMPLE)
        for x in (0, 1)
    ]
    chosen = found.join(F.broadcast(rows[0].union(rows[1])), key, "left_semi")
    return chosen.dropDuplicates(key).select("text", "toxic")


def entries(word: str) -> list[str]:
    """What of a word could be a term."""
    if len(word) < PREFIXES[0] or not word.isalpha():
        return []
    return [word[:n] for n in PREFIXES if n <= len(word)] + [word + "$"]


def contexts(texts: DataFrame) -> DataFrame:
    """Entries of words of letters, and the words on both sides where a text first has them.

    One context of each text, so that neither a long text nor copies of one count twice.
    """

    def rows(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = ["", *map(bare, text.split()), ""]
                found: dict[str, int] = {}
                for i in range(1, len(words) - 1):
                    new = [e for e in entries(words[i]) if e not in found]
                    if new:
                        around = f"{words[i - 1]} {words[i + 1]}"
                        found.update(dict.fromkeys(new, xxhash.xxh3_64_intdigest(around) >> 1))
                yield {"entry": list(found), "context": list(found.values())}

    return arrow_map(texts.select("text"), "entry string, context long", rows).distinct()


def telling_entries(
    toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int
) -> tuple[dict[str, int], dict[str, int]]:
    """Contexts in toxic and in clean texts of every entry of MIN_TEXTS and MIN_RATIO.

    Both are counted and held against each other in Spark; the entries that pass are collected.
    """

    def counted(texts: DataFrame, name: str) -> DataFrame:
        return contexts(texts).groupBy("entry").agg(F.count(F.lit(1)).alias(name))

    share = (F.col("seen") / n_toxic) / ((F.col("elsewhere") + 0.5) / n_clean)
    rows = (
        counted(toxic, "seen")
        .where(F.col("seen") >= MIN_TEXTS)
        .join(counted(clean, "elsewhere"), "entry", "left")
        .fillna(0, ["elsewhere"])
        .where(share >= MIN_RATIO)
        .collect()
    )
    return {r["entry"]: r["seen"] for r in rows}, {r["entry"]: r["elsewhere"] for r in rows}


def choose_terms(
    toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int
) -> dict[str, float]:
    """Entries of MIN_RATIO, and of a chain of longer and longer ones that which keeps the
    hits of the shorter. Each with its strength, 0 to 1: the logarithm of the ratio that is
    left when chance is allowed for, over that of the strongest."""

    def ratio(e: str, doubt: float = 0.0) -> float:
        seen = max(toxic[e] - doubt * math.sqrt(toxic[e]), 0.1)
        return (seen / n_toxic) / ((clean.get(e, 0) + 0.5 + doubt) / n_clean)

    sure = {e for e in toxic if ratio(e) >= MIN_RATIO}
    out: list[str] = []
    for e in sorted(sure, key=lambda e: (len(e.removesuffix("$")), e.endswith("$"))):
        word = e.removesuffix("$")
        shorter = [word[:n] for n in PREFIXES if n < len(word) or (n == len(word) and e != word)]
        shorter = [s for s in shorter if s in out]
        if all(toxic[e] >= 0.9 * toxic[s] for s in shorter):
            out = [x for x in out if x not in shorter] + [e]
    sound = {e: max(math.log(ratio(e, 1.0)), 0.0) for e in sorted(out)}
    most = max(sound.values(), default=0.0) or 1.0
    return {e: x / most for e, x in sound.items()}


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Logistic regression by Newton's method, the two classes weighing the same."""
    x = np.hstack([np.ones((len(rows), 1)), rows])
    w = np.zeros(x.shape[1])
    share = max(labels.mean(), 1e-9), max(1 - labels.mean(), 1e-9)
    weight = np.where(labels == 1, 0.5 / share[0], 0.5 / share[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - labels)) + penalty @ w
        w -= np.linalg.solve((x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + penalty, gradient)
    w[1:] = np.maximum(w[1:], 0)  # a hit is never a sign of harmlessness
    # Misspellings and quotations are rare in a sample. A misspelling says what a plain hit
    # says, as ordinary words near a term are no hits; a quoted hit says little.
    w[2], w[6] = max(w[2], w[1]), max(w[6], w[5])
    w[3] = min(w[3], w[1] / 4)
    return w.tolist()


def train(docs: DataFrame, labels: DataFrame, staging: Staging) -> Model | None:
    """Lexicon and weights from the sample; none if it lacks one of the classes.

    The lexicon comes from two thirds of the texts and the weights from the others, on which
    its terms have not been chosen; from all where that leaves either without a class.
    """
    third = (F.xxhash64("text") % 3 == 0).alias("for_weights")
    texts = staging.table(sample(docs, labels, staging).select("text", "toxic", third), "sample")
    sizes = {
        (r["for_weights"], r["toxic"]): r["count"]
        for r in texts.groupBy("for_weights", "toxic").count().collect()
    }
    if {t for _, t in sizes} != {0, 1}:
        return None
    parted = len(sizes) == 4
    learn = texts.where("NOT for_weights") if parted else texts
    weigh = texts.where("for_weights") if parted else texts
    toxic, clean = learn.where("toxic = 1"), learn.where("toxic = 0")

    def size(label: int) -> int:
        return sum(n for (w, t), n in sizes.items() if t == label and not (parted and w))

    counts = telling_entries(toxic, clean, size(1), size(0))
    chosen = choose_terms(*counts, size(1), size(0))
    terms, strengths = list(chosen), list(chosen.values())

    def near_words(batches):
        automaton = Automaton(terms)
        for batch in batches:
            words = split_words(batch.column(0))[2].to_pylist()
            found = {w for w in map(bare, words) if (x := automaton.find(w)) and x[1]}
            yield {"word": list(found)}

    ordinary = arrow_map(clean.select("text"), "word string", near_words).distinct()
    ordinary = frozenset(r[0] for r in ordinary.collect())

    def feature_rows(batches):
        known = Known(Automaton(terms, ordinary).values)
        for batch in batches:
            rows, _ = features(batch.column(0), known, strengths)
            yield {"label": batch.column(1).cast(pa.int32()), "row": rows.tolist()}

    rows = arrow_map(
        weigh.select("text", F.col("toxic").cast("int").alias("toxic")),
        "label int, row array<double>",
        feature_rows,
    ).collect()
    found = np.array([r["row"] for r in rows])
    weights = fit(found, np.array([r["label"] for r in rows], float))
    return Model(terms, strengths, ordinary, weights)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every document's score; without a model 0."""

    def rows(batches):
        known = Known(Automaton(model.terms, model.ordinary).values) if model else None
        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            for a, b in blocks(text):
                if model:
                    found, hits = features(text.slice(a, b - a), known, model.strengths)
                    scores = model.score(found)
                else:
                    scores, hits = np.zeros(b - a), np.zeros(b - a, np.int64)
                yield {"doc_id": doc.slice(a, b - a), "score": scores, "n_hits": hits}

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return arrow_map(wanted, SCORES, rows)


def toxicity(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """Per document doc_id, held_out, score, predicted, n_hits.

    Scores depend on the text alone. Null and empty texts have no hit and the score of that.
    Labels that are null, other than 0 and 1, held out, contradictory or of no document teach
    nothing; if a class then lacks documents, every score is 0. Null ids stay null, repeated
    rows repeat, an empty table gives no row. Other columns are not read.
    """
    scored = score(docs, train(docs, labels, staging))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_hits",
    )
