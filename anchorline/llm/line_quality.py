"""Quality by lines: a linear-chain conditional random field over a document's lines.

Every line is good or bad. A line's features, and those of the lines beside it, speak for one
or the other; transitions say how often quality changes from line to line. Forward-backward
gives each line's marginal, and the marginals, weighed by the lines' lengths, give the
document's score through a logistic curve.

Only documents are labelled. The field is fitted to lines with their document's label first;
then lines of bad documents that it holds to be good count as good, but for the longest run of
evidence, and it is fitted again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import arrow_map, blocks, split_words, text_of
from anchorline.llm.toxicity import held_out
from anchorline.sources.staging import Staging

#: Labelled rows of each class that the field is fitted on, at most, and the consecutive lines
#: taken of each. Scores read whole texts.
SAMPLE = 2000
LINES = 100
STEPS = 150
THRESHOLD = 0.3

#: Signs by kind.
SYMBOLS = b"#*$%&|<>"
SHOUTS = b"!?"

#: What is measured of a line. Shares are of its letters and signs, or of its words.
FEATURES = [
    "one", "length", "upper", "digit", "symbol", "shout", "sign", "blank", "foreign",
    "distinct", "adjacent", "seen", "few", "word_length", "ended", "capital", "marked", "stale",
]
#: Which of these the lines beside a line lend it.
NEIGHBOURS = [FEATURES.index(f) for f in ("upper", "symbol", "shout", "distinct", "adjacent", "seen", "marked")]
WIDTH = len(FEATURES) + 2 * len(NEIGHBOURS) + 2

SCORES = "doc_id long, score double, n_lines long, n_bad_lines long"


def byte_class(*groups: bytes) -> np.ndarray:
    """1 for the bytes of each group, by column; letters of one byte are ASCII."""
    out = np.zeros((256, len(groups)), np.int32)
    for i, group in enumerate(groups):
        out[list(group), i] = 1
    return out


UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
DIGIT, BLANK = bytes(range(48, 58)), b" \t\r\x0b\x0c"
SIGN = bytes(
    b for b in range(33, 127) if b not in UPPER + LOWER + DIGIT + SYMBOLS + SHOUTS
)
CLASSES = byte_class(UPPER, LOWER, DIGIT, SYMBOLS, SHOUTS, SIGN, BLANK, bytes(range(192, 256)))
MARKS = np.zeros(256, bool)
MARKS[list(SYMBOLS + SHOUTS)] = True


def lines_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text's lines that are not blank, and those lines."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    full = pc.binary_length(pc.ascii_trim_whitespace(lines)).to_numpy(zero_copy_only=False) > 0
    return np.concatenate([[0], np.cumsum(full)])[bounds], lines.filter(pa.array(full))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over runs from bounds[i] to bounds[i + 1]."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def line_features(bounds: np.ndarray, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row of FEATURES per line, and the line's length in characters."""
    n = len(lines)
    if not n:
        return np.zeros((0, len(FEATURES)), np.float32), np.zeros(0, np.int64)
    lines = pa.concat_arrays([lines])  # its own buffers, from offset 0
    offsets = np.frombuffer(lines.buffers()[1], np.int32, n + 1).astype(np.int64)
    data = np.frombuffer(lines.buffers()[2], np.uint8, offsets[-1])
    upper, lower, digit, symbol, shout, sign, blank, foreign = np.stack(
        [sums(CLASSES[:, i][data], offsets) for i in range(CLASSES.shape[1])]
    )
    size = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    some = np.maximum(size, 1)
    word_bounds, codes, words = split_words(lines)
    n_words = np.diff(word_bounds)
    line = np.repeat(np.arange(n), n_words)
    distinct = np.bincount(np.unique(line * max(len(words), 1) + codes) // max(len(words), 1), minlength=n)
    same = np.zeros(len(codes), np.int64)
    same[1:] = (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])
    last = pc.utf8_slice_codeunits(words, -1)
    marked = pc.is_in(last, pa.array([chr(b) for b in SYMBOLS + SHOUTS])).to_numpy(zero_copy_only=False)
    coded = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, first = np.unique(doc * n + coded, return_index=True)
    seen = np.ones(n)
    seen[first] = 0
    word = np.maximum(n_words, 1)
    variety = distinct / word
    out = np.stack(
        [
            np.ones(n), np.log1p(size) / 8, upper / np.maximum(upper + lower, 1), digit / some,
            symbol / some, shout / some, sign / some, blank / some, foreign / some, variety,
            sums(same, word_bounds) / word, seen, n_words <= 3, np.minimum(size / word / 10, 3),
            data[np.maximum(offsets[1:] - 1, 0)] == 46,
            np.isin(data[offsets[:-1]], list(UPPER)),
            sums(marked[codes].astype(np.int64), word_bounds) / word,
            np.maximum(0.5 - variety, 0) * 2,
        ],
        axis=1,
    )
    return out.astype(np.float32), size


def with_neighbours(rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features, those it is lent from both sides, and whether it is first or last."""
    n, own = len(rows), len(FEATURES)
    out = np.zeros((n, WIDTH), np.float32)
    out[:, :own] = rows
    some = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0] - 1
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[some[0]], last[some[1]] = True, True
    k = len(NEIGHBOURS)
    lent = rows[:, NEIGHBOURS]
    out[1:, own : own + k] = np.where(first[1:, None], 0, lent[:-1])
    out[:-1, own + k : own + 2 * k] = np.where(last[:-1, None], 0, lent[1:])
    out[:, -2], out[:, -1] = first, last
    return out


class Chains:
    """Chains of different lengths, laid out so that a step handles all that reach so far."""

    def __init__(self, bounds: np.ndarray):
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        self.starts = bounds[:-1][order]
        self.lengths = lengths[order]
        longest = int(self.lengths[0]) if len(order) else 0
        # How many chains have more than t lines.
        self.reach = np.searchsorted(-self.lengths, -np.arange(longest), side="left")

    def marginals(
        self, unary: np.ndarray, change: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of each line the probability of good, and summed probabilities of each transition.

        `unary` is the log odds that a line's features give; change[a, b] the weight of b
        after a. Messages are log odds too.
        """
        n, starts = len(unary), self.starts
        ahead, back = unary.copy(), np.zeros(n)
        for t in range(1, len(self.reach)):
            at = starts[: self.reach[t]] + t
            m = ahead[at - 1]
            ahead[at] += np.logaddexp(m + change[1, 1], change[0, 1]) - np.logaddexp(
                m + change[1, 0], change[0, 0]
            )
        for t in range(len(self.reach) - 1, 0, -1):
            at = starts[: self.reach[t]] + t
            z = unary[at] + back[at]
            back[at - 1] = np.logaddexp(z + change[1, 1], change[1, 0]) - np.logaddexp(
                z + change[0, 1], change[0, 0]
            )
        later = np.concatenate(
            [np.array([], np.int64)]
            + [starts[: self.reach[t]] + t for t in range(1, len(self.reach))]
        )
        m, z = ahead[later - 1], unary[later] + back[later]
        four = np.stack([np.full(len(later), change[0, 0]), change[0, 1] + z, change[1, 0] + m, change[1, 1] + m + z])
        four = np.exp(four - four.max(axis=0)) if len(later) else four
        pairs = (four / four.sum(axis=0)).sum(axis=1).reshape(2, 2) if len(later) else np.zeros((2, 2))
        return sigmoid(ahead + back), pairs


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass(frozen=True)
class Field:
    """Weights of a line's features, of transitions, and of the document's logistic curve."""

    line: np.ndarray
    change: np.ndarray
    curve: tuple[float, float] = (0.0, 1.0)

    def marginals(self, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Each line's probability to be good. Sums go feature by feature: a line's does not
        depend on how many others there are."""
        unary = np.zeros(len(rows))
        for column, weight in zip(with_neighbours(rows, bounds).T, self.line, strict=True):
            unary += column * float(weight)
        return Chains(bounds).marginals(unary, self.change)[0]

    def scores(self, marginals: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return sigmoid(self.curve[0] + self.curve[1] * odds(weighed(marginals, size, bounds)))


def weighed(marginals: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of each document's marginals, by the lengths of its lines; 0 without a line."""
    some = np.diff(bounds) > 0
    out = np.zeros(len(bounds) - 1)
    if some.any():
        starts = bounds[:-1][some]
        out[some] = np.add.reduceat(marginals * size, starts) / np.add.reduceat(size, starts)
    return out


def odds(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 0.005, 0.995)
    return np.log(share / (1 - share))


def fit_field(
    rows: np.ndarray, bounds: np.ndarray, good: np.ndarray, weight: np.ndarray, steps: int = STEPS
) -> Field:
    """Weights that make the labels likeliest, by gradient steps of adapted size.

    `weight` is that of each document, so that the classes weigh the same.
    """
    x = with_neighbours(rows, bounds)
    chains, doc = Chains(bounds), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    w, labels = weight[doc], good.astype(float)
    w /= w.sum()
    first = np.zeros(len(labels), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    later = np.flatnonzero(~first)
    wanted = np.zeros((2, 2))
    np.add.at(wanted, (good[later - 1].astype(int), good[later].astype(int)), 1.0)
    total = max(len(later), 1)
    theta = np.zeros(WIDTH + 4)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        p, pairs = chains.marginals((x @ theta[:WIDTH].astype(np.float32)).astype(float), theta[WIDTH:].reshape(2, 2))
        gradient = np.concatenate([x.T @ (w * (labels - p)), ((wanted - pairs) / total).ravel()])
        gradient -= 1e-4 * theta
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        theta += 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:WIDTH].astype(np.float32), theta[WIDTH:].reshape(2, 2))


def fit_curve(x: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve of one variable, the classes weighing the same, never falling."""
    rows = np.stack([np.ones(len(x)), x], axis=1)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    w = np.zeros(2)
    penalty = np.diag([1e-3, 1.0])
    for _ in range(30):
        p = sigmoid(rows @ w)
        curve = (rows.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ rows + penalty
        w += np.linalg.solve(curve, rows.T @ (weight * (labels - p)) - penalty @ w)
    return float(w[0]), max(float(w[1]), 1e-3)


def fit(samples: list[tuple[int, np.ndarray, np.ndarray]]) -> Field | None:
    """A field from documents' labels, line features and line lengths; none without both
    classes. Documents without a line teach nothing."""
    samples = [x for x in samples if len(x[1])]
    labels = np.array([x[0] for x in samples], int)
    if len(set(labels.tolist())) < 2:
        return None
    rows = np.concatenate([x[1] for x in samples])
    size = np.concatenate([x[2] for x in samples])
    bounds = np.concatenate([[0], np.cumsum([len(x[1]) for x in samples])])
    doc = np.repeat(np.arange(len(labels)), np.diff(bounds))
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / np.diff(bounds)
    good = labels[doc] == 1
    field = fit_field(rows, bounds, good, weight)
    p = field.marginals(rows, bounds)
    # In bad documents the lines held to be good are, the worst of each document excepted.
    evidence = size * (1 - p)
    worst = np.maximum.reduceat(evidence, bounds[:-1])[doc] == evidence
    good |= (p > 0.5) & ~worst
    field = fit_field(rows, bounds, good, weight)
    share = weighed(field.marginals(rows, bounds), size, bounds)
    return Field(field.line, field.change, fit_curve(odds(share), labels.astype(float)))


def sample(docs: DataFrame, labels: DataFrame, staging: Staging) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Label, line features and line lengths of up to SAMPLE rows of each class, none held out.

    Ids are chosen by the order of a hash, rows by the order of a hash of their text; an id
    that is labelled both ways is left out. The chosen ids, two times SAMPLE at most, go to
    every task. A row brings LINES consecutive lines at most, from a place that its hash gives.
    """
    clear = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where(F.col("quality") == F.col("most"))
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = [clear.where(F.col("quality") == x).orderBy(*order).limit(SAMPLE) for x in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    chosen = texts.join(F.broadcast(ids[0].union(ids[1])), "doc_id").select(
        "quality", F.xxhash64("text").alias("place"), "text"
    )

    def rows(batches):
        for batch in batches:
            label, place, text = batch.columns
            for a, b in blocks(text):
                bounds, lines = lines_of(text.slice(a, b - a))
                found, size = line_features(bounds, lines)
                starts, ends = bounds[:-1], bounds[1:]
                spare = np.maximum(ends - starts - LINES, 0)
                starts = starts + np.abs(place.slice(a, b - a).to_numpy() % (spare + 1))
                cuts = list(zip(starts.tolist(), np.minimum(starts + LINES, ends).tolist(), strict=True))
                yield {
                    "quality": label.slice(a, b - a),
                    "place": place.slice(a, b - a),
                    "found": [found[x:y].astype("<f4").tobytes() for x, y in cuts],
                    "size": [size[x:y].astype("<i8").tobytes() for x, y in cuts],
                }

    schema = "quality int, place long, found binary, size binary"
    rows_ = staging.table(arrow_map(chosen, schema, rows), "sample")
    out = []
    for label in (0, 1):
        for r in rows_.where(F.col("quality") == label).orderBy("place", "found").limit(SAMPLE).collect():
            found = np.frombuffer(r["found"], "<f4").reshape(-1, len(FEATURES))
            out.append((label, found, np.frombuffer(r["size"], "<i8")))
    return out


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """Every document's score and its lines, all and bad ones; without a field 0."""

    def rows(batches):
        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            for a, b in blocks(text):
                bounds, lines = lines_of(text.slice(a, b - a))
                n = np.diff(bounds)
                scores, bad = np.zeros(b - a), np.zeros(b - a, np.int64)
                if field:
                    found, size = line_features(bounds, lines)
                    p = field.marginals(found, bounds)
                    scores = np.where(n > 0, field.scores(p, size, bounds), 0.0)
                    bad = sums((p < 0.5).astype(np.int64), bounds)
                yield {
                    "doc_id": doc.slice(a, b - a),
                    "score": scores,
                    "n_lines": n,
                    "n_bad_lines": bad,
                }

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return arrow_map(wanted, SCORES, rows)


def line_quality(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """Per document doc_id, held_out, score, predicted, n_lines, n_bad_lines.

    Scores depend on the text alone; lines are what \\n separates, blank ones left out. Texts
    that are null, empty or blank have no line and score 0. Labels that are null, other than 0
    and 1, held out, contradictory or of no document teach nothing; if a class then lacks
    documents with lines, every score is 0. Null ids stay null, repeated rows repeat, an empty
    table gives no row. Other columns are not read.
    """
    scored = score(docs, fit(sample(docs, labels, staging)))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_lines",
        "n_bad_lines",
    )
