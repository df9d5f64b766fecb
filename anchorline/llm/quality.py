"""Quality rules: base counts of a text, and how far its distributions lie from a language's.

A text has a histogram of character classes and one of common words. The references are the
same histograms of the corpus for each language. A text goes if its distance to
the nearest reference (Jensen-Shannon, base 2) is over a threshold that is wider for short
texts, whose histograms are rough.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import arrow_map, blocks, give_back, split_words, text_of

#: Signs counted as symbols, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

#: Frequent words of each language, most frequent first.
COMMON = {
    "en": "the of and to in a is that it was for on are as with this be by from he not or have at an",
    "fr": "de la le et les des en un du une que est pour qui dans par au sur pas plus avec ce il ne se",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero",
}
LANGUAGES = list(COMMON)
WORDS = sorted({w for words in COMMON.values() for w in words.split()})
LETTERS = ["lower", "upper", "digit", "space", "stop", "quote", "bracket", "symbol", "other"]
CLASSES = len(LETTERS)
#: A text is far from a reference beyond BASE + PER_ROOT / sqrt(n): n letters or words.
LETTER_LIMIT = (0.10, 2.6)
WORD_LIMIT = (0.30, 1.0)
#: Fewer words than this are not held against the word histogram.
GUARD_WORDS = 50

#: Bins of the shares of a class.
BINS = 400
TALLIES = "language int, item int, bin int, value double"
VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, letter_distance double, word_distance double, kept boolean"
)


@cache
def letter_classes() -> np.ndarray:
    """The class of every code point below 0x3000; those above are letters without case."""
    out = np.full(0x3000, LETTERS.index("other"), np.uint8)
    for code in range(0x3000):
        sign, kind = chr(code), unicodedata.category(chr(code))
        if sign in "\t\n\v\f\r " or kind == "Zs":
            name = "space"
        elif kind == "Lu" or kind == "Lt":
            name = "upper"
        elif kind[0] in "LM":
            name = "lower"
        elif kind[0] == "N":
            name = "digit"
        elif sign in ".,;:!?¿¡…-–—":
            name = "stop"
        elif sign in "'\"«»‘’“”„`":
            name = "quote"
        elif sign in "()[]{}":
            name = "bracket"
        elif kind[0] in "SP":
            name = "symbol"
        else:
            continue
        out[code] = LETTERS.index(name)
    return out


def letter_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = letter_classes()[np.minimum(codes, 0x2FFF)]
    classes[codes >= 0x3000] = LETTERS.index("lower")
    return np.bincount(classes, minlength=CLASSES)


def common_words(words: pa.Array) -> np.ndarray:
    """The place of each word in WORDS, by its lower-cased letters; else the place after."""
    bare = pc.utf8_lower(pc.utf8_trim(words, characters=".,;:!?\"'()«»“”¿¡|#*$%&<>"))
    found = pc.index_in(bare, pa.array(WORDS))
    return pc.fill_null(found, len(WORDS)).to_numpy()


def repeat_words(codes: np.ndarray, n_words: int) -> int:
    """Words in three-word windows that the text has twice or more."""
    if len(codes) < 3:
        return 0
    wide = codes.astype(np.int64)
    pairs = wide[:-1] * n_words + wide[1:]
    if n_words >= 1 << 20:  # three codes would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * n_words + wide[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(counts) == len(windows):
        return 0
    again = counts[inverse] > 1
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = Counter(text.split("\n"))
    if sum(lines.values()) == len(lines):
        return 0
    return sum(n - 1 for line, n in lines.items() if n > 1 and line.strip(" \t\n\v\f\r"))


def distances(rows: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of every row to every reference; empty rows give 1."""
    total = rows.sum(axis=1, keepdims=True)
    p = np.divide(rows, total, out=np.zeros(rows.shape), where=total > 0)
    out = np.empty((len(rows), len(references)))

    def entropy(x):
        return -np.sum(x * np.log2(np.where(x > 0, x, 1)), axis=-1)

    own = entropy(p)
    for i, q in enumerate(references):
        out[:, i] = entropy((p + q) / 2) - (own + entropy(q)) / 2
    return np.where(total > 0, np.sqrt(np.clip(out, 0, 1)), 1.0)


def _histograms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Per text its letters by class and its words by common word; and its words."""
    bounds, codes, words = split = split_words(texts)
    letters = np.array([letter_counts(t) for t in texts.to_pylist()]).reshape(-1, CLASSES)
    width = len(WORDS) + 1
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    common = common_words(words)[codes] if len(codes) else codes
    counts = np.bincount(row * width + common, minlength=len(texts) * width)
    return letters, counts.reshape(-1, width), split


def _languages(counts: np.ndarray) -> np.ndarray:
    """Per text the language most of its common words belong to, the first of equals; -1: none."""
    hits = np.stack(
        [counts[:, [WORDS.index(w) for w in set(COMMON[x].split())]].sum(axis=1) for x in COMMON],
        axis=1,
    )
    return np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), -1)


def tallies(texts: pa.Array) -> dict[tuple[int, int, int], float]:
    """What a block adds to the references, by language, item and bin.

    Items below CLASSES count texts by their share of that class, in bins of 1 / BINS; the
    others sum the shares of a common word, in bin 0.
    """
    letters, words, (bounds, _, _) = _histograms(texts)
    language = _languages(words)
    use = np.flatnonzero((np.diff(bounds) >= MIN_WORDS) & (language >= 0))
    language, letters, words = language[use], letters[use], words[use]
    out: dict[tuple[int, int, int], float] = {}
    bins = np.rint(BINS * letters / letters.sum(axis=1, keepdims=True)).astype(int)
    for item in range(CLASSES):
        for key, n in Counter(zip(language.tolist(), bins[:, item].tolist(), strict=True)).items():
            out[key[0], item, key[1]] = float(n)
    for i in np.unique(language).tolist():
        mine = words[language == i]
        for word, share in enumerate((mine / mine.sum(axis=1, keepdims=True)).sum(axis=0).tolist()):
            out[i, CLASSES + word, 0] = share
    return out


def references(docs: DataFrame) -> dict[str, np.ndarray]:
    """Per language with texts: the median share of each class, the mean share of each word.

    Medians keep the junk that the rule is to find out of the letters' reference. Tasks send
    at most len(LANGUAGES) * (CLASSES * BINS + words) rows each, and so does the sum.
    """

    def rows(batches):
        total: Counter = Counter()
        for batch in batches:
            for a, b in blocks(batch.column(0)):
                total.update(tallies(batch.column(0).slice(a, b - a)))
        keys = sorted(total)
        names = ("language", "item", "bin")
        yield {
            **{name: [k[i] for k in keys] for i, name in enumerate(names)},
            "value": [total[k] for k in keys],
        }

    found = (
        arrow_map(docs.select(text_of().alias("text")), TALLIES, rows)
        .groupBy("language", "item", "bin")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    languages = sorted({r["language"] for r in found})
    shares = np.zeros((len(languages), CLASSES, BINS + 1))
    words = np.zeros((len(languages), len(WORDS) + 1))
    for r in found:
        at = languages.index(r["language"])
        if r["item"] < CLASSES:
            shares[at, r["item"], r["bin"]] = r["value"]
        else:
            words[at, r["item"] - CLASSES] = r["value"]
    below = np.cumsum(shares, axis=2)
    letters = (2 * below >= below[:, :, -1:]).argmax(axis=2).astype(float)
    return {
        "letters": letters / np.maximum(letters.sum(axis=1, keepdims=True), 1),
        "words": words / np.maximum(words.sum(axis=1, keepdims=True), 1e-300),
    }


def judge(texts: pa.Array, against: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The columns of VERDICT for a block of texts."""
    letters, counts, (bounds, codes, words) = _histograms(texts)
    sizes = pc.utf8_length(words).to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes[codes] if len(codes) else [])])
    n_words = np.diff(bounds)
    plain = texts.to_pylist()
    n = len(words)
    repeat = np.array([repeat_words(codes[a:b], n) for a, b in pairwise(bounds.tolist())], np.int64)
    symbols = [pc.count_substring(texts, sign).to_numpy() for sign in SYMBOLS]
    base_failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * n_words)
    far = {}
    for name, rows in (("letters", letters), ("words", counts)):
        far[name] = (
            distances(rows, against[name]).min(axis=1)
            if len(against[name])
            else np.zeros(len(texts))
        )
    n_letters = np.maximum(letters.sum(axis=1), 1)
    too_far = far["letters"] > LETTER_LIMIT[0] + LETTER_LIMIT[1] / np.sqrt(n_letters)
    limit = WORD_LIMIT[0] + WORD_LIMIT[1] / np.sqrt(np.maximum(n_words, 1))
    too_far |= (n_words >= GUARD_WORDS) & (far["words"] > limit)
    return {
        "n_words": n_words,
        "word_chars": np.diff(ends[bounds]).astype(np.int64),
        "n_symbols": np.sum(symbols, axis=0).astype(np.int64),
        "n_dup_lines": np.array([dup_lines(t) for t in plain], np.int64),
        "n_repeat_words": repeat,
        "base_failed": base_failed,
        "letter_distance": far["letters"],
        "word_distance": far["words"],
        "kept": ~base_failed & ~too_far,
    }


def quality(docs: DataFrame, against: dict[str, np.ndarray] | None = None) -> DataFrame:
    """The verdict on every document: doc_id and the columns of VERDICT.

    Null and empty texts have no words, fail the base rule and go. Null ids stay null, repeated
    rows repeat, an empty table gives no row, and a corpus without any text of MIN_WORDS words
    has no reference to be far from. Other columns are not read.
    """
    against = references(docs) if against is None else against

    def rows(batches):
        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            for a, b in blocks(text):
                yield {"doc_id": doc.slice(a, b - a), **judge(text.slice(a, b - a), against)}

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return arrow_map(wanted, f"doc_id long, {VERDICT}", rows)


def keep_quality(docs: DataFrame, against: dict[str, np.ndarray] | None = None) -> DataFrame:
    """The documents that are kept, with all their columns as they were."""
    against = references(docs) if against is None else against
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            text = pc.fill_null(batch.column(at), "")
            for a, b in blocks(text):
                kept = judge(text.slice(a, b - a), against)["kept"]
                yield batch.slice(a, b - a).filter(pa.array(kept))
        give_back()

    return docs.mapInArrow(run, docs.schema)
