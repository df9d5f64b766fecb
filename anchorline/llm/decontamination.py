"""Benchmark passages in documents, found by windows of a template with typed placeholders.

Numbers, units and names become placeholders, so that a question with other numbers or names
has the windows of the original. Windows of five words are joined by hash. The values behind
the placeholders must correspond: within one occurrence every value of the benchmark item
stands for one value of the document, and the other way round. Verbatim copies are found by
literal windows too: five lower-cased words without placeholders, whatever they are, or all
words of a text that has fewer.

Items too short or too full of numbers for windows, but of one sentence, are looked for among the
documents' sentences: the words themselves, or the skeleton with placeholders, signs included.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import Known, arrow_map, blocks, row_key, split_words, text_of
from anchorline.llm.near_dedup import EDGES, mix
from anchorline.sources.staging import Staging

WORDS = 5
#: Fewer words of a template window than this in plain text say nothing.
PLAIN = 3
#: An item is found where this share of its windows matches, or so many in a row.
COVERAGE = 0.5
RUN = 9
#: Sentences of so many words are compared by their words.
SHORT = range(3, 5)
#: Skeletons have so many plain words and so many placeholders at least.
SKELETON = 2
#: Slots of the filter of benchmark windows. Its size is fixed; a full filter lets all pass.
FILTER = 1 << 23

#: Words for numbers and units.
NUMBER_WORDS = set(
    "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty "
    "sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = set(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams "
    "kilogram kilograms lb lbs pound pounds oz ounce ounces ml cl l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years hz khz mhz ghz w kw mw j kj v a kb mb gb tb bit bits byte bytes "
    "dollar dollars cent cents euro euros usd eur gbp percent % kmh mph degree degrees "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters".split()
)
_NUMBER = re.compile(r"\d+(?:[.,:/]\d+)*")
_WITH_UNIT = re.compile(r"(\d+(?:[.,:/]\d+)*)([^\W\d]+)")
_PLAIN, _NUM, _UNIT, _BOTH, _NAME = range(5)
_TYPE, _CAPITAL, _ENDS = 3, 4, 8

KEY = ["doc_id", "key_a", "key_b"]
COUNTS = "n_windows long, n_plain long"
SENTENCE = (
    "n_windows long, n_plain long, whole boolean, family int, hash_a long, hash_b long, "
    "slots array<long>"
)
WINDOW = "place long, rank long, hash_a long, hash_b long, slots array<long>"


def ends_sentence(raw: str) -> bool:
    return raw.rstrip("\"'»”’)]")[-1:] in (".", "!", "?", ":", "…")


def sign_values(words: pa.Array) -> np.ndarray:
    """A hash of each word of signs alone, and whether it ends a sentence; 0 for others."""
    out = []
    for raw in words.to_pylist():
        if raw.strip(EDGES):
            out.append(0)
        else:
            flags = _ENDS if ends_sentence(raw) else 0
            out.append((xxhash.xxh3_64_intdigest(raw) | 1 << 63) & ~15 | flags)
    return np.array(out, np.uint64).view(np.int64)


def word_values(words: pa.Array) -> np.ndarray:
    """60 bits of each word's hash, its type, and whether it is capital or ends a sentence.

    Words are taken lower-cased and without signs at their ends; 0 where nothing is left.
    """
    out = []
    for raw in words.to_pylist():
        core = raw.strip(EDGES)
        word = core.lower()
        if not word:
            out.append(0)
            continue
        if _NUMBER.fullmatch(word) or word in NUMBER_WORDS:
            kind = _NUM
        elif word in UNITS:
            kind = _UNIT
        elif (m := _WITH_UNIT.fullmatch(word)) and m[2] in UNITS:
            kind = _BOTH
        else:
            kind = _PLAIN
        flags = kind
        if kind == _PLAIN and len(core) > 1 and core[0].isupper():
            flags |= _CAPITAL
        if ends_sentence(raw):
            flags |= _ENDS
        out.append((xxhash.xxh3_64_intdigest(word) | 1 << 63) & ~15 | flags)
    return np.array(out, np.uint64).view(np.int64)


def typed(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The type of each word where it stands, its own hash, and that of it or its placeholder."""
    kind = (values & np.uint64(_TYPE)).astype(np.int64)
    first = np.zeros(len(values), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    ends = np.roll((values & np.uint64(_ENDS)) != 0, 1) | first
    kind[(kind == _UNIT) & ((np.roll(kind, 1) != _NUM) | first)] = _PLAIN
    kind[((values & np.uint64(_CAPITAL)) != 0) & ~ends] = _NAME
    literal = mix(values >> np.uint64(4))
    return kind, literal, np.where(kind == _PLAIN, literal, mix(kind.astype(np.uint64)))


def passes(wanted: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's slot is set in the filter; all pass without one."""
    if wanted is None:
        return np.ones(len(hashes), bool)
    at = hashes & np.uint64(FILTER - 1)
    return (wanted[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def template_windows(texts: pa.Array, known: Known, wanted: np.ndarray | None):
    """Text, place, rank, two hashes and slot values of each window whose slot in `wanted` is set.

    Also the numbers of literal and of template windows of each text. Windows of fewer than
    PLAIN plain words are no template windows; the rank counts those that are, so that runs
    pass over the others. Literal windows have no slots and the rank -1.
    """
    bounds, codes, words = split_words(texts)
    values = known(words).view(np.uint64)[codes] if len(codes) else np.array([], np.uint64)
    full = values != 0
    bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
    values = values[full]
    n = len(values)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    kind, literal, signs = typed(values, bounds)
    slot = kind != _PLAIN
    count = max(n - WORDS + 1, 0)
    hash_a = np.zeros(count, np.uint64)
    hash_b = np.ones(count, np.uint64)
    plain = np.zeros(count, np.int64)
    for k in range(WORDS):
        hash_a = mix(hash_a ^ signs[k : k + count])
        hash_b = mix(hash_b + signs[k : k + count])
        plain += ~slot[k : k + count]
    whole = (doc[:count] == doc[n - count :]) & (plain >= PLAIN)
    n_plain = np.bincount(doc[:count][whole], minlength=len(texts))
    rank = np.cumsum(whole) - 1 - (np.cumsum(n_plain) - n_plain)[doc[:count]]
    left = bounds[1:][doc] - np.arange(n)  # words from here to the text's end
    size = np.diff(bounds)[doc]
    exact = (left >= WORDS) | ((size < WORDS) & (left == size))
    n_windows = np.bincount(doc[exact], minlength=len(texts))
    padded = np.concatenate([literal, np.zeros(WORDS, np.uint64)])
    exact_a, exact_b = np.full(n, 2, np.uint64), np.full(n, 3, np.uint64)
    for k in range(WORDS):
        word = np.where(left > k, padded[k : k + n], np.uint64(0))
        exact_a = mix(exact_a ^ word)
        exact_b = mix(exact_b + word)

    def passing(here: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return np.flatnonzero(here & passes(wanted, hashes))

    at, too = passing(whole, hash_a), passing(exact, exact_a)
    slots = [
        literal[i : i + WORDS][slot[i : i + WORDS]].view(np.int64).tolist() for i in at.tolist()
    ] + [[]] * len(too)
    rank = np.concatenate([rank[at], np.full(len(too), -1)])
    hash_a = np.concatenate([hash_a[at], exact_a[too]])
    hash_b = np.concatenate([hash_b[at], exact_b[too]])
    at = np.concatenate([at, too])
    return doc[at], at - bounds[doc[at]], rank, hash_a, hash_b, slots, n_windows, n_plain


def sentence_rows(
    texts: pa.Array, known: Known, marks: Known, wanted: np.ndarray | None
) -> dict[str, np.ndarray | list]:
    """Per sentence by its words (family 0, sentences of SHORT words) and by its skeleton (family
    1): its text's number, whether it is all of the text, two hashes, and the slots' values.

    Also the numbers of literal and of template windows that the text has.
    """
    bounds, codes, words = split_words(texts)
    if not len(codes):
        return {}
    values, marked = (k(words).view(np.uint64)[codes] for k in (known, marks))
    n = len(values)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    full = values != 0
    inner = np.concatenate([[0], np.cumsum(full)])
    kind, literal, signs = typed(values[full], inner[bounds])
    start = np.zeros(n, bool)
    start[bounds[:-1][np.diff(bounds) > 0]] = True
    start[1:] |= ((values | marked)[:-1] & np.uint64(_ENDS)) != 0
    starts = np.flatnonzero(start)
    sentence = np.cumsum(start) - 1
    slot, every = np.zeros(n, bool), mix(marked)
    slot[full] = kind != _PLAIN
    every[full] = signs
    plain = np.add.reduceat((full & ~slot).astype(np.int64), starts)
    slots = np.add.reduceat(slot.astype(np.int64), starts)
    own = np.zeros(n, np.uint64)
    own[full] = literal

    def hashed(sign: np.ndarray, place: np.ndarray, here: np.ndarray, seed: int) -> np.ndarray:
        parts = mix(sign ^ mix(place.astype(np.uint64) * np.uint64(4) + np.uint64(seed)))
        return np.add.reduceat(np.where(here, parts, np.uint64(0)), starts)

    among_words = inner[:-1] - inner[starts][sentence]
    # A sign that stands alone is part of a skeleton, unless it ends the sentence.
    shown = full | ((marked & np.uint64(_ENDS)) == 0)
    before = np.concatenate([[0], np.cumsum(shown)])
    among_all = before[:-1] - before[starts][sentence]
    n_words = np.diff(inner[bounds])
    literal_windows = np.where(n_words < WORDS, np.minimum(n_words, 1), n_words - WORDS + 1)
    count = max(int(full.sum()) - WORDS + 1, 0)
    five = np.zeros(count, np.int64)
    words_doc = doc[full]
    for k in range(WORDS):
        five += (kind == _PLAIN)[k : k + count]
    template = (words_doc[:count] == words_doc[len(words_doc) - count :]) & (five >= PLAIN)
    n_plain = np.bincount(words_doc[:count][template], minlength=len(texts))
    out: dict[str, list] = {}
    for family, (sign, place, here, wide) in enumerate((
        (own, among_words, full, np.isin(plain + slots, SHORT)),
        (every, among_all, shown, (plain >= SKELETON) & (slots >= SKELETON)),
    )):
        a, b = (hashed(sign, place, here, 2 * family + i) for i in (0, 1))
        at = np.flatnonzero(wide & passes(wanted, a))
        ends = np.append(starts, n)
        text = doc[starts[at]]
        part = {
            "text": text, "n_windows": literal_windows[text], "n_plain": n_plain[text],
            "whole": (plain + slots)[at] == n_words[text],
            "family": np.full(len(at), family, np.int32),
            "hash_a": a[at].view(np.int64), "hash_b": b[at].view(np.int64),
            "slots": [
                own[i:j][slot[i:j]].view(np.int64).tolist() if family else []
                for i, j in zip(ends[at].tolist(), ends[at + 1].tolist(), strict=True)
            ],
        }
        for name, column in part.items():
            out.setdefault(name, []).append(column)
    return {k: sum(v, []) if k == "slots" else np.concatenate(v) for k, v in out.items()}


def sentences(df: DataFrame, columns: list[str], wanted: np.ndarray | None = None) -> DataFrame:
    """`columns` of each row and one row per sentence whose hash is in `wanted`."""

    def rows(batches):
        known, marks = Known(word_values), Known(sign_values)
        for batch in batches:
            text = batch.column(len(columns))
            for a, b in blocks(text):
                found = sentence_rows(text.slice(a, b - a), known, marks, wanted)
                if found:
                    take = pa.array(found.pop("text") + a)
                    yield {**{c: batch.column(i).take(take) for i, c in enumerate(columns)}, **found}

    kinds = dict(df.dtypes)
    head = ", ".join(f"{c} {kinds[c]}" for c in columns)
    return arrow_map(df.select(*columns, "text"), f"{head}, {SENTENCE}", rows)


def windows(df: DataFrame, columns: list[str], wanted: np.ndarray | None = None) -> DataFrame:
    """`columns` of each row, the numbers of its windows, and one row per window."""

    def rows(batches):
        known = Known(word_values)
        for batch in batches:
            text = batch.column(len(columns))
            for a, b in blocks(text):
                found = template_windows(text.slice(a, b - a), known, wanted)
                row, place, rank, hash_a, hash_b, slots, n_windows, n_plain = found
                take = pa.array(row + a)
                yield {
                    **{c: batch.column(i).take(take) for i, c in enumerate(columns)},
                    "n_windows": n_windows[row],
                    "n_plain": n_plain[row],
                    "place": place,
                    "rank": rank,
                    "hash_a": hash_a.view(np.int64),
                    "hash_b": hash_b.view(np.int64),
                    "slots": slots,
                }

    kinds = dict(df.dtypes)
    head = ", ".join(f"{c} {kinds[c]}" for c in columns)
    return arrow_map(df.select(*columns, "text"), f"{head}, {COUNTS}, {WINDOW}", rows)


def slot_filter(items: DataFrame) -> np.ndarray:
    """One bit per slot that a benchmark window falls on: FILTER / 8 bytes, whatever its size."""
    slots = items.select(F.col("hash_a").bitwiseAND(FILTER - 1).cast("int").alias("slot")).distinct()
    bits = np.zeros(FILTER // 8, np.uint8)
    at = np.array([r[0] for r in slots.toLocalIterator()], np.int64)
    np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    return bits


def _longest(places: Column) -> Column:
    """The longest run of successive numbers in a sorted array."""
    start = F.struct(F.lit(-2).cast("long").alias("last"), F.lit(0).alias("n"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        n = F.when(x == s["last"] + 1, s["n"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), n.alias("n"), F.greatest(s["best"], n).alias("best"))

    return F.aggregate(places, start, step, lambda s: s["best"].cast("long"))


def same_sentences(keyed: DataFrame, benchmark: DataFrame, staging: Staging) -> DataFrame | None:
    """Items of one sentence that windows do not reach, in documents that have that sentence:
    the same three or four words, or the same skeleton with slots one to one. None where the
    benchmark has no such item.
    """
    one = sentences(benchmark, ["item_id"]).where("whole AND (family = 0 OR n_plain = 0)")
    items = staging.table(
        one.withColumnRenamed("slots", "item_slots").drop("whole", "n_plain"), "short_items"
    )
    wanted = slot_filter(items)
    if not wanted.any():
        return None
    found = sentences(keyed, KEY, wanted).drop("n_windows", "n_plain", "whole")
    met = staging.table(found, "sentences").join(items, ["family", "hash_a", "hash_b"])
    values = F.array_distinct(F.arrays_zip("item_slots", "slots"))
    one_to_one = (F.size(values) == F.size(F.array_distinct("item_slots"))) & (
        F.size(values) == F.size(F.array_distinct("slots"))
    )
    return met.where(one_to_one).select(
        *KEY, "item_id", "n_windows", *[F.col("n_windows").alias(c) for c in ("n_matched", "longest_run")]
    )


def matches(docs: DataFrame, benchmark: DataFrame, staging: Staging) -> DataFrame:
    """Documents' keys and the items found in them, with how much of each item matched."""
    benchmark = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")
    )
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *row_key(text_of()), text_of().alias("text")
    )
    found = by_windows(keyed, benchmark, staging)
    short = same_sentences(keyed, benchmark, staging)
    if short is None:
        return found
    return (
        found.unionByName(short)
        .groupBy(*KEY, "item_id", "n_windows")
        .agg(F.max("n_matched").alias("n_matched"), F.max("longest_run").alias("longest_run"))
    )


def by_windows(keyed: DataFrame, benchmark: DataFrame, staging: Staging) -> DataFrame:
    """The same for items that windows find."""
    items = staging.table(
        windows(benchmark, ["item_id"]).withColumnsRenamed(
            {"place": "item_place", "slots": "item_slots"}
        ),
        "items",
    )
    found = staging.table(windows(keyed, KEY, slot_filter(items)).drop("n_windows", "n_plain", "rank"), "found")
    met = found.join(items, ["hash_a", "hash_b"])
    ranked = F.col("rank") >= 0
    # One occurrence lies at one distance from the item; it has no more windows than the item.
    occurrence = met.groupBy(
        *KEY, "item_id", "n_windows", "n_plain", (F.col("place") - F.col("item_place")).alias("shift")
    ).agg(
        F.collect_set(F.when(F.size("slots") == 0, F.col("item_place"))).alias("plain"),
        F.collect_set("item_place").alias("places"),
        F.collect_set(F.when((F.size("slots") == 0) & ranked, F.col("rank"))).alias("plain_ranks"),
        F.collect_set(F.when(ranked, F.col("rank"))).alias("ranks"),
        F.array_distinct(
            F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))
        ).alias("values"),
    )
    one_to_one = (F.size("values") == F.size(F.array_distinct("values.item_slots"))) & (
        F.size("values") == F.size(F.array_distinct("values.slots"))
    )
    places = F.array_sort(F.when(one_to_one, F.col("places")).otherwise(F.col("plain")))
    ranks = F.array_sort(F.when(one_to_one, F.col("ranks")).otherwise(F.col("plain_ranks")))
    item = ["item_id", "n_windows", "n_plain"]

    def distinct(column: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(column)))).cast("long")

    return (
        occurrence.select(*KEY, *item, places.alias("places"), ranks.alias("ranks"))
        .groupBy(*KEY, *item)
        .agg(
            distinct("places").alias("n_matched"),
            distinct("ranks").alias("n_ranked"),
            F.max(F.greatest(_longest(F.col("places")), _longest(F.col("ranks")))).alias("longest_run"),
        )
        .where(
            (F.col("n_matched") >= COVERAGE * F.col("n_windows"))
            | ((F.col("n_ranked") > 0) & (F.col("n_ranked") >= COVERAGE * F.col("n_plain")))
            | (F.col("longest_run") >= RUN)
        )
        .select(*KEY, "item_id", "n_windows", "n_matched", "longest_run")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, staging: Staging) -> DataFrame:
    """Documents that hold benchmark items: doc_id, item_id, n_windows, n_matched, longest_run.

    Null texts are empty and match nothing. An item of three or four words is found in texts
    that have it as a sentence, of fewer in texts of the same words alone. One with fewer than
    three plain words in every five is found where its words are literally the same or, if it
    is one sentence, where a sentence has its skeleton; then all its windows count as matched.
    n_windows counts all windows of an item, n_matched those
    that a template or a literal window matches. Items of the same words are all found.
    Rows equal in id and text count as one document; null ids stay null. An empty table on either side gives no row. Columns other than the ids and texts are not read.
    """
    return matches(docs, benchmark, staging).select(
        "doc_id", "item_id", "n_windows", "n_matched", "longest_run"
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, staging: Staging) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    bad = matches(docs, benchmark, staging).select(*KEY).distinct()
    bad = staging.table(bad.withColumnsRenamed({k: f"bad_{k}" for k in KEY}), "bad")
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        *row_key(text_of()),
    )
    match = [F.col(k).eqNullSafe(F.col(f"bad_{k}")) for k in KEY]
    return keyed.join(bad, match, "left_anti").select("row.*")
