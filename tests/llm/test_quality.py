import re
from collections import Counter

import pytest
from llm_rows import ODD, documents

from anchorline.llm import quality
from conftest import SMALL


def base(text):
    """The base counts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


BASE = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()


def test_base_counts_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.quality(docs).collect():
        assert tuple(r[c] for c in BASE) == base(texts[r.doc_id])


def test_odd_rows(spark):
    got = quality.quality(documents(spark, ODD, extra=True)).collect()
    assert len(got) == len(ODD)
    wanted = Counter((i, *base(t)) for i, t in ODD)
    assert Counter((r.doc_id, *(r[c] for c in BASE)) for r in got) == wanted
    assert not any(r.kept for r in got if r.base_failed)


def test_empty_table(spark):
    assert quality.quality(documents(spark, [])).count() == 0
    assert quality.keep_quality(documents(spark, [])).count() == 0


def test_distance_is_jensen_shannon():
    import numpy as np

    rows = np.array([[1, 1, 0], [0, 0, 4], [2, 2, 0], [0, 0, 0]], float)
    got = quality.distances(rows, np.array([[0.5, 0.5, 0.0]]))[:, 0]
    assert got == pytest.approx([0, 1, 0, 1])


PROSE = (
    "the river of the town is in the valley and it was for the people that are on the hill "
    "with this house by the road from a place he had not seen or known at an hour as that "
)


def test_junk_goes_and_prose_stays(spark):
    def prose(i):
        words = PROSE.split()
        return " ".join(f"{w} x{chr(97 + (i * k) % 26)}y" for k, w in enumerate(words)) + "."

    clean = [(i, prose(i)) for i in range(60)]
    junk = [
        (100, " ".join(w + "$$$" for w in prose(3).split())),
        (101, prose(5).upper().replace(" ", "!! ")),
        (102, prose(7).replace(" ", " | ")),
    ]
    docs = documents(spark, clean + junk, extra=True)
    kept = {r.doc_id for r in quality.keep_quality(docs).collect()}
    assert kept == {i for i, _ in clean}
    assert quality.keep_quality(docs).columns == docs.columns


def test_labelled_quality(spark):
    """Junk by the labels is rejected, and no document that they call good but by the base."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality IS NOT NULL")
    got = quality.quality(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    rows = got.select("quality", "kept", "base_failed").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)
