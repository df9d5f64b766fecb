import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_rows import ODD, documents, table
from tokenizers import Tokenizer

from anchorline.llm import packing, token_counts
from conftest import SMALL

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
STRANGE = [
    "", " ", "a  b", "  x\n\n y <|endoftext|> z", "\x1c a  b\t\tc ", "don't I'LL we've  ",
    "\r\n x", "日本 語", "a\n b\n\n  c   ", "12 3four #$ %% x", "ªº Élan, ÉCOLE.. 'll ... x'll.",
    "ΑΣ ΣΑΣ. İx", "a<|endoftext|>b <|startoftext|>", "A ́b é ñ, Ǆ ﬁ",
    "x\x0b\x0cy", "a\xa0b c​d", "a\xa0 \n x", "a b\n", "\x85 a", "　x", "!!! ..., 'S",
]


def sample_texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()
    return STRANGE + [r[0] for r in rows]


def test_ids_are_the_librarys(spark):
    texts = sample_texts(spark)
    wanted = Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)
    for bound in (10, 2_000_000):
        found = packing.WordIds(WORDS, bound)
        for _ in range(2):
            got = found.encode(pa.array(texts))
            assert [x.tolist() for x in got] == [x.ids for x in wanted]


def test_counts_are_the_librarys(spark):
    texts = sample_texts(spark)
    wanted = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    counter = token_counts.MergeCounter(BYTES, 50)
    for _ in range(2):
        assert counter.counts(pa.array(texts)).tolist() == [len(x.ids) for x in wanted]
    assert [counter.count(x) for x in texts] == [len(x.ids) for x in wanted]


def test_merges_take_the_lowest_rank_leftmost():
    counter = token_counts.MergeCounter(BYTES)
    library = Tokenizer.from_file(BYTES)
    for piece in ("aaaaaaa", "abababab", " thethethe", "zzzzzzzzzzzzzzzz", "é" * 9, "x"):
        assert counter.merged(piece) == len(library.encode(piece, add_special_tokens=False).ids)


def check_pieces(rows, docs, window):
    """Pieces cut every document's ids, gaplessly, and fill all sequences but the last."""
    library = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    for number, found in by_sequence.items():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or number == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("window", [7, 4096])
def test_pieces_cover_all_ids_once(spark, staging, window):
    docs = [(i, t) for i, t in enumerate(sample_texts(spark))] + [(9999, None)]
    frame = documents(spark, docs).repartition(5)
    check_pieces(packing.pack(frame, WORDS, staging, window).collect(), docs, window)


def test_packing_of_odd_rows(spark, staging):
    pieces = packing.pack(documents(spark, ODD, extra=True), WORDS, staging)
    found = pieces.where("start = 0").collect()
    assert len(found) == len(ODD)
    assert sum(r.doc_tokens == 1 for r in found) == 4  # null, empty and blank texts
    total = sum(r.length for r in pieces.collect())
    assert total == sum(r.doc_tokens for r in found)


def test_counts_of_odd_rows(spark):
    got = token_counts.token_counts(documents(spark, ODD, extra=True), BYTES)
    library = Tokenizer.from_file(BYTES)
    wanted = []
    for doc_id, text in ODD:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert table(got) == sorted(wanted, key=repr)


def test_empty_tables(spark, staging):
    none = documents(spark, [])
    assert packing.pack(none, WORDS, staging).count() == 0
    assert token_counts.token_counts(none, BYTES).count() == 0
