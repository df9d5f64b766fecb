import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from llm_rows import ODD, documents, table
from tokenizers import Tokenizer

from anchorline.llm import alignment
from conftest import SMALL

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
STRANGE = [
    "", " ", "a  b", "  x\n\n y <|endoftext|> z", "\x1c a  b\t\tc ", "don't I'LL we've  ",
    "\r\n x;\r\n y", "日本 語", "a\n b\n\n  c   ", "12 3four #$ %% x", "<s> </s> <unk> <0x41>", "a▁b",
    "a ▁ b", "ﬁ é é \x00 x", "\n\nx", "\tx\n", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20,
    "end ", "end\n", "\xa0 y 　z", "🙂🙂 x🙃y", "▁", "x" * 5000 + "é" * 3000, "the cat", "the cat",
]


def by_hand(rows):
    """Every link of every document, spelt out."""
    a_lib = Tokenizer.from_file(A_PATH)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = {}
    spare = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            letters[chr(byte)] = byte
        else:
            letters[chr(spare)] = byte
            spare += 1
    found, held = [], Counter()
    for _, text in rows:
        text = text or ""
        encoded = a_lib.encode(" " + text, add_special_tokens=False)
        a = list(zip(encoded.ids, [bytes(letters[x] for x in t) for t in encoded.tokens], strict=True))
        b = []
        for i in b_lib.encode(text):
            piece = b_lib.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
            found.append(([], [], []))
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side in (0, 1):
            for (i, _), g in zip((a, b)[side], np.searchsorted(cuts, ends[side]), strict=True):
                groups[g][side].append(i)
        found.append(([i for i, _ in a], [i for i, _ in b], groups))
        held.update({(x, y) for xs, ys in groups for x in xs for y in ys})
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for (doc_id, _), (a, b, groups) in zip(rows, found, strict=True):
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(links),
            sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 1 << 22])
def test_rows_are_those_spelt_out(spark, staging, monkeypatch, block):
    rows = [(i, t) for i, t in enumerate(STRANGE)]
    rows += [(100 + i, r[0]) for i, r in enumerate(
        spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(60).collect()
    )]
    if block == 1:  # every text a block of its own, few words known
        monkeypatch.setattr(alignment, "blocks", lambda texts, _: [(i, i + 1) for i in range(len(texts))])
        coder = alignment.Encoder(A_PATH, B_PATH, 5)
        found = [alignment.align_block(coder, pa.array([t])) for _, t in rows]
        wanted = {r[0]: r for r in by_hand(rows)}
        for (i, _), x in zip(rows, found, strict=True):
            got = (i, *(int(x[k][0]) for k in ("n_a", "n_b", "n_groups", "n_links")))
            assert (*got, x["groups_sha256"][0]) == (*wanted[i][:5], wanted[i][7])
        return
    got = alignment.align(documents(spark, rows).repartition(3), A_PATH, B_PATH, staging)
    assert table(got) == by_hand(rows)


def test_odd_rows(spark, staging):
    got = alignment.align(documents(spark, ODD, extra=True), A_PATH, B_PATH, staging)
    assert table(got) == by_hand(ODD)


def test_empty_tables_and_tables_without_tokens(spark, staging):
    assert alignment.align(documents(spark, []), A_PATH, B_PATH, staging).count() == 0
    got = alignment.align(documents(spark, [(1, None), (2, "▁")]), A_PATH, B_PATH, staging)
    assert table(got) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_groups_end_where_both_sides_end():
    random = np.random.default_rng(5)
    for _ in range(300):
        ends, bounds = ([], []), ([0], [0])
        start = 0
        for _ in range(random.integers(1, 5)):  # texts, some of them empty
            size = int(random.integers(0, 60))
            for side in (0, 1):
                if size:
                    inner = random.choice(size - 1, random.integers(0, size), replace=False) + 1 if size > 1 else []
                    ends[side].extend(sorted(start + x for x in {*map(int, inner), size}))
                bounds[side].append(len(ends[side]))
            start += size
        a, b = (np.array(x, np.int64) for x in ends)
        a_last, b_last = alignment.shared_groups(a, b, *map(np.array, bounds))
        assert a[a_last].tolist() == b[b_last].tolist() == sorted(set(ends[0]) & set(ends[1]))


def test_wide_groups_are_linked_by_distinct_ids(monkeypatch):
    ids = [np.array([3, 3, 4, 5, 3], np.int32), np.array([7, 8, 7, 7], np.int32)]
    last = [np.array([3, 4]), np.array([2, 3])]

    def total():
        out = Counter()
        for g, pair, n in zip(*alignment.links(ids, last, 100), strict=True):
            out[int(g), int(pair)] += int(n)
        return out

    plain = total()
    monkeypatch.setattr(alignment, "WIDE", 2)
    assert total() == plain
    assert sum(plain.values()) == 4 * 3 + 1
