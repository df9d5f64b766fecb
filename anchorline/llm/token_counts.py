"""Token counts by byte-pair merging on a heap and a linked list, without making ids.

A piece of text starts as one symbol per byte. The adjacent pair of the lowest rank, the
leftmost first, is popped and merged until no pair has a rank. The count is the number of
bytes less the number of merges.
"""

from __future__ import annotations

import json
import re
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import Known, Memo, arrow_map, blocks, text_of

#: The fixed pattern that splits a text before merging, as the vocabulary's library has it.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space with the word after it: no split crosses its end, if all white space is plain.
UNITS = re.compile("[ \n\t]*[^ \n\t]+|[ \n\t]+")
#: White space that is not plain; texts with it are split as a whole.
ODD = re.compile("[\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")
#: What keeps a text from being counted word by word: white space beside other white space,
#: or at an end, or not plain.
UNEVEN = f"(?s) [ \n\t]|[\n\t] |^[ \n\t]|[ \n\t]$|{ODD.pattern}"
LIMIT = 1024
UNITS_KNOWN = 300_000
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where printable."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class MergeCounter:
    """Counts tokens of a text by the merges and special tokens of a tokenizer file."""

    def __init__(self, path: str, bound: int = UNITS_KNOWN):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.first = letters
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        signs = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]
        self.signs = sorted(signs, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.signs))) if signs else None
        self.split = regex.compile(SPLIT)
        self.pieces = Memo(self.merged, bound // 2)
        self.units = Memo(self.unit, bound // 2)
        self.known = Known(self.spaced, 3 * bound)

    def unit(self, unit: str) -> int:
        return sum(map(self.pieces.__getitem__, self.split.findall(unit)))

    def merged(self, piece: str) -> int:
        """Initial symbols less merges."""
        symbols = [self.first[b] for b in piece.encode("utf-8")]
        n = len(symbols)
        if n < 2:
            return n
        ranks = self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (rank, i, symbols[i], symbols[i + 1])
            for i in range(n - 1)
            if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None
        ]
        heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one side was merged meanwhile
            merges += 1
            symbols[i], symbols[j] = left + right, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                    heappush(heap, (rank, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
                heappush(heap, (rank, h, symbols[h], symbols[i]))
        return n - merges

    def count(self, text: str) -> int:
        """Special tokens inside a text count one each, as the library does by default."""
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.split_and_merge, parts))
        return self.split_and_merge(text)

    def split_and_merge(self, text: str) -> int:
        if ODD.search(text):
            return sum(map(self.pieces.__getitem__, self.split.findall(text)))
        return sum(map(self.units.__getitem__, UNITS.findall(text)))

    def spaced(self, words: pa.Array) -> list[int]:
        """Tokens of each word with a space before it."""
        return [self.split_and_merge(" " + w) for w in words.to_pylist()]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; distinct words between single spaces are counted once."""
        uneven = pc.match_substring_regex(texts, UNEVEN)
        for sign in self.signs:
            uneven = pc.or_(uneven, pc.match_substring(texts, sign))
        uneven = uneven.to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), np.int64)
        out[uneven] = [self.count(x) for x in texts.filter(pa.array(uneven)).to_pylist()]
        lists = pc.split_pattern(texts.filter(pa.array(~uneven)), " ")
        words = lists.flatten()
        if not len(words):
            return out
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = words.dictionary_encode()
        each = self.known(coded.dictionary)[coded.indices.to_numpy()]
        each[bounds[:-1]] = [self.units[x] if x else 0 for x in words.take(pa.array(bounds[:-1])).to_pylist()]
        out[~uneven] = np.add.reduceat(each, bounds[:-1])
        return out


@cache
def merge_counter(path: str) -> MergeCounter:
    """One per Python worker, so that later tasks know the words of earlier ones."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Per document its UTF-8 bytes, its tokens, and whether they are more than `limit`.

    A null text counts as empty: 0 bytes, 0 tokens. Null ids stay null, repeated rows repeat,
    an empty table gives no row. Columns other than `doc_id` and `text` are not read.
    """

    def rows(batches):
        counter = merge_counter(tokenizer)
        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            for a, b in blocks(text, 1 << 24):
                part = text.slice(a, b - a)
                counts = counter.counts(part)
                yield {
                    "doc_id": doc.slice(a, b - a),
                    "n_bytes": pc.cast(pc.binary_length(part), pa.int64()),
                    "n_tokens": counts,
                    "over_limit": counts > limit,
                }

    return arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")),
        COUNTS,
        rows,
    )
