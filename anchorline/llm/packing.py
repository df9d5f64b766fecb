"""Concatenate and cut: documents' token ids packed into fixed windows.

Pass one tokenises and stages, per document, its ids and the ids before it in its partition.
Pass two adds up the partitions' totals (one row per partition, so their prefix sums are
taken on the driver) and cuts every document by its own global offset. No row is shuffled.
"""

from __future__ import annotations

import string
import zlib
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import arrow_map, blocks, split_words, text_of
from anchorline.sources.staging import Staging

WINDOW = 4096
END = 2
#: Bytes of text tokenised at a time.
BLOCK = 1 << 23
#: Words whose ids a Python worker remembers.
WORDS = 1_000_000
#: Signs that form a token of their own after a word. An apostrophe may not: it starts endings.
TAIL = string.punctuation.replace("'", "")

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
STAGED = "doc_id long, part int, before long, n_tokens long, ids binary"


class WordIds:
    """Ids of texts by a tokenizer file, word by word; equal to encoding whole texts.

    The tokenizer drops white space and no token crosses it, so each distinct word between
    ASCII white space is encoded once and remembered, up to `bound` words. Letters with
    trailing signs have the ids of the letters, then those of the signs. New runs of letters
    are encoded many to a call, and the ids cut after each token that ends a word.
    """

    def __init__(self, path: str, bound: int = WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("the vocabulary does not fit 16 bits")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = pa.array([], pa.string())
        self.ids = np.array([], np.uint16)
        self.counts = np.array([], np.int64)
        self.bound = bound

    def raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        ids, counts = [np.array([], np.uint16)], []
        for at in range(0, len(texts), 2048):
            found = self.tokenizer.encode_batch_fast(texts[at : at + 2048], add_special_tokens=False)
            ids += [np.array(e.ids, np.uint16) for e in found]
            counts += [len(x) for x in ids[-len(found) :]]
        return np.concatenate(ids), np.array(counts, np.int64)

    def runs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, each one run of letters to the tokenizer."""
        ids, counts = [np.array([], np.uint16)], [np.array([], np.int64)]
        for at in range(0, len(words), 2048):
            block = words[at : at + 2048]
            found, _ = self.raw([" ".join(block)])
            cuts = np.flatnonzero(self.ends[found]) + 1
            lengths = np.diff(cuts, prepend=0)
            if len(cuts) != len(block):
                found, lengths = self.raw(block)
            ids.append(found)
            counts.append(lengths)
        return np.concatenate(ids), np.concatenate(counts)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for distinct words: those of letters and signs from two distinct parts."""
        stems = pc.utf8_rtrim(words, characters=TAIL)
        stems = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems)
        alpha = pc.utf8_is_alpha(stems).to_numpy(zero_copy_only=False)
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy()
        coded = stems.filter(pa.array(alpha)).dictionary_encode()
        run_ids, run_counts = self.runs(coded.dictionary.to_pylist())
        first = np.zeros(len(words), np.int64)
        second = np.full(len(words), -1, np.int64)
        first[alpha] = coded.indices.to_numpy()
        rest: dict[str, int] = {}
        for n in np.unique(cut[alpha]).tolist() if alpha.any() else []:
            if n:
                where = np.flatnonzero(alpha & (cut == n))
                tails = pc.utf8_slice_codeunits(words.take(pa.array(where)), start=-n)
                second[where] = [rest.setdefault(t, len(rest)) for t in tails.to_pylist()]
        odd = words.filter(pa.array(~alpha)).to_pylist()
        first[~alpha] = len(run_counts) + len(rest) + np.arange(len(odd))
        second[second >= 0] += len(run_counts)
        rest_ids, rest_counts = self.raw([*rest, *odd])
        parts = np.stack([first, second], axis=1).ravel()
        parts = parts[parts >= 0]
        counts = np.concatenate([run_counts, rest_counts])
        ids = gather(np.concatenate([run_ids, rest_ids]), counts, parts)
        totals = counts[first] + np.where(second >= 0, counts[second], 0)
        return ids, totals

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """16-bit ids of each text."""
        bounds, codes, words = split_words(texts)
        place = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = words.take(pa.array(new))
        ids, counts = self.encode_words(fresh)
        place[new] = len(self.known) + np.arange(len(new))
        ids, counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        room = min(len(new), self.bound - len(self.known))
        if room > 0:
            self.known = pa.concat_arrays([self.known, fresh.slice(0, room)])
            self.counts = counts[: len(self.known)]
            self.ids = ids[: self.counts.sum()]
        place = place[codes]
        ends = np.concatenate([[0], np.cumsum(counts[place])])[bounds]
        ids = gather(ids, counts, place)
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


@cache
def word_ids(path: str) -> WordIds:
    """One per Python worker, so that later tasks know the words of earlier ones."""
    return WordIds(path)


def gather(values: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Runs of `values`, the i-th of lengths[i], in the order of `wanted`, put together."""
    starts, sizes = (np.cumsum(lengths) - lengths)[wanted], lengths[wanted]
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())]


def tokenised(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Per document its ids, ended by `end`, its partition and the ids before it there."""

    def rows(batches):
        words, part, before = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        mark = np.array([end], np.uint16)
        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            for a, b in blocks(text, BLOCK):
                ids = [np.append(x, mark) for x in words.encode(text.slice(a, b - a))]
                counts = [len(x) for x in ids]
                starts = list(accumulate(counts, initial=before))
                before = starts.pop()
                yield {
                    "doc_id": doc.slice(a, b - a),
                    "part": [part] * len(ids),
                    "before": starts,
                    "n_tokens": counts,
                    "ids": [x.astype("<u2").tobytes() for x in ids],
                }

    return arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")),
        STAGED,
        rows,
    )


def cut(staged: DataFrame, base: dict[int, int], window: int = WINDOW) -> DataFrame:
    """Each document's pieces: it lies at base of its partition plus the ids before it."""

    def rows(batches):
        for batch in batches:
            out = {k: [] for k in "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()}
            doc, part, before, counts, ids = (batch.column(i).to_pylist() for i in range(5))
            for d, p, at, n, x in zip(doc, part, before, counts, ids, strict=True):
                wide = memoryview(np.frombuffer(x, "<u2").astype("<u4")).cast("B")
                place, done = base[p] + at, 0
                while done < n:
                    sequence, offset = divmod(place + done, window)
                    length = min(window - offset, n - done)
                    out["doc_id"].append(d)
                    out["start"].append(done)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(wide[4 * done : 4 * (done + length)]))
                    out["doc_tokens"].append(n)
                    out["sequence_id"].append(sequence)
                    out["offset"].append(offset)
                    done += length
            yield out

    return arrow_map(staged, PIECES, rows)


def pack(
    docs: DataFrame, tokenizer: str, staging: Staging, window: int = WINDOW, end: int = END
) -> DataFrame:
    """All documents, concatenated and cut into windows: one row per piece.

    Null and empty texts give one piece, the end mark alone. Null ids stay null; rows that
    repeat are packed as often as they occur. An empty table gives no piece. Columns other
    than `doc_id` and `text` are not read.
    """
    staged = staging.table(tokenised(docs, tokenizer, end), "tokens")
    totals = staged.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    totals = sorted((r["part"], r["n"]) for r in totals)
    base = dict(
        zip((p for p, _ in totals), accumulate((n for _, n in totals), initial=0), strict=False)
    )
    return cut(staged, base, window)
