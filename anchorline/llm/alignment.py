"""Alignment of two tokenizers: divide and conquer at shared cuts, and links by count.

Both tokenizers' tokens cover the same bytes. An interval of tokens is cut at a common end near
its middle, found by bisecting the other side's ends, and both halves likewise, until an
interval has no common end inside: a group. All intervals of a block of texts go through each
level of the recursion together.

Tokens of a group are linked with each other. How many documents hold a pair of ids linked is
counted by Spark: a block gives each of its pairs once, with the documents of the block that
hold it, and gets the corpus's counts back for these pairs alone.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import arrow_map, blocks, text_of
from anchorline.llm.packing import gather
from anchorline.llm.token_counts import ODD, byte_letters
from anchorline.sources.staging import Staging

#: Bytes of text aligned at a time.
BLOCK = 1 << 22
#: Words whose ids a Python worker remembers.
WORDS = 400_000
#: Groups of more possible links are linked by distinct ids.
WIDE = 1 << 12

#: One row per block: its documents' columns, and its distinct pairs with their documents.
STAGED = (
    "doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups_sha256 array<string>, pairs_of binary, place binary, "
    "times binary, pair array<long>, docs array<long>"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)
#: Texts with white space at their end, or other than this, are taken whole.
WHOLE = rf"[ \n\t]\z|{ODD.pattern}"


class Encoder:
    """Ids of texts by two tokenizer files, and the bytes of each id.

    Texts are cut before white space that follows other signs, where neither tokenizer has a
    token across; distinct pieces are encoded once and remembered, up to `bound`. Where a
    vocabulary does not allow that, texts are encoded whole.
    """

    def __init__(self, bytes_path: str, pieces_path: str, bound: int = WORDS):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bytes_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        values = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            if all(x in values for x in token):
                self.a_bytes[i] = bytes(values[x] for x in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)])
            if self.b.is_byte(i)
            else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        across = re.compile("[^▁]▁|[\n\t]")
        self.cuts = not any(across.search(p) for p in pieces)
        self.space = pieces.index("▁") if "▁" in pieces else -1
        self.lengths = [
            np.array([len(x) for x in known], np.int32) for known in (self.a_bytes, self.b_bytes)
        ]
        self.bound = bound
        self.known = pa.array([], pa.string())
        self.ids = [np.array([], np.int32), np.array([], np.int32)]
        self.sizes = [np.array([], np.int64), np.array([], np.int64)]

    def one_by_one(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides, and how many each piece has: none where bytes are not the piece's.

        Pieces begin with white space. A space is the one that the second tokenizer adds; before
        another sign it adds one that is taken off.
        """
        ids = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        found = self.b.encode([p.removeprefix(" ") for p in pieces], num_threads=1)
        out, sizes = [[], []], [np.zeros(len(pieces), np.int64) for _ in "ab"]
        for i, (piece, a, b) in enumerate(zip(pieces, ids, found, strict=True)):
            if not piece.startswith(" ") and b[:1] == [self.space]:
                b = b[1:]
            if self.joined(self.a_bytes, a) == piece.encode() == self.joined(self.b_bytes, b):
                out[0] += a
                out[1] += b
                sizes[0][i], sizes[1][i] = len(a), len(b)
        return [np.array(x, np.int32) for x in out], sizes

    @staticmethod
    def joined(known: list[bytes], ids: list[int]) -> bytes:
        return b"".join(map(known.__getitem__, ids))

    def together(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]] | None:
        """The same by one call for all pieces, told apart by their bytes; none if that fails."""
        text = " x" + "".join(pieces)
        found = [
            self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids,
            self.b.encode(text[1:], num_threads=1),
        ]
        wanted = text.encode()
        if self.joined(self.a_bytes, found[0]) != wanted or self.joined(self.b_bytes, found[1]) != wanted:
            return None
        cuts = np.cumsum([2, *(len(x.encode()) for x in pieces)])
        found = [np.array(x, np.int32) for x in found]
        ends = [np.cumsum(n[x]) for n, x in zip(self.lengths, found, strict=True)]
        places = [np.searchsorted(end, cuts) for end in ends]
        if not all((end[p] == cuts).all() for end, p in zip(ends, places, strict=True)):
            return None
        return [x[p[0] + 1 :] for x, p in zip(found, places, strict=True)], [np.diff(p) for p in places]

    def encode_pieces(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The same for many pieces: those cut at plain white space many to a call."""
        whole = re.compile(WHOLE.replace(r"\z", r"\Z"))
        odd = np.array([not self.cuts or bool(whole.search(p)) for p in pieces], bool)
        parts = []
        for group, at_once in ((np.flatnonzero(odd), None), (np.flatnonzero(~odd), self.together)):
            for at in range(0, len(group), 1024):
                where = group[at : at + 1024]
                part = [pieces[i] for i in where]
                parts.append((where, (at_once and at_once(part)) or self.one_by_one(part)))
        if not parts:
            return [np.array([], np.int32)] * 2, [np.array([], np.int64)] * 2
        order = np.argsort(np.concatenate([where for where, _ in parts]))
        ids = [np.concatenate([found[0][i] for _, found in parts]) for i in (0, 1)]
        sizes = [np.concatenate([found[1][i] for _, found in parts]) for i in (0, 1)]
        if odd.any() and not odd.all():
            ids = [gather(x, n, order) for x, n in zip(ids, sizes, strict=True)]
            sizes = [n[order] for n in sizes]
        return ids, sizes

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Where each text's pieces start in the array of all pieces, each with white space
        before it, as an array over the texts' own bytes."""
        texts = pc.binary_join_element_wise("", texts, " ")
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
        data = np.frombuffer(texts.buffers()[2], np.uint8)
        first, last = int(offsets[0]), int(offsets[-1])
        blank = np.isin(data[first:last], [9, 10, 32])
        starts = blank.copy()
        starts[1:] &= ~blank[:-1]
        whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        if not self.cuts:
            whole[:] = True
        for i in np.flatnonzero(whole):
            starts[offsets[i] - first : offsets[i + 1] - first] = False
        starts[offsets[:-1] - first] = True
        cuts = np.flatnonzero(starts) + first
        bounds = np.searchsorted(cuts, offsets)
        cuts = np.append(cuts, last).astype(np.int32)
        pieces = pa.StringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts.tobytes()), texts.buffers()[2]
        )
        return bounds, pieces

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each side all ids, and the number of each text. Texts that are empty, or whose
        bytes a side does not give back, have none on either side."""
        bounds, pieces = self.split(texts)
        coded = pieces.dictionary_encode()
        words = coded.dictionary
        place = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = words.take(pa.array(new))
        found, counts = self.encode_pieces(fresh.to_pylist())
        place[new] = len(self.known) + np.arange(len(new))
        ids = [np.concatenate(x) for x in zip(self.ids, found, strict=True)]
        sizes = [np.concatenate(x) for x in zip(self.sizes, counts, strict=True)]
        room = min(len(new), self.bound - len(self.known))
        short = pc.less(pc.binary_length(fresh), 100).to_numpy(zero_copy_only=False)
        keep = len(short) if short.all() else int(short.argmin())  # no whole texts
        if (room := min(room, keep)) > 0:
            self.known = pa.concat_arrays([self.known, fresh.slice(0, room)])
            self.sizes = [x[: len(self.known)] for x in sizes]
            self.ids = [x[: n.sum()] for x, n in zip(ids, self.sizes, strict=True)]
        place = place[coded.indices.to_numpy()]
        ends = np.cumsum(np.concatenate([[0], sizes[0][place] == 0]))[bounds]
        good = (np.diff(ends) == 0) & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        place = place[np.repeat(good, np.diff(bounds))]
        per_text = np.where(good, np.diff(bounds), 0)
        edges = np.concatenate([[0], np.cumsum(per_text)])
        out = [gather(i, n, place) for i, n in zip(ids, sizes, strict=True)]
        totals = [np.diff(np.concatenate([[0], np.cumsum(n[place])])[edges]) for n in sizes]
        return out, totals


@cache
def encoder(bytes_path: str, pieces_path: str) -> Encoder:
    """One per Python worker, so that later tasks know the words of earlier ones."""
    return Encoder(bytes_path, pieces_path)


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def middle_cuts(
    a_ends: np.ndarray, b_ends: np.ndarray, low: np.ndarray, high: np.ndarray
) -> np.ndarray:
    """For each interval low to high of tokens of the first side, the token nearest to its
    middle, the last apart, at whose end one of the second side ends too; -1 for none.

    Ends are looked up by bisection, in rings of doubling width around the middle.
    """
    out = np.full(len(low), -1, np.int64)
    middle = (low + high - 2) // 2
    todo = np.flatnonzero(high - low > 1)
    inner, width = 0, 1
    while len(todo):
        m, outer = middle[todo], inner + width
        begin = np.stack([np.maximum(m - outer + 1, low[todo]), m + max(inner, 1)], axis=1)
        end = np.stack([m - inner + 1, np.minimum(m + outer, high[todo] - 1)], axis=1)
        sizes = np.maximum(end - begin, 0).ravel()
        probe = runs(begin.ravel(), sizes)
        owner = np.repeat(np.repeat(np.arange(len(todo)), 2), sizes)
        wanted = a_ends[probe]
        place = np.searchsorted(b_ends, wanted)
        hit = b_ends[np.minimum(place, len(b_ends) - 1)] == wanted
        probe, owner = probe[hit], owner[hit]
        order = np.lexsort((np.abs(probe - m[owner]), owner))
        first = order[np.concatenate([[True], np.diff(owner[order]) > 0])] if len(order) else order
        out[todo[owner[first]]] = probe[first]
        left = (m - outer >= low[todo]) | (m + outer < high[todo] - 1)
        todo = todo[left & (out[todo] < 0)]
        inner, width = outer, 2 * width
    return out


def shared_groups(
    a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The last token of each group on both sides, in order.

    Bounds are those of the texts' tokens: text i has the tokens from bounds[i] to
    bounds[i + 1]. Ends are byte offsets, ascending over all texts.
    """
    some = np.flatnonzero(np.diff(a_bounds))
    low, high = a_bounds[:-1][some], a_bounds[1:][some]
    b_low, b_high = b_bounds[:-1][some], b_bounds[1:][some]
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(low):
        cut = np.full(len(low), -1, np.int64)
        open_ = np.flatnonzero(b_high - b_low > 1)
        cut[open_] = middle_cuts(a_ends, b_ends, low[open_], high[open_])
        leaf = cut < 0
        leaves.append((high[leaf] - 1, b_high[leaf] - 1))
        low, high, b_low, b_high, cut = (x[~leaf] for x in (low, high, b_low, b_high, cut))
        b_cut = np.searchsorted(b_ends, a_ends[cut])
        # Halves stay in order, so that lookups go through memory in order.
        low, high = (np.stack(x, 1).ravel() for x in ((low, cut + 1), (cut + 1, high)))
        b_low, b_high = (np.stack(x, 1).ravel() for x in ((b_low, b_cut + 1), (b_cut + 1, b_high)))
    if not leaves:
        return np.array([], np.int64), np.array([], np.int64)
    a_last = np.sort(np.concatenate([x for x, _ in leaves]))
    return a_last, np.sort(np.concatenate([x for _, x in leaves]))


class Signs:
    """Decimal ids with the sign that follows, as one table of strings."""

    def __init__(self, size: int):
        self.size = size
        digits = pa.array(np.arange(size)).cast(pa.string())
        self.table = pa.concat_arrays(
            [pc.binary_join_element_wise(digits, "", sign) for sign in ",|;"]
        )


@cache
def signs(size: int) -> Signs:
    return Signs(size)


def digests(
    ids: list[np.ndarray], last: list[np.ndarray], bounds: list[np.ndarray], size: int
) -> list[str]:
    """The digest of each text's groups; empty for a text without tokens."""
    out = [""] * (len(bounds[0]) - 1)
    if not len(ids[0]):
        return out
    codes = []
    for side, (i, end) in enumerate(zip(ids, last, strict=True)):
        code = i.astype(np.int64)
        code[end] += (1 + side) * size
        codes.append(code)
    # A token lies behind those of its side and the other side's of the groups before.
    ends = np.arange(len(last[0]))
    group = [np.searchsorted(end, np.arange(len(i))) for i, end in zip(ids, last, strict=True)]
    before = np.concatenate([[0], last[1] + 1])[ends], last[0] + 1
    merged = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    for side in (0, 1):
        merged[np.arange(len(ids[side])) + before[side][group[side]]] = codes[side]
    written = signs(size).table.take(pa.array(merged))
    offsets = np.frombuffer(written.buffers()[1], np.int32, len(written) + 1)
    data = memoryview(written.buffers()[2])
    edges = offsets[bounds[0] + bounds[1]]
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if b > a:
            out[i] = hashlib.sha256(data[a : b - 1]).hexdigest()
    return out


def links(
    ids: list[np.ndarray], last: list[np.ndarray], n_b: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs as group, pair of ids (a * n_b + b) and times. A pair can come more than
    once, but in a wide group: that is linked by its distinct ids."""
    starts = [np.concatenate([[0], end[:-1] + 1]) for end in last]
    sizes = [end + 1 - start for end, start in zip(last, starts, strict=True)]
    wide = np.flatnonzero(sizes[0] * sizes[1] > WIDE)
    per_group = sizes[1].copy()
    per_group[wide] = 0
    group = np.repeat(np.arange(len(last[0])), sizes[0])
    each = per_group[group]
    a = np.repeat(ids[0].astype(np.int64), each)
    pair = a * n_b + ids[1][runs(starts[1][group], each)]
    owner, times = np.repeat(group, each), np.ones(len(pair), np.int64)
    parts = [(owner, pair, times)]
    for g in wide:
        found = [
            np.unique(i[s[g] : e[g] + 1], return_counts=True)
            for i, s, e in zip(ids, starts, last, strict=True)
        ]
        pair = (found[0][0].astype(np.int64)[:, None] * n_b + found[1][0]).ravel()
        times = np.outer(found[0][1], found[1][1]).ravel()
        parts.append((np.full(len(pair), g), pair, times))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def align_block(coder: Encoder, texts: pa.Array) -> dict[str, np.ndarray | list]:
    """The columns of STAGED of a block of texts, ids apart."""
    ids, counts = coder.encode(texts)
    n_a, n_b = (len(x) for x in coder.lengths)
    bounds = [np.concatenate([[0], np.cumsum(x)]) for x in counts]
    ends = [np.cumsum(n[i], dtype=np.int64) for n, i in zip(coder.lengths, ids, strict=True)]
    last = shared_groups(*ends, *bounds)
    group, pair, times = links(ids, last, n_b)
    text = np.searchsorted(bounds[0], last[0], side="right") - 1  # of each group
    n = len(texts)
    # Distinct pairs of each text, and of the block.
    key = text[group] * (n_a * n_b) + pair if len(group) else pair
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(key) > 0])) if len(key) else order
    held = np.add.reduceat(times[order], first) if len(key) else times
    key = key[first]
    owner, pair = np.divmod(key, n_a * n_b)
    distinct, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
    return {
        "n_a": counts[0],
        "n_b": counts[1],
        "n_groups": np.bincount(text, minlength=n),
        "n_links": np.bincount(owner, held, minlength=n).astype(np.int64),
        "groups_sha256": digests(ids, last, bounds, max(n_a, n_b)),
        "pairs_of": np.bincount(owner, minlength=n).astype("<i4").tobytes(),
        "place": place.astype("<i4").tobytes(),
        "times": held.astype("<i4").tobytes(),
        "pair": distinct,
        "docs": docs,
    }


def aligned_blocks(docs: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """One row per block of texts."""

    def rows(batches):
        coder = encoder(bytes_path, pieces_path)
        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            for a, b in blocks(text, BLOCK):
                found = align_block(coder, text.slice(a, b - a))
                yield {"doc_id": [doc.slice(a, b - a).to_pylist()]} | {
                    k: [x if isinstance(x, bytes) else list(x)] for k, x in found.items()
                }

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return arrow_map(wanted, STAGED, rows)


def pair_counts(pairs: DataFrame, n_b: int) -> DataFrame:
    """pair, value: twice the documents that hold the pair, plus one if no other pair of its
    first id is held by more."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("n"))
    first = F.expr(f"pair DIV {n_b}")
    highest = counts.groupBy(first.alias("a")).agg(F.max("n").alias("highest"))
    return (
        counts.withColumn("a", first)
        .join(highest, "a")
        .select("pair", (2 * F.col("n") + (F.col("n") == F.col("highest")).cast("long")).alias("value"))
    )


def with_counts(found: DataFrame) -> DataFrame:
    """One row per document from blocks with the values of their pairs."""

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                place = np.frombuffer(row["place"].as_py(), "<i4")
                times = np.frombuffer(row["times"].as_py(), "<i4").astype(np.int64)
                of = np.frombuffer(row["pairs_of"].as_py(), "<i4")
                at, value = (
                    x.to_numpy(zero_copy_only=False) for x in row["values"].values.flatten()
                )
                values = np.zeros(len(at), np.int64)
                values[at] = value
                values = values[place]
                edges = np.concatenate([[0], np.cumsum(of)])
                total = np.concatenate([[0], np.cumsum(times * (values >> 1))])[edges]
                best = np.concatenate([[0], np.cumsum(times * (values & 1))])[edges]
                plain = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
                yield {name: row[name].values for name in plain} | {
                    "n_best": np.diff(best),
                    "count_sum": np.diff(total),
                }

    return arrow_map(found, ALIGNED, rows)


def align(docs: DataFrame, bytes_path: str, pieces_path: str, staging: Staging) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side A encodes a space and the text by a byte-level vocabulary, side B the text by a piece
    vocabulary that adds the space. Texts that are null, empty, or that a side does not give
    back have no tokens: zeros, and an empty digest. Null ids stay null, repeated rows repeat
    and count as documents each, an empty table gives no row. Other columns are not read.
    """
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=pieces_path).get_piece_size()
    staged = staging.table(
        aligned_blocks(docs, bytes_path, pieces_path).withColumn(
            "block", F.monotonically_increasing_id()
        ),
        "aligned",
    )
    each = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("pair") - 1).alias("at"), "pair", "docs"))
    some = staged.where(F.size("pair") > 0)
    pairs = some.select("block", each.alias("x")).select("block", "x.at", "x.pair", "x.docs")
    counts = pair_counts(some.select(F.explode(F.arrays_zip("pair", "docs")).alias("x")).select("x.*"), n_b)
    values = (
        pairs.join(counts, "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("at", "value")).alias("values"))
    )
    none = F.array().cast("array<struct<at:int,value:bigint>>")
    found = staged.drop("pair", "docs").join(values, "block", "left").select(
        *[c for c in staged.columns if c not in ("pair", "docs", "block")],
        F.coalesce("values", none).alias("values"),
    )
    return with_counts(found)
