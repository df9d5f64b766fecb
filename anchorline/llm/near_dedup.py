"""Near-duplicate classes by DartMinHash signatures, banded joins and an exact check.

A text is a bag of five-word shingles. Copy c of a shingle is a region of unit weight; hashed
darts arrive in each region as a Poisson process, so their times depend on the region alone.
Every dart names one of the signature's coordinates, and a coordinate keeps its earliest dart.
Two texts agree in a coordinate with the probability of their weighted Jaccard similarity.
Only darts up to a time that fills all coordinates are thrown: about K log K + 2 K per text,
however long it is.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import Known, arrow_map, blocks, row_key, split_words, text_of
from anchorline.sources.staging import Staging

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
K = BANDS * ROWS
#: In the first pass texts are sorted within a bucket; each is held against so many before it.
NEIGHBOURS = 3
#: In the second pass the texts of a bucket meet in tiles of two blocks of about so many.
TILE = 512
#: Elements of bags that a tile looks up at a time.
LOOKUP = 1 << 20
#: Bytes of text that a task signs at a time.
BLOCK = 1 << 22
#: Pairs whose signatures agree in a smaller share are not checked: five standard deviations.
ESTIMATE = SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / K) ** 0.5
#: Signs that are no part of a word at its ends.
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¿¡«»“”‘’„…–—"

KEY = ["doc_id", "key_a", "key_b"]
KEYS = "doc_id long, key_a long, key_b long"
SIGNED = "node binary, bands array<long>, signature binary, bag binary"
PAIR = ["doc_a", "node_a", "doc_b", "node_b"]
PAIRS = "doc_a long, node_a binary, doc_b long, node_b binary"
#: Stands for a null id where texts are told apart.
NO_ID = (1 << 63) - 1

MASK = (1 << 64) - 1
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes of lower-cased words without signs at their ends; 0 where nothing is left."""
    bare = pc.utf8_lower(pc.utf8_trim(words, characters=EDGES))
    return np.array(
        [xxhash.xxh3_64_intdigest(w) | 1 if w else 0 for w in bare.to_pylist()], np.uint64
    ).view(np.int64)


def shingles(texts: pa.Array, known: Known) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Elements of all texts' bags, the text of each, sorted by both, and a digest per text.

    A text of one to four words has one shingle, all its words; one without words has none.
    Two texts have the same digest if their words are the same, or, without words, their signs.
    """
    bounds, codes, words = split_words(texts)
    hashes = known(words).view(np.uint64)[codes] if len(codes) else np.array([], np.uint64)
    full = hashes != 0
    bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
    hashes = hashes[full]
    digests = [
        xxhash.xxh3_128_digest(hashes[a:b].tobytes() or texts[i].as_py().strip())
        for i, (a, b) in enumerate(pairwise(bounds.tolist()))
    ]
    size = np.diff(bounds)
    padded = np.concatenate([hashes, np.zeros(WORDS, np.uint64)])
    doc = np.repeat(np.arange(len(texts)), size)
    left = bounds[1:][doc] - np.arange(len(hashes))  # words from here to the text's end
    short = (size < WORDS)[doc]
    value = np.zeros(len(hashes), np.uint64)
    for k in range(WORDS):
        word = padded[k : k + len(hashes)]
        value = mix(value ^ np.where(left > k, word, np.uint64(0)))
    starts = (left >= WORDS) | (short & (left == size[doc]))
    value, doc = value[starts], doc[starts]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(value))
    copy = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return mix(value ^ (copy.astype(np.uint64) * _A)), doc, digests


def signatures(elements: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """The earliest dart of each coordinate of each text; texts without elements have zeros."""
    out = np.zeros((n_docs, K), np.uint64)
    weight = np.bincount(doc, minlength=n_docs)
    until = (K * np.log(K) + 2 * K) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        mine = todo[doc]
        item, text = elements[mine], doc[mine]
        time = np.zeros(len(item))
        best = np.full(n_docs * K, np.inf)
        thrown = []
        turn = 0
        while len(item):
            turn += 1
            dart = mix(item + np.uint64(turn * 0x94D049BB133111EB & MASK))
            time = time - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53)
            early = time < until[text]
            item, text, time, dart = item[early], text[early], time[early], dart[early]
            dart = mix(dart)
            place = text * K + (dart % np.uint64(K)).astype(np.int64)
            np.minimum.at(best, place, time)
            thrown.append((place, time, dart))
        for place, time, dart in thrown:
            first = time == best[place]
            out.reshape(-1)[place[first]] = dart[first]
        filled = np.isfinite(best).reshape(n_docs, K).all(axis=1)
        until = until * 2  # a longer time leaves earlier darts as they are
        todo &= ~filled
    return out


def signed(docs: DataFrame) -> DataFrame:
    """The key of each document, the digest of its words, band hashes, signature and bag.

    The signature keeps one byte of each coordinate, the bag 32 bits of each element.
    """

    def rows(batches):
        known = Known(word_hashes)
        for batch in batches:
            text = batch.column(len(KEY))
            for a, b in blocks(text, BLOCK):
                elements, doc, digests = shingles(text.slice(a, b - a), known)
                signs = signatures(elements, doc, b - a)
                bands = np.zeros((b - a, BANDS), np.uint64)
                for k in range(ROWS):
                    bands = mix(bands ^ signs[:, k::ROWS])
                small = (elements >> np.uint64(32)).astype("<u4")
                cuts = np.searchsorted(doc, np.arange(b - a + 1)).tolist()
                bags = [np.sort(small[i:j]) for i, j in pairwise(cuts)]
                lists = bands.view(np.int64).tolist()
                yield {
                    **{c: batch.column(i).slice(a, b - a) for i, c in enumerate(KEY)},
                    "node": digests,
                    "bands": [x if len(bag) else [] for x, bag in zip(lists, bags, strict=True)],
                    "signature": [x.tobytes() for x in (signs & np.uint64(255)).astype(np.uint8)],
                    "bag": [x.tobytes() for x in bags],
                }

    return arrow_map(docs.select(*KEY, "text"), f"{KEYS}, {SIGNED}", rows)


def side(df: DataFrame, end: str, column: str) -> DataFrame:
    """A column of texts, to be joined to one end of pairs."""
    names = {"doc": f"doc_{end}", "node": f"node_{end}", column: f"{column}_{end}"}
    return df.select(*names).withColumnsRenamed(names)


def bucket_rows(nodes: DataFrame, staging: Staging) -> DataFrame:
    """Texts in buckets of two or more, with the bucket's size and leader: the smallest id.

    The leaders come from one aggregation that combines before it shuffles. They are stored,
    so that adaptive execution can split a bucket that many texts share.
    """

    def turned(by: int) -> Column:
        places = F.sequence(F.lit(0), F.lit(BANDS - 1))
        return F.transform(places, lambda i: F.element_at("bands", (i + by) % BANDS + 1))

    hashes = F.arrays_zip(*[turned(i).alias(f"h{i}") for i in range(3)])
    rows = (
        nodes.where(F.size("bands") > 0)
        .select("doc", "node", F.posexplode(hashes).alias("band", "h"))
        .select(F.col("doc").alias("doc_b"), F.col("node").alias("node_b"), "band", "h.*")
    )
    leaders = (
        rows.groupBy("band", "h0")
        .agg(
            F.min(F.struct("doc_b", "node_b")).alias("first"),
            F.max(F.struct("doc_b", "node_b")).alias("last"),
            F.count(F.lit(1)).alias("n"),
        )
        .where(F.col("first") != F.col("last"))
        .select(
            "band", "h0", "n", F.col("first.doc_b").alias("doc_a"), F.col("first.node_b").alias("node_a")
        )
    )
    return rows.join(staging.table(leaders, "leaders"), ["band", "h0"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, K)


def _near_pairs(batches):
    """Pairs of a sorted partition whose signatures agree often enough.

    Every text is held against the leader of its bucket and the NEIGHBOURS texts before it.
    """
    buckets = np.zeros((0, 2), np.int64)
    signs, texts = np.zeros((0, K), np.uint8), []
    for batch in batches:
        band, h0, doc_b, node_b, doc_a, node_a, sign_b, sign_a = batch.columns
        old = len(texts)
        buckets = np.concatenate([buckets, np.stack([band.to_numpy(), h0.to_numpy()], axis=1)])
        signs = np.concatenate([signs, _matrix(sign_b)])
        texts += zip(doc_b.to_pylist(), node_b.to_pylist(), strict=True)
        leaders = list(zip(doc_a.to_pylist(), node_a.to_pylist(), strict=True))
        agree = (signs[old:] == _matrix(sign_a)).sum(axis=1) >= ESTIMATE * K
        out = {(leaders[i], texts[old + i]) for i in np.flatnonzero(agree).tolist()}
        for back in range(1, NEIGHBOURS + 1):
            at = np.arange(max(old, back), len(texts))
            at = at[(buckets[at] == buckets[at - back]).all(axis=1)]
            at = at[(signs[at] == signs[at - back]).sum(axis=1) >= ESTIMATE * K]
            out |= {tuple(sorted((texts[i - back], texts[i]))) for i in at.tolist()}
        kept = [(*x, *y) for x, y in out if x != y]
        yield dict(zip(PAIR, zip(*kept, strict=True) if kept else [[]] * 4, strict=True))
        buckets, signs, texts = buckets[-NEIGHBOURS:], signs[-NEIGHBOURS:], texts[-NEIGHBOURS:]


def near_pairs(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct pairs of the first pass whose signatures agree often enough, by (doc, node).

    In each bucket of a band every text meets the leader, and the texts just before it when
    the bucket is sorted by the next bands. A bucket of n texts so gives at most
    (1 + NEIGHBOURS) * n pairs. `other_links` tests the rest. In each pair the smaller
    document id comes first.
    """
    for end in "ba":
        rows = rows.join(side(nodes, end, "signature"), [f"doc_{end}", f"node_{end}"])
    order = ["band", "h0", "h1", "h2", "node_b"]
    ordered = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("band", "h0", "doc_b", "node_b", "doc_a", "node_a", "signature_b", "signature_a")
    )
    return arrow_map(ordered, PAIRS, _near_pairs).distinct()


def _similar(batches):
    """Pairs whose bags have the similarity asked for."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
            small, large = min(len(a), len(b)), max(len(a), len(b))
            if small < SIMILARITY * large:
                keep.append(False)
                continue
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(both >= SIMILARITY * (len(a) + len(b) - both))
        mask = pa.array(keep, pa.bool_())
        yield {
            "node_a": batch.column(0).filter(mask),
            "node_b": batch.column(1).filter(mask),
        }


def first_links(signs: DataFrame, nodes: DataFrame, rows: DataFrame, staging: Staging) -> DataFrame:
    """Pairs of the first pass whose weighted Jaccard similarity is SIMILARITY or more."""
    near = staging.table(near_pairs(nodes, rows), "near")
    # The bag of the later text travels to that of the earlier, which many pairs may share.
    for end in "ba":
        near = near.join(side(signs, end, "bag"), [f"doc_{end}", f"node_{end}"])
    checked = near.select("node_a", "node_b", "bag_a", "bag_b")
    return arrow_map(checked, "node_a binary, node_b binary", _similar)


def _tiles(batches):
    """The rows of each tile of sorted rows, as one Arrow table."""
    key, held = None, []
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(TILE_KEY))], strict=True))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in pairwise(cuts):
            if a == b:
                continue
            if keys[a] != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _possible(tile: pa.Table):
    """Classes of a tile's texts, and a function: a text's possible partners after it.

    Partners are of another class and, in a tile of two blocks, of the other block; their
    bags have a fitting size, the signatures agree often enough, and no band before this one
    has brought the two together.
    """
    column = {c: tile.column(c).combine_chunks() for c in tile.column_names}
    n = len(tile)
    _, label = np.unique(np.array(column["label"].to_pylist(), "S32"), return_inverse=True)
    signs = _matrix(column["signature"])
    before = column["bands"].flatten().to_numpy().reshape(n, BANDS)[:, : tile["band"][0].as_py()]
    size, block = column["size"].to_numpy(), column["block"].to_numpy()
    two = tile["i"][0].as_py() != tile["j"][0].as_py()

    def partners(x: int) -> np.ndarray:
        fit = np.minimum(size[x], size[x + 1 :]) >= SIMILARITY * np.maximum(size[x], size[x + 1 :])
        fit &= label[x + 1 :] != label[x]
        if two:
            fit &= block[x + 1 :] != block[x]
        at = np.flatnonzero(fit) + x + 1
        at = at[(signs[at] == signs[x]).sum(axis=1) >= ESTIMATE * K]
        return at[~(before[at] == before[x]).any(axis=1)]

    return label, partners


def _with_partners(batches):
    """The rows of texts that have a possible partner in their tile."""
    for tile in _tiles(batches):
        _, partners = _possible(tile)
        some = np.zeros(len(tile), bool)
        for x in range(len(tile) - 1):
            at = partners(x)
            some[at] = True
            some[x] |= len(at) > 0
        kept = tile.filter(pa.array(some)).combine_chunks()
        yield {c: kept.column(c).combine_chunks() for c in kept.column_names}


def _tile_links(batches):
    """Links between classes in each tile, of equal ones the first: label_a, label_b."""
    for tile in _tiles(batches):
        label, partners = _possible(tile)
        bags = [np.frombuffer(x, "<u4") for x in tile["bag"].to_pylist()]
        names = tile["label"].to_pylist()
        out = []
        for x in range(len(bags) - 1):
            at = partners(x)
            ends = np.cumsum([len(bags[y]) for y in at.tolist()])
            for part in np.split(at, np.flatnonzero(np.diff(ends // LOOKUP)) + 1) if len(at) else []:
                lengths = np.array([len(bags[y]) for y in part.tolist()])
                found = np.concatenate([bags[y] for y in part.tolist()])
                place = np.minimum(np.searchsorted(bags[x], found), len(bags[x]) - 1)
                hits = (bags[x][place] == found).astype(np.int64)
                both = np.add.reduceat(hits, np.cumsum(lengths) - lengths)
                alike = both >= SIMILARITY * (len(bags[x]) + lengths - both)
                for y in part[alike].tolist():
                    if label[x] != label[y]:
                        out.append((names[x], names[y]))
                        label[label == label[y]] = label[x]
        yield {"node_a": [x for x, _ in out], "node_b": [y for _, y in out]}


TILE_KEY = ["band", "h0", "i", "j"]
TILED = (
    "band int, h0 long, i int, j int, block int, doc long, node binary, label binary, size int, "
    "bands array<long>, signature binary"
)


def other_links(
    signs: DataFrame, nodes: DataFrame, rows: DataFrame, labels: DataFrame, staging: Staging
) -> DataFrame:
    """Links between classes of the first pass, by the labels of their classes.

    Every pair of texts of two classes that share a bucket is tested, in whatever bucket: the
    first pass has tested those of two texts. A bucket of n texts is dealt into blocks, and two
    blocks meet in one task, so that a text travels n / TILE times. Signatures come first;
    only texts with a possible partner send their bags. A task gives the links that connect
    classes, fewer than it has texts, however many pairs are alike.
    """
    own = rows.where(F.col("n") > 2).select(
        "band", "h0", "n", F.col("doc_b").alias("doc"), F.col("node_b").alias("node")
    )
    own = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    own = staging.table(own, "labelled")
    mixed = (
        own.groupBy("band", "h0")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where(F.col("least") != F.col("most"))
        .select("band", "h0")
    )
    own = own.join(staging.table(mixed, "mixed"), ["band", "h0"])
    blocks_of = F.ceil(F.col("n") / TILE).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks_of).cast("int")
    # All texts of a bucket of one block meet in the tile (0, 0).
    dealt = own.withColumn("block", block).select(
        "*", F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("with")
    )
    tiled = (
        dealt.withColumn("i", F.least("block", "with"))
        .withColumn("j", F.greatest("block", "with"))
        .join(nodes.select("doc", "node", "size", "bands", "signature"), ["doc", "node"])
    )
    names = [c.split()[0] for c in TILED.split(", ")]

    def by_tile(df: DataFrame, *more: str) -> DataFrame:
        ordered = df.select(*names, *more).repartition(*TILE_KEY)
        return ordered.sortWithinPartitions(*TILE_KEY, "node")

    some = staging.table(arrow_map(by_tile(tiled), TILED, _with_partners), "partners")
    bags = some.join(signs.select("doc", "node", "bag"), ["doc", "node"])
    return arrow_map(by_tile(bags, "bag"), "node_a binary, node_b binary", _tile_links)


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """The smallest node that each linked node is connected to: node, label.

    Every round takes the smallest label among neighbours and then the label of one's label.
    Rounds are written to shared storage; they end when no label changes.
    """
    both = staging.table(
        edges.select(F.col("node_a").alias("node"), F.col("node_b").alias("other")).union(
            edges.select(F.col("node_b"), F.col("node_a"))
        ),
        "edges",
    )
    labels = staging.table(
        both.groupBy("node")
        .agg(F.min("other").alias("label"))
        .select("node", F.least("node", "label").alias("label")),
        "labels",
    )
    while True:
        told = both.join(labels.withColumnRenamed("node", "other"), "other")
        least = staging.table(told.groupBy("node").agg(F.min("label").alias("told")), "told")
        met = staging.table(
            labels.join(least, "node").select(
                "node", F.least("label", "told").alias("label"), F.col("label").alias("old")
            ),
            "met",
        )
        next_label = met.select(F.col("node").alias("label"), F.col("label").alias("of"))
        labels = staging.table(
            met.join(next_label, "label").select("node", F.col("of").alias("label"), "old"),
            "labels",
        )
        if labels.where(F.col("label") != F.col("old")).isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def relabelled(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """Nodes with the label of their class after the classes that `joined` connects are one."""
    old = joined.select(F.col("node").alias("of"), F.col("label").alias("to"))
    moved = labels.join(old, F.col("label") == F.col("of"), "left").select(
        "node", F.coalesce("to", "label").alias("label")
    )
    # Texts that the first pass linked to none are their own labels.
    alone = joined.join(labels, "node", "left_anti").select("node", "label")
    return moved.unionByName(alone)


def classes(docs: DataFrame, staging: Staging) -> DataFrame:
    """The key of each document, its class and the class's first document.

    Texts of the same words are of one class, and so are texts that links connect.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *row_key(text_of()), text_of().alias("text")
    )
    signs = staging.table(signed(keyed), "signed")
    signs = signs.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    nodes = staging.table(
        signs.groupBy("node").agg(
            F.min("doc").alias("doc"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
            F.first(F.length("bag") / 4).cast("int").alias("size"),
        ),
        "nodes",
    )
    rows = staging.table(bucket_rows(nodes, staging), "buckets")
    labels = components(first_links(signs, nodes, rows, staging), staging)
    others = staging.table(other_links(signs, nodes, rows, labels, staging), "others")
    linked = staging.table(relabelled(labels, components(others, staging)), "linked")
    of = staging.table(
        signs.select(*KEY, "node")
        .join(linked, "node", "left")
        .select(*KEY, F.coalesce("label", "node").alias("class")),
        "of",
    )
    first = staging.table(
        of.groupBy("class").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *KEY)).alias("first")
        ),
        "first",
    )
    return of.join(first, "class")


def near_classes(docs: DataFrame, staging: Staging) -> DataFrame:
    """Per document its class: doc_id, class_id (its smallest id), kept (it is the class's first).

    Null, empty and blank texts form one class. Texts of signs alone are alike if they are
    equal, and texts of one to four words if all their words are. Null ids come last; a class of them alone has a
    null class_id. Rows equal in id and text are all first if one is. An empty table gives no
    row. Columns other than `doc_id` and `text` are not read.
    """
    same = F.lit(True)
    for name in KEY:
        same = same & F.col(name).eqNullSafe(F.col(f"first.{name}"))
    return classes(docs, staging).select(
        "doc_id", F.col("first.doc_id").alias("class_id"), same.alias("kept")
    )


def one_of_each(docs: DataFrame, staging: Staging) -> DataFrame:
    """The first document of each class, once, with all its columns."""
    first = classes(docs, staging).select("first.*").distinct()
    first = staging.table(first.withColumnsRenamed({k: f"first_{k}" for k in KEY}), "keepers")
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        *row_key(text_of()),
    )
    match = [F.col(k).eqNullSafe(F.col(f"first_{k}")) for k in KEY]
    return keyed.join(first, match, "left_semi").dropDuplicates(KEY).select("row.*")
