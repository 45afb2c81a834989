"""MinHash near-dedup: circulant signatures, bands, and exact Jaccard verification of the candidates."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import python_ready, stage
from riskloom.llm.components import components

#: Places of the circle; both permutations are over these.
CIRCLE = 1 << 20
#: Bands and rows: a pair at similarity 0.8 shares no band with a chance of (1 - 0.8 ** 6) ** 40, about 5 in a million.
BANDS, ROWS = 40, 6
COORDINATES = BANDS * ROWS
#: Pairs that agree in a smaller share of coordinates are not verified: at similarity 0.8 the share of 240 coordinates
#: has a deviation of at most 0.026, so 0.66 is more than five deviations off.
AGREE = 0.66
SEED = 17
#: Members of one block of a bucket; two blocks are compared in one step.
BLOCK = 256
#: Bits of the sketch that bounds what two sets share from above.
BITS = 4096
#: Words whose hash a worker remembers.
REMEMBERED = 500_000
MIX = np.uint64(0x9E3779B97F4A7C15)

_CIRCLE: list[np.ndarray] = []


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_WORDS = WordHashes()


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; of all words where there are fewer.

    A-Z are lower-cased and words are parted by ASCII white space.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + len(out)]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def circle() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and windows into the second: row p holds its values from place p on."""
    if not _CIRCLE:
        rng = np.random.default_rng(SEED)
        first = rng.permutation(CIRCLE).astype(np.int64)
        second = rng.permutation(CIRCLE).astype(np.uint32)
        turned = np.concatenate([second, second[:COORDINATES]])
        _CIRCLE.extend([first, np.lib.stride_tricks.sliding_window_view(turned, COORDINATES)])
    return _CIRCLE[0], _CIRCLE[1]


def signature(own: np.ndarray) -> np.ndarray:
    """Coordinate k is the least value of the second permutation, turned by k, over the first permutation's places."""
    first, windows = circle()
    at = first[np.unique((own * MIX) >> np.uint64(44)).astype(np.int64)]
    out = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    for begin in range(0, len(at), 2048):
        np.minimum(out, windows[at[begin : begin + 2048]].min(axis=0), out=out)
    return out


def signatures(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key (128-bit hash of the set), sig (low 16 bits of each coordinate)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(_WORDS) > REMEMBERED:
                _WORDS.clear()
            n, keys, sigs = [], [], []
            for text in batch.column(2).to_pylist():
                own = shingles(text or "", size)
                n.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                sigs.append(signature(own).astype("<u2").tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sigs, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "set_key", "sig"],
            )

    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(sign, "doc_id long, text_hash long, n_shingles long, set_key binary, sig binary")


def band_rows(nodes: DataFrame) -> DataFrame:
    """bucket (64-bit hash of a band and its coordinates), band, node of every band."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(n, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)) * MIX
            for k in range(ROWS):
                key = (key ^ sig[:, :, k]) * MIX
                key = key ^ (key >> np.uint64(31))
            node = np.repeat(batch.column(0).to_numpy(), BANDS)
            band = np.tile(np.arange(BANDS, dtype=np.int32), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), pa.array(band), pa.array(node)], names=["bucket", "band", "node"]
            )

    return nodes.select("node", "sig").mapInArrow(deal, "bucket long, band int, node long")


def agreeing(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """a, b, agree of the pairs whose set sizes and signatures allow the similarity."""
    for end in "ab":
        own = nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}"))
        pairs = pairs.join(own, end)
    pairs = pairs.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            sig = [np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(len(batch), -1) for k in (2, 3)]
            agree = (sig[0] == sig[1]).sum(axis=1)
            keep = pa.array(agree >= AGREE * COORDINATES)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(agree.astype(np.int32))], names=["a", "b", "agree"]
            )
            yield out.filter(keep)

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(compare, "a long, b long, agree int")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, n_a, n_b, common: sizes of both whole sets and of what they share. sets: node, members (sorted hashes)."""
    for end in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("members").alias(f"set_{end}")), end)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros((3, len(batch)), np.int64)
            for k, (one, two) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                x, y = np.frombuffer(one, "<u8"), np.frombuffer(two, "<u8")
                at = np.minimum(np.searchsorted(y, x), max(0, len(y) - 1))
                sizes[:, k] = len(x), len(y), np.count_nonzero(y[at] == x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, sizes)], names=["a", "b", "n_a", "n_b", "common"]
            )

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(count, "a long, b long, n_a long, n_b long, common long")


def linked(found: DataFrame, percent: int) -> DataFrame:
    """a, b of the counted pairs that reach the similarity."""
    return found.where(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b")


def bit_sketch(own: np.ndarray) -> np.ndarray:
    """One bit per element by its hash, as 64-bit words."""
    at = (own * MIX) >> np.uint64(64 - BITS.bit_length() + 1)
    bits = np.zeros(BITS, np.uint8)
    bits[at.astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def node_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, members, bits of each wanted node, from the text of one of its documents. wanted: node, doc_id, text_hash."""
    keys = wanted.select("node", F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"))
    rows = documents.withColumn("text_hash", F.xxhash64("text"))
    rows = rows.join(keys, (F.col("doc_id") == F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(_WORDS) > REMEMBERED:
                _WORDS.clear()
            own = [shingles(t, size) for t in batch.column(1).to_pylist()]
            sets = pa.array([x.astype("<u8").tobytes() for x in own], pa.binary())
            bits = pa.array([bit_sketch(x).tobytes() for x in own], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sets, bits], names=["node", "members", "bits"])

    # rows that repeat a document give one set
    texts = rows.select("node", "text").groupBy("node").agg(F.first("text").alias("text"))
    return texts.mapInArrow(members, "node long, members binary, bits binary")


def block_pairs(members: DataFrame, percent: int) -> DataFrame:
    """a, b of all pairs in the buckets that lie in different components and may reach the similarity.

    members: bucket, band, bucket_size, node, label, n, sig, bits, common (size of what a node's set shares with the set of
    the bucket's pivot). A bucket is cut into blocks of about BLOCK members, and every two blocks of it meet in one step,
    so no task gets a whole bucket. Two bounds let most pairs across groups of copies go without a look at the sets, and
    never a pair that reaches the similarity: two sets share at most what one shares with the pivot and what the other
    has beyond the pivot, and at most one element per bit they have in common, beside the elements that share a bit
    within a set. Of the buckets that a pair shares, the first band's alone gives it.
    """
    blocks = F.ceil(F.col("bucket_size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "label",
        "n", "common", "band", "sig", "bits",
    )
    keys = ["bucket", "low", "high"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def compare(rows: list[tuple]) -> list[tuple]:
        low, high = rows[0][1], rows[0][2]
        left = [r for r in rows if r[3] == low]
        right = left if low == high else [r for r in rows if r[3] == high]
        if not left or not right:
            return []
        node, label, n, common = (np.array([r[k] for r in right]) for k in (4, 5, 6, 7))
        sig, bits, spare, band, out = None, None, None, rows[0][8], []
        for k, row in enumerate(left):
            most = np.minimum(np.minimum(common + row[6] - row[7], row[7] + n - common), np.minimum(n, row[6]))
            fits = (100 * most >= percent * (n + row[6] - most)) & (label != row[5])
            if low == high:
                fits[: k + 1] = False
            at = np.flatnonzero(fits)
            if len(at):
                if sig is None:
                    sig = np.frombuffer(b"".join(r[9] for r in right), "<u2").reshape(len(right), BANDS, ROWS)
                    bits = np.frombuffer(b"".join(r[10] for r in right), np.uint64).reshape(len(right), -1)
                    spare = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
                own = np.frombuffer(row[10], np.uint64)
                most = np.bitwise_count(bits[at] & own).sum(axis=1, dtype=np.int64)
                most += np.minimum(spare[at], row[6] - int(np.bitwise_count(own).sum()))
                at = at[100 * most >= percent * (n[at] + row[6] - most)]
            if len(at):
                same = sig[at] == np.frombuffer(row[9], "<u2").reshape(BANDS, ROWS)
                good = (same.sum(axis=(1, 2)) >= AGREE * COORDINATES) & (same.all(axis=2).argmax(axis=1) == band)
                out.extend((min(row[4], j), max(row[4], j)) for j in node[at[good]].tolist())
        return out

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, found = [], []
        for row in chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns)) for batch in batches):
            if group and row[:3] != group[0][:3]:
                found.extend(compare(group))
                group = []
            group.append(row)
            if len(found) >= 4096:
                yield pair_batch(found)
                found = []
        if group:
            found.extend(compare(group))
        yield pair_batch(found)

    return dealt.mapInArrow(stream, "a long, b long")


def pair_batch(pairs: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node, label after the labels that links join have become one. links: a, b (labels)."""
    merged = components(links).select(F.col("node").alias("label"), F.col("label").alias("now"))
    out = labels.join(merged, "label", "left").select("node", F.coalesce("now", "label").alias("label"))
    return stage(out, "node-labels")


def near_duplicates(
    documents: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents whose sets of `size`-word shingles have a Jaccard similarity of percent / 100 or more are linked, and a
    component is what links reach. Equal sets are one node from the start. Nodes that share a bucket of a band are
    candidates, in three steps that lose none of them: each node with the pivot (the first node of a bucket) it agrees
    with most, then with its other pivots, then, in buckets that still hold several components, nodes across components
    unless what they share with the pivot rules them out. Every link is confirmed on the whole sets, rebuilt from the
    texts of the candidates alone.

    A text without words (or null) has no shingles and is linked with nothing. Rows without an id take no part:
    component_id is null and they are kept. Rows that repeat an id are one document for the links. Other columns are
    ignored, and an empty table gives no rows.
    """
    spark = documents.sparkSession
    python_ready(spark)
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage(signatures(rows, size), "signatures")
    usable = signed.where("doc_id is not null and n_shingles > 0")
    nodes = usable.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.max("n_shingles").alias("n"), F.max("sig").alias("sig")
    )
    nodes = stage(
        nodes.select(
            F.monotonically_increasing_id().alias("node"), "set_key", "first.doc_id", "first.text_hash", "n", "sig"
        ),
        "nodes",
    )
    keys = nodes.select("node", "set_key")

    shared = band_rows(nodes).groupBy("bucket").agg(F.count(F.lit(1)).alias("bucket_size"), F.min("node").alias("pivot"))
    shared = stage(shared.where("bucket_size > 1"), "buckets")
    members = stage(band_rows(nodes).join(shared, "bucket"), "members")

    stars = members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = stage(agreeing(stars, nodes, percent), "stars")
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id", "text_hash"), "node")
    sets = stage(node_sets(rows, wanted, size), "sets")

    # rows of one id with different texts are linked by that id
    twice = usable.groupBy("doc_id").agg(F.min("set_key").alias("least"), F.max("set_key").alias("most"))
    twice = twice.where("least != most").select("doc_id", F.col("least").alias("set_key"))
    by_id = usable.select("doc_id", F.col("set_key").alias("other")).join(twice, "doc_id").join(keys, "set_key")
    by_id = by_id.select(F.col("node").alias("a"), F.col("other").alias("set_key")).join(keys, "set_key")
    best = stars.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("best")).select("best.a", "b")
    links = linked(overlaps(best, sets), percent).unionByName(by_id.select("a", F.col("node").alias("b")))
    labels = relabelled(nodes.select("node", F.col("node").alias("label")), links)

    def across(pairs: DataFrame) -> DataFrame:
        """The pairs whose ends have different labels, with these."""
        for end in "ab":
            pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}")), end)
        return pairs.where("label_a != label_b")

    def of_labels(pairs: DataFrame) -> DataFrame:
        return across(pairs).select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct()

    others = across(stars.join(best, ["a", "b"], "left_anti")).select("a", "b")
    labels = relabelled(labels, of_labels(linked(overlaps(others, sets), percent)))

    # a bucket of two is its pivot and one other: both steps above have seen it
    several = members.where("bucket_size > 2").join(labels, "node")
    mixed = several.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    mixed = stage(mixed.where("least != most").select("bucket"), "mixed")
    several = stage(several.join(mixed, "bucket"), "several")
    to_pivot = several.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    to_pivot = overlaps(to_pivot, sets).select(F.col("a").alias("pivot"), F.col("b").alias("node"), "common")
    several = several.join(to_pivot, ["pivot", "node"], "left").join(nodes.select("node", "n", "sig"), "node")
    several = several.join(sets.select("node", "bits"), "node")
    several = several.withColumn("common", F.coalesce("common", "n"))
    pairs = stage(block_pairs(several, percent), "pairs").join(stars.select("a", "b"), ["a", "b"], "left_anti")
    labels = relabelled(labels, of_labels(linked(overlaps(pairs, sets), percent)))

    least = labels.join(nodes.select("node", "doc_id"), "node").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_node = labels.join(least, "label").join(keys, "node").select("set_key", "component_id")
    of_node = stage(of_node, "component-ids")
    out = signed.join(of_node, "set_key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
