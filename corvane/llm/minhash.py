"""Near copies by an exact join of minwise signatures under a distance, confirmed on full sets.

A signature has SLOTS slots of 16 bits, each the low bits of the least of all
shingles under one hash. It is split into CHUNKS chunks. If two signatures differ
in at most ``2 * CHUNKS - 1`` slots, some chunk differs in at most one slot
(pigeonhole), so both have an equal key among the chunk's keys that leave one
slot out: those are the allowed chunk errors, enumerated. Every pair within that
distance meets. A pair at a likeness of 0.8 lies beyond it with a chance of
0.00003 and then still meets unless every chunk has two errors or more; it is
missed with a chance of one in ten million, and nearer pairs far less.

All that meet are confirmed on their full shingle sets. Texts with equal sets are
one class from the start. Pairs of a group are not all compared: first each class
is compared with the least class it meets; then classes that meet and are not yet
connected are compared in memory, in blocks. What is left untested is connected
already, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import anchors
from corvane.llm.bpe import blocks
from corvane.llm.substring import word_hashes
from corvane.llm.tables import checkpointed, fresh_folder, release

SHINGLE = 4
CHUNKS, CHUNK_SLOTS = 12, 5
SLOTS = CHUNKS * CHUNK_SLOTS
#: Odd multipliers of the hashes, from a fixed rule.
_HASHES = anchors.mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
#: Shingles handled at once.
BLOCK = 1 << 15
#: Links of one partition while components are found.
LINKS_OF_PART = 50_000
#: Classes of a cluster that meet in one task, and shingles compared at once there.
BLOCK_CLASSES, COLUMNS = 1024, 4096


def shingles(text: str, size: int) -> np.ndarray:
    """Hashes of the distinct shingles, sorted. A text of fewer words is one shingle."""
    words = word_hashes(np.frombuffer(text.encode().lower(), np.uint8))
    if not len(words):
        return words
    up, _ = anchors.powers(1 << 20)
    width = min(size, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total += words[k : len(words) - width + 1 + k] * up[k + 1]
    return np.unique(anchors.mix(total ^ np.uint64(width)))


def signatures(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of slots for each of the concatenated, non-empty sets."""
    out = np.zeros((len(sizes), SLOTS), np.uint64)
    begin = np.cumsum(sizes) - sizes
    for s, a in enumerate(_HASHES):
        out[:, s] = np.minimum.reduceat(scrambled(sets, a), begin)
    return anchors.mix(out) & np.uint64(0xFFFF)


def scrambled(x: np.ndarray, a: np.uint64) -> np.ndarray:
    return (x ^ a) * a


def chunk_keys(slots: np.ndarray) -> np.ndarray:
    """For each signature, the keys of every chunk without one of its slots."""
    n = len(slots)
    keys = np.zeros((n, CHUNKS, CHUNK_SLOTS), np.uint64)
    chunks = slots.reshape(n, CHUNKS, CHUNK_SLOTS)
    for left_out in range(CHUNK_SLOTS):
        key = np.zeros((n, CHUNKS), np.uint64)
        for s in range(CHUNK_SLOTS):
            if s != left_out:
                key = (key << np.uint64(16)) | chunks[:, :, s]
        tag = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK_SLOTS) + np.uint64(left_out)
        keys[:, :, left_out] = anchors.mix(anchors.mix(key) + tag * np.uint64(0x9E3779B97F4A7C15))
    return keys.reshape(n, SLOTS)


def signed(docs: DataFrame, size: int) -> DataFrame:
    """Set size, 128-bit hash of the set, and chunk keys of every document."""
    kind = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part, texts in blocks(batches):
            sets = [shingles(t, size) for t in texts]
            sizes = np.array([len(s) for s in sets], np.int64)
            keys = np.zeros((len(sets), SLOTS), np.uint64)
            sums = np.zeros((2, len(sets)), np.uint64)
            filled = np.flatnonzero(sizes)
            at = 0
            while at < len(filled):
                end, total = at, 0
                while end < len(filled) and (end == at or total + sizes[filled[end]] <= BLOCK):
                    total += sizes[filled[end]]
                    end += 1
                own = filled[at:end]
                flat = np.concatenate([sets[k] for k in own])
                keys[own] = chunk_keys(signatures(flat, sizes[own]))
                begin = np.cumsum(sizes[own]) - sizes[own]
                sums[0, own] = np.add.reduceat(anchors.mix(flat), begin)
                sums[1, own] = np.add.reduceat(anchors.mix(flat ^ np.uint64(0x5851F42D4C957F2D)), begin)
                at = end
            offsets = np.zeros(len(sets) + 1, np.int32)
            np.cumsum(np.where(sizes > 0, SLOTS, 0), out=offsets[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(sizes), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[filled].ravel().view(np.int64))),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "keys"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, kind)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches):
            sets = [shingles(t, size).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["rep", "members"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "rep long, members array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough; only one set of a pair travels."""
    one = sets.select(F.col("rep").alias("b"), F.col("members").alias("of_b"))
    other = sets.select(F.col("rep").alias("a"), F.col("members").alias("of_a"))
    both = pairs.join(one, "b").join(other, "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes; a component is named by its least node.

    Alternating large-star and small-star steps, each a grouping and a join; the
    links are written to the shared folder after every step.
    """
    links = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    # steps keep about as many links as there are now; small ones need few files
    parts = 1 + links.count() // LINKS_OF_PART
    links = links.coalesce(parts)
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = checkpointed(small.union(least.select("u", F.col("m").alias("v"))).distinct().coalesce(parts))
        state = links.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state


def intersections(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    flat = [np.concatenate(x) for x in (one, other)]
    common = np.intersect1d(*flat)
    owner = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (one, other)]
    place = [np.searchsorted(common, f) for f in flat]
    held = [(p < len(common)) & (common[np.minimum(p, len(common) - 1)] == f) if len(common) else np.zeros(len(f), bool) for p, f in zip(place, flat, strict=True)]
    out = np.zeros((len(one), len(other)), np.float32)
    for begin in range(0, len(common), COLUMNS):
        part = []
        for p, h, o, x in zip(place, held, owner, (one, other), strict=True):
            own = h & (p >= begin) & (p < begin + COLUMNS)
            matrix = np.zeros((len(x), min(COLUMNS, len(common) - begin)), np.float32)
            matrix[o[own], p[own] - begin] = 1
            part.append(matrix)
        out += part[0] @ part[1].T
    return out.astype(np.int64)


def linked_labels(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of labels (a, b) between which some classes of one key are linked.

    Classes that meet, directly or through others, form a cluster, which goes in
    blocks of BLOCK_CLASSES; each pair of blocks is compared in one task, where only
    classes of different labels count. A set travels once per block of its cluster,
    and no pair is ever a row unless it links two labels.
    """
    least = rest.groupBy("key").agg(F.min("rep").alias("leader"))
    star = rest.join(least, "key").filter("leader < rep").select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    cluster = components(star)
    labels = rest.select("rep", "label").distinct()
    nodes = labels.join(cluster.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "label", F.coalesce("component", "rep").alias("cluster")
    )
    counts = nodes.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_CLASSES).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    placed = nodes.join(counts, "cluster").withColumn("own", own)
    dealt = placed.select(
        "rep", "label", "cluster", "own",
        F.explode(F.expr("transform(sequence(0, blocks - 1), x -> struct(least(own, x) AS low, greatest(own, x) AS high))")).alias("pair"),
    ).select("rep", "label", "cluster", "own", "pair.low", "pair.high")
    rows = sets.join(dealt, "rep").select("cluster", "low", "high", "own", "label", "members")

    def compare(held: list[pa.RecordBatch]) -> np.ndarray:
        whole = pa.Table.from_batches(held)
        low, high, own, label = (whole.column(c).to_numpy() for c in ("low", "high", "own", "label"))
        members = [np.asarray(x) for x in whole.column("members").to_pandas()]
        one = np.flatnonzero(own == low[0])
        other = one if low[0] == high[0] else np.flatnonzero(own == high[0])
        if not len(one) or not len(other):
            return np.zeros((0, 2), np.int64)
        common = intersections([members[k] for k in one], [members[k] for k in other])
        sizes = np.array([len(x) for x in members])
        union = sizes[one][:, None] + sizes[other] - common
        a, b = np.nonzero((100 * common >= percent * union) & (label[one][:, None] != label[other]))
        pairs = np.sort(np.stack([label[one[a]], label[other[b]]], 1), 1)
        return np.unique(pairs, axis=0) if len(pairs) else pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            pairs = compare(held)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                key = tuple(keys[begin])
                if held and key != last:
                    yield done()
                    held = []
                held.append(batch.slice(begin, end - begin))
                last = key
        if held:
            yield done()

    ordered = rows.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def near_copies(docs: DataFrame, percent: int = 80, size: int = SHINGLE) -> DataFrame:
    """Every document with its set size and its component of near copies.

    Takes ``doc_id`` and ``text``; words are lower-cased (A to Z). Documents are
    linked if their shingle sets share at least ``percent`` of their union. Texts
    without words are linked with nothing; a null text has none. Returns
    ``doc_id``, ``n_shingles``, ``component_id`` (the least id reachable) and
    ``kept`` (whether that is the document's own). Rows that repeat in id and text
    get the same result.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "signatures")
    signed(docs, size).write.parquet(folder)
    base = spark.read.parquet(folder)
    classes = checkpointed(
        base.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")
        )
    )
    of_doc = base.filter("n_shingles > 0").select("doc_id", "set_a", "set_b").join(classes, ["set_a", "set_b"])
    keyed = base.select("doc_id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    met = keyed.join(shared.select("key"), "key").join(of_doc.select("doc_id", "rep", "n"), "doc_id")
    groups_folder = fresh_folder(spark, "groups")
    met.select("key", "rep", "n").distinct().write.parquet(groups_folder)
    groups = spark.read.parquet(groups_folder)
    least = groups.groupBy("key").agg(F.min("rep").alias("leader"))
    first = groups.join(least, "key").filter("leader < rep").groupBy("rep").agg(F.min("leader").alias("leader"))
    first = first.select(F.col("leader").alias("a"), F.col("rep").alias("b"))

    nodes = groups.join(least, "key").filter("leader < rep").select("rep", "leader")
    nodes = nodes.select(F.explode(F.array("rep", "leader")).alias("doc_id")).distinct()
    sets_folder = fresh_folder(spark, "sets")
    full_sets(docs.join(nodes, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")), size).write.parquet(sets_folder)
    sets = spark.read.parquet(sets_folder)

    links = checkpointed(confirmed(first, sets, percent))
    known = components(links)
    labelled = groups.join(known.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", "n", F.coalesce("component", "rep").alias("label")
    )
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    rest = labelled.join(mixed.select("key"), "key").select("key", "rep", "label")
    more = linked_labels(rest, sets, percent)
    known = components(links.union(more))

    named = checkpointed(
        classes.join(known.withColumnRenamed("node", "rep"), "rep", "left").select(
            "set_a", "set_b", F.coalesce("component", "rep").alias("component_id")
        )
    )
    result = base.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
