"""Finding the windows of a corpus that also start earlier: what both kinds of span removal share.

A window is ``length`` consecutive symbols of one document. It is *late* if the
same symbols also start earlier: in a document of smaller id, or earlier in the
same document. The work goes in four steps, none of which compares all windows:

1. Every text is cut into runs of windows with one anchor gram (``anchors``) and
   described by one row per run: a hash of the gram, a hash of the whole stretch
   and its place. Windows that are equal have equal grams.
2. Rows meet by gram. A gram met once is dropped. Of equal stretches all but the
   first are late as a whole; stretches that share a gram and differ stay open.
3. Open stretches are sent with their symbols to the bucket of their gram, where
   a ``Decider`` finds the late windows exactly, by the method of its operator.
4. Late windows return to their documents as spans.

Hot grams: equal stretches within a block of text are settled in that block, so
copies do not pile up behind one key. Grams that a sample of documents shows to
be very common are keyed by the hash of the whole stretch, and what stays open
of them by the hash of each window, so they spread however common they are. The
sample decides where rows go, never what is found. Every hash used for a decision
has 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import anchors
from corvane.llm.bpe import blocks
from corvane.llm.tables import fresh_folder

#: Symbols handled at once; longer texts are cut with overlap.
CHUNK = 1 << 18
#: One of so many documents is looked at for hot grams.
SAMPLE = 64
#: Documents of one bucket, on average.
BUCKET_DOCS = 1024

LATE, HOT = 1 << 17, 1 << 16
ROWS = "key long, stretch long, doc_id long, place long"
OPEN_ROWS = "bucket int, key long, check long, doc_id long, place long, symbols binary"
SPANS = "doc_id long, spans array<struct<begin: long, windows: long>>"


class Symbols(NamedTuple):
    """How texts become symbols; functions run inside tasks."""

    length: int
    gram: int
    #: 64-bit values, equal where symbols are equal, and their storage form
    of: Callable[[str], tuple[np.ndarray, np.ndarray]]
    #: turns rows for the buckets (bucket, document, place, symbols) into what is sent
    pack: Callable[[list, list, list, list], tuple[list, list, list, list]]


class Block(NamedTuple):
    """Runs of a block of documents, in order."""

    doc: np.ndarray
    begin: np.ndarray  # of the first window, in its document
    windows: np.ndarray
    left: np.ndarray  # symbols of the first window before the anchor
    gram: np.ndarray
    stretch: np.ndarray


def block_runs(kind: Symbols, keys: list[int], texts: list[str]) -> Block:
    parts, pending, owner, base, size = [], [], [], [], 0

    def flush() -> None:
        nonlocal size
        if pending:
            ends = np.cumsum([len(p) for p in pending])
            found = anchors.runs(np.concatenate(pending), ends, kind.length, kind.gram)
            which = np.searchsorted(ends, found.first, "right")
            starts = np.concatenate([[0], ends[:-1]])[which]
            parts.append(
                Block(
                    np.array(owner, np.int64)[which],
                    found.first - starts + np.array(base, np.int64)[which],
                    found.windows, found.anchor - found.first, found.gram, found.stretch,
                )
            )
        pending.clear(), owner.clear(), base.clear()
        size = 0

    for key, text in zip(keys, texts, strict=True):
        values, _ = kind.of(text)
        for at in range(0, max(1, len(values) - kind.length + 1), CHUNK):
            piece = values[at : at + CHUNK + kind.length - 1]
            if len(piece) < kind.length:
                continue
            pending.append(piece)
            owner.append(key)
            base.append(at)
            size += len(piece)
            if size >= CHUNK:
                flush()
    flush()
    if not parts:
        none = np.zeros(0, np.int64)
        return Block(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Block(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def pack_place(begin: np.ndarray, windows: np.ndarray, left: np.ndarray) -> np.ndarray:
    return (begin << 18) | (windows << 8) | left


def unpack_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 18, (place >> 8) & 255, place & 255


def later_of_equals(*columns: np.ndarray) -> np.ndarray:
    """Marks rows whose values were met before, in row order."""
    order = np.lexsort((np.arange(len(columns[0])), *columns[::-1]))
    same = np.ones(max(0, len(order) - 1), bool)
    for c in columns:
        same &= c[order[1:]] == c[order[:-1]]
    out = np.zeros(len(order), bool)
    out[order[1:][same]] = True
    return out


def arrow_rows(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names)


def hot_grams(docs: DataFrame, kind: Symbols, least: int) -> np.ndarray:
    """Grams met at least ``least`` times in one of SAMPLE documents; a few thousand at most,
    as all others together are met less often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches):
            found = block_runs(kind, part.column(0).to_pylist(), texts)
            gram, count = np.unique(found.gram, return_counts=True)
            yield arrow_rows([gram, count.astype(np.int64)], ["gram", "n"])

    sampled = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    common = (
        sampled.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least).orderBy(F.desc("n"), "gram").limit(4096)
    )
    return np.sort(np.array([r.gram for r in common.collect()], np.int64).view(np.uint64))


def runs_of(docs: DataFrame, kind: Symbols, hot: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches):
            found = block_runs(kind, part.column(0).to_pylist(), texts)
            order = np.lexsort((found.begin, found.doc))
            found = Block(*(c[order] for c in found))
            again = later_of_equals(found.doc, found.begin, found.stretch, found.gram)
            found = Block(*(c[~again] for c in found))
            place = pack_place(found.begin, found.windows, found.left)
            is_hot = np.isin(found.gram, hot)
            key = np.where(is_hot, anchors.mix(found.gram ^ (found.stretch >> np.uint64(7))), found.gram)
            place[is_hot] |= HOT
            late = later_of_equals(found.gram, found.stretch)
            place[late] |= LATE
            spread = anchors.mix(found.doc.astype(np.uint64) ^ (found.begin.astype(np.uint64) << np.uint64(20)))
            yield arrow_rows([np.where(late, spread, key), found.stretch, found.doc, place], ["key", "stretch", "doc_id", "place"])

    return docs.mapInArrow(run, ROWS)


def settle(rows: DataFrame) -> DataFrame:
    """Rows of runs that are late or stay open; the others' grams or windows are the only ones."""

    def judge(key, stretch, doc, place):
        n = len(key)
        passed = (place & LATE) > 0
        new_key = np.ones(n, bool)
        new_key[1:] = (key[1:] != key[:-1]) | passed[1:] | passed[:-1]
        new_pair = new_key.copy()
        new_pair[1:] |= stretch[1:] != stretch[:-1]
        group = np.cumsum(new_key) - 1
        pairs = np.bincount(group, new_pair)[group]
        late = ~new_pair | passed
        again = np.zeros(n, bool)
        again[1:] = (key[1:] == key[:-1]) & (stretch[1:] == stretch[:-1]) & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
        late &= ~again
        keep = (late | (pairs > 1) | ((place & HOT) > 0)) & ~again
        place = np.where(late, place | LATE, place)
        return arrow_rows([doc[keep], place[keep]], ["doc_id", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append(columns)
            if columns[0][0] == columns[0][-1] and held[0][0][0] == columns[0][0]:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            held = [[c[cut:] for c in columns]]
            if cut:
                yield judge(*(c[:cut] for c in columns))
        if held:
            yield judge(*(np.concatenate(c) for c in zip(*held, strict=True)))

    dealt = rows.repartition("key").sortWithinPartitions("key", "stretch", "doc_id", "place")
    return dealt.mapInArrow(run, "doc_id long, place long")


def open_stretches(docs: DataFrame, kind: Symbols, buckets: int) -> DataFrame:
    """Rows for the buckets, from documents with ``places``."""
    names = ["bucket", "key", "check", "doc_id", "place", "symbols"]

    def rows(keys, texts, places):
        out = [[] for _ in names]
        hot_rows = []
        _, down = anchors.powers(1 << 20)
        up, _ = anchors.powers(1 << 20)
        for key, text, own in zip(keys, texts, places, strict=True):
            own = np.sort(np.array(own, np.int64))
            own = own[(own & LATE) == 0]
            if not len(own):
                continue
            values, stored = kind.of(text)
            begin, windows, left = unpack_place(own & ~HOT)
            hot = (own & HOT) > 0
            at = begin + left
            gram = anchors.mix((values[at[:, None] + np.arange(kind.gram)] * up[: kind.gram]).sum(1, dtype=np.uint64))
            for k in np.flatnonzero(~hot).tolist():
                g = int(gram[k])
                out[0].append(g % buckets)
                out[3].append(key)
                out[4].append(int(own[k]))
                out[5].append(stored[begin[k] : begin[k] + windows[k] + kind.length - 1].tobytes())
            if hot.any():
                start = np.concatenate([b + np.arange(w) for b, w in zip(begin[hot], windows[hot], strict=True)])
                span = values[start[:, None] + np.arange(kind.length)]
                a = anchors.mix((span * up[: kind.length]).sum(1, dtype=np.uint64))
                b = anchors.mix((anchors.mix(span) * up[1 : kind.length + 1]).sum(1, dtype=np.uint64))
                hot_rows.append((a, b, np.full(len(a), key), start))
        out[0], out[3], out[4], out[5] = kind.pack(out[0], out[3], out[4], out[5])
        out[1], out[2] = [0] * len(out[0]), [0] * len(out[0])
        if hot_rows:
            a, b, doc, start = (np.concatenate(x) for x in zip(*hot_rows, strict=True))
            order = np.lexsort((start, doc))
            a, b, doc, start = a[order], b[order], doc[order], start[order]
            late = later_of_equals(a, b)
            spread = anchors.mix(doc.astype(np.uint64) ^ (start.astype(np.uint64) << np.uint64(20)))
            out[0] += (np.where(late, spread, a) % np.uint64(buckets)).tolist()
            out[1] += a.tolist()
            out[2] += b.tolist()
            out[3] += doc.tolist()
            out[4] += ((start << 18) | (1 << 8) | HOT | np.where(late, LATE, 0)).tolist()
            out[5] += [None] * len(a)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches):
            out = rows(part.column(0).to_pylist(), texts, part.column(2).to_pylist())
            if out[0]:
                kinds = [pa.int32(), pa.uint64(), pa.uint64(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
                arrays[1], arrays[2] = arrays[1].view(pa.int64()), arrays[2].view(pa.int64())
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select("doc_id", "text", "places").mapInArrow(run, OPEN_ROWS)


#: Late windows of one bucket's open stretches: arrays (document, first window, windows).
#: Takes documents, places and symbols as packed, in order of document and anchor.
Decider = Callable[[np.ndarray, np.ndarray, list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def hot_windows(key, check, doc, place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Late windows among single windows known by 128-bit hashes."""
    passed = (place & LATE) > 0
    begin = place >> 18
    rest = np.flatnonzero(~passed)
    rest = rest[np.lexsort((begin[rest], doc[rest]))]
    late = np.concatenate([np.flatnonzero(passed), rest[later_of_equals(key[rest], check[rest])]])
    return doc[late], begin[late], np.ones(len(late), np.int64)


def decided(rows: DataFrame, decide: Decider) -> DataFrame:
    def bucket(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held)
        key, check, doc, place = (whole.column(c).to_numpy() for c in ("key", "check", "doc_id", "place"))
        hot = (place & HOT) > 0
        cold = np.flatnonzero(~hot)
        cold = cold[np.lexsort(((place >> 18)[cold] + (place & 255)[cold], doc[cold]))]
        symbols = whole.column("symbols").take(pa.array(cold)).to_pylist()
        found = [decide(doc[cold], place[cold], symbols), hot_windows(key[hot], check[hot], doc[hot], place[hot])]
        d, b, w = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
        return arrow_rows([d, b, w], ["doc_id", "begin", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            number = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and held[0].column(0)[0].as_py() != number[a]:
                    yield bucket(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield bucket(held)

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "doc_id long, begin long, windows long")


def late_spans(docs: DataFrame, kind: Symbols, decide: Decider, hot_least: int = 1000) -> tuple[DataFrame, DataFrame]:
    """``docs`` dealt by document, and the late windows of each as ``spans``.

    ``docs`` has ``doc_id`` and ``text``. A row that repeats another in both counts
    once, and both get the same spans; ids are otherwise taken to be distinct.
    Documents without late windows have no row among the spans.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    buckets = max(1, -(-docs.count() // BUCKET_DOCS))
    hot = hot_grams(docs, kind, hot_least)
    folder = fresh_folder(spark, "runs")
    settle(runs_of(docs, kind, hot)).write.parquet(folder)
    by_doc = spark.read.parquet(folder).groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    dealt = docs.repartition("doc_id")
    once = dealt.groupBy("doc_id").agg(F.min("text").alias("text"))
    marked = once.join(by_doc.filter(F.exists("places", lambda p: p.bitwiseAND(F.lit(LATE)) == 0)), "doc_id")
    found = decided(open_stretches(marked, kind, buckets), decide)
    place = F.col("place")
    settled = spark.read.parquet(folder).filter(place.bitwiseAND(F.lit(LATE)) != 0).select(
        "doc_id",
        F.shiftright(place, 18).alias("begin"),
        F.shiftright(place, 8).bitwiseAND(F.lit(255)).alias("windows"),
    )
    spans = settled.unionByName(found).groupBy("doc_id").agg(F.collect_list(F.struct("begin", "windows")).alias("spans"))
    return dealt, spans


def covered(spans: list | None, length: int, n: int) -> np.ndarray:
    """Begins and ends of the maximal stretches that late windows cover, as rows."""
    if not spans:
        return np.zeros((0, 2), np.int64)
    begin = np.array([s["begin"] for s in spans], np.int64)
    end = begin + np.array([s["windows"] for s in spans], np.int64) + length - 1
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(new)
    return np.stack([begin[first], np.minimum(end[np.append(first[1:] - 1, len(end) - 1)], n)], 1)
