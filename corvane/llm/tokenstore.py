"""Token ids of documents in raw shard files, reached by document key through minimal perfect hashes.

A store is a folder:

* ``shards/``: one file per range of documents in ascending order. After a header of 16 bytes (MAGIC and the
  width of an id, 2 or 4 bytes) come the ids of its documents, little-endian, without separators;
* ``records``: Parquet, a row per document: its shard, the ids before it in there, its length;
* ``places``: Parquet, a row per shard: its file, its number of ids, the ids before it in the whole store;
* ``index/``: one file per part of the keys: a minimal perfect hash and an entry for each of its slots;
* ``parts``: Parquet, a row per index file.

Documents are dealt to shards by ranges, so no task sees them all, and files are written batch by batch. A key is
a ``doc_id`` with a copy number: rows that share an id are copies 0, 1, ... in the order of their texts, and may
span shards. Keys are dealt to parts of about PART_KEYS by a hash; a part's file holds bit levels, in each of which
a key that meets no other takes a bit, and the number of bits before a key's is its slot. The slot's entry has
the key's fingerprint, so keys that are not in the store are told apart; as the fingerprint is a bijection
of the id, with the copy number beside it, the answer is never wrong. A lookup reads one part, a few bits, one
entry and one stretch of a shard, however many documents there are.

Files carry the name of the attempt that wrote them, and only those that Spark's committed Parquet tables name
belong to the store: a lost or repeated task leaves at most a file that nothing names.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm import words
from corvane.llm.bpe import blocks
from corvane.llm.tables import checkpointed, shuffle_partitions, texts

MAGIC = b"IDSHARD1"
HEADER = 16
#: Keys of one index part, on average.
PART_KEYS = 1 << 16
#: Bits of a level for each key that is still to be placed.
ROOM = 2
#: Ids of neighbouring documents that one read takes at most, unless one document has more.
READ_IDS = 1 << 21
RECORDS = "doc_id long, shard int, file string, copy_in_shard long, place long, length long, width int"
ENTRY = np.dtype([("key", "<u8"), ("copy", "<u4"), ("copies", "<u4"), ("shard", "<u4"), ("place", "<u8"), ("length", "<u8")])


@lru_cache(1)
def word_encoder(path: str):
    """Ids of texts as a tokenizer that drops white space and case gives them, and the bytes an id needs.

    Texts that are not in normal form C, or hold the one letter whose lower case is two signs, are encoded by
    the library as they stand; of all others each distinct piece is encoded once.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    given = Tokenizer.from_file(path)
    given.no_truncation()
    given.no_padding()
    special = {t.content: i for i, t in given.get_added_tokens_decoder().items()}
    level = words.byte_level(given)

    def pieces(raw: list[str]) -> list[list[int]]:
        return level([p if words.has_unknown(p) else "" if p[0] in words.SPACES else "".join(map(str.lower, p)) for p in raw])

    table = words.PieceTable(pieces, cut=words.word_starts, fold=words.lower())

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [k for k, t in enumerate(texts) if "İ" in t or not unicodedata.is_normalized("NFC", t)]
        if not odd:
            return table.ids_of(texts, special)
        plain = list(texts)
        for k in odd:
            plain[k] = ""
        ids, counts = table.ids_of(plain, special)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k in odd:
            own = [i for s in words.slices(texts[k]) for i in given.encode(s, add_special_tokens=False).ids]
            parts[k], counts[k] = np.array(own, np.uint32), len(own)
        return np.concatenate(parts), counts

    return encode, 2 if given.get_vocab_size() <= 1 << 16 else 4


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Slots 0 to n - 1 for n distinct pairs of key and copy; any other pair gets some slot or -1."""

    sizes: np.ndarray  # of the levels, in bits
    bits: np.ndarray  # all levels, 64 bits a word, each level in words of its own

    @classmethod
    def of(cls, keys: np.ndarray, copies: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], np.arange(len(keys))
        while len(left):
            size = 64 * -(-ROOM * len(left) // 64)
            at = cls.position(keys[left], copies[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(np.array(sizes, "<u8"), np.concatenate(levels) if levels else np.zeros(0, "<u8"))

    @staticmethod
    def position(keys: np.ndarray, copies: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mix(mix(keys ^ seed) + copies.astype(np.uint64)) % np.uint64(size)).astype(np.int64)

    def __post_init__(self):
        ones = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def slots(self, keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = self.position(keys[open_], copies[open_], level, size)
            word, bit = base + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot = self.before[word] + np.bitwise_count(below).astype(np.int64)
            found[open_[hit]] = slot[hit]
            open_ = open_[~hit]
            base += size >> 6
        return found


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def new_file(folder: str, name: str) -> tuple[str, pa.NativeFile]:
    where, path = file_system(folder)
    where.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    return f"{folder}/{name}", where.open_output_stream(f"{path}/{name}")


def open_file(uri: str) -> pa.NativeFile:
    where, path = file_system(uri)
    return where.open_input_file(path)


@dataclass(frozen=True)
class TokenStore:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def write(docs: DataFrame, folder: str, path: str, end_id: int) -> TokenStore:
    """Writes the ids of all documents, each followed by ``end_id``, to a new store in ``folder``.

    Takes ``doc_id`` and ``text`` (null: empty; other columns are not used; rows without an id are left out).
    ``path`` names a vocabulary as ``word_encoder`` takes it. No documents make a store without shards.
    """
    spark = docs.sparkSession
    store = TokenStore(spark, folder)
    shards = f"{folder}/shards"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = word_encoder(path)
        shard, file, out, place, last, copy = TaskContext.get().partitionId(), None, None, 0, None, 0
        try:
            for part, given in blocks(batches):
                if out is None:
                    file, out = new_file(shards, f"shard-{shard}")
                    out.write(struct.pack("<8sQ", MAGIC, width))
                ids, counts = encode(given)
                ids = np.insert(ids, np.cumsum(counts), end_id)
                out.write(ids.astype(f"<u{width}").tobytes())
                counts = counts + 1
                places = place + np.cumsum(counts) - counts
                place += len(ids)
                keys = part.column(0).to_numpy()
                fresh = np.append(keys[:1] != last if last is not None else [True], keys[1:] != keys[:-1])
                begin = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -copy))
                copies = np.arange(len(keys)) - begin
                last, copy = keys[-1], int(copies[-1]) + 1
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([shard] * n, pa.int32()), pa.array([file] * n), pa.array(copies),
                     pa.array(places), pa.array(counts), pa.array([width] * n, pa.int32())],
                    ["doc_id", "shard", "file", "copy_in_shard", "place", "length", "width"],
                )
        finally:
            if out is not None:
                out.close()

    order = ["doc_id", "text_hash", "row_number"]
    dealt = (
        texts(docs)
        .select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row_number"))
        .repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
    )
    dealt.select("doc_id", "text").mapInArrow(run, RECORDS).write.parquet(f"{folder}/records")
    _place_shards(store)
    _build_index(store)
    return store


def _place_shards(store: TokenStore) -> None:
    """Where each shard starts in the whole store, and the copies of its first document in shards before."""
    last = F.max_by("copy_in_shard", F.struct("doc_id", "copy_in_shard")) + 1
    of = store.table("records").groupBy("shard").agg(
        F.first("file").alias("file"), F.first("width").alias("width"), F.sum("length").alias("n_ids"),
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), last.alias("of_last"),
    )
    ahead = Window.orderBy("shard")  # a row per shard
    alike = Window.partitionBy("last_doc").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    summed = of.withColumn("so_far", F.sum("of_last").over(alike))
    before = F.when(F.lag("last_doc").over(ahead) == F.col("first_doc"), F.lag("so_far").over(ahead))
    summed.select(
        "shard", "file", "width", "n_ids", "first_doc",
        (F.sum("n_ids").over(ahead) - F.col("n_ids")).alias("start"),
        F.coalesce(before, F.lit(0)).cast("long").alias("copies_before"),
    ).write.parquet(f"{store.folder}/places")


def _build_index(store: TokenStore) -> None:
    folder = f"{store.folder}/index"
    records = store.table("records")
    n = max(1, -(-records.count() // PART_KEYS))
    first = F.when(F.col("doc_id") == F.col("first_doc"), F.col("copies_before")).otherwise(0)
    keys = records.join(store.table("places").select("shard", "first_doc", "copies_before"), "shard").select(
        "doc_id", (F.col("copy_in_shard") + first).alias("copy"), "shard", "place", "length"
    )
    copies = keys.groupBy("doc_id").agg(F.count("*").alias("copies")).filter("copies > 1")
    dealt = keys.join(copies, "doc_id", "left").select(
        *keys.columns, F.coalesce("copies", F.lit(1)).alias("copies"), part_of("doc_id", "copy", n).alias("part")
    )

    def build(part: pa.Table) -> pa.Table:
        column = {c: part.column(c).to_numpy() for c in part.column_names}
        key, copy = column["doc_id"].astype(np.int64).view(np.uint64), column["copy"].astype(np.uint32)
        found = PerfectHash.of(key, copy)
        entries = np.zeros(len(key), ENTRY)
        slot = found.slots(key, copy)
        entries["key"][slot], entries["copy"][slot] = mix(key), copy
        for name in ("copies", "shard", "place", "length"):
            entries[name][slot] = column[name]
        file, out = new_file(folder, f"part-{column['part'][0]}")
        with out:
            out.write(struct.pack("<8sQQ", MAGIC, len(found.sizes), len(entries)))
            for block in (found.sizes, found.bits, entries):
                out.write(block.tobytes())
        return pa.table({"part": column["part"][:1], "file": [file], "n_keys": [len(key)], "n_parts": [n]})

    made = dealt.groupBy("part").applyInArrow(build, "part long, file string, n_keys long, n_parts long")
    made.write.parquet(f"{store.folder}/parts")


def part_of(key: str, copy: str, n: int):
    return F.pmod(F.xxhash64(F.col(key).cast("long"), F.col(copy).cast("long")), F.lit(n).cast("long"))


@lru_cache(2)
def index_part(file: str) -> tuple[PerfectHash, np.ndarray]:
    with open_file(file) as given:
        raw = given.read()
    _, levels, n = struct.unpack_from("<8sQQ", raw)
    sizes = np.frombuffer(raw, "<u8", levels, 24)
    words_ = int(sizes.sum()) // 64
    bits = np.frombuffer(raw, "<u8", words_, 24 + 8 * levels)
    return PerfectHash(sizes, bits), np.frombuffer(raw, ENTRY, n, 24 + 8 * (levels + words_))


def find(store: TokenStore, keys: DataFrame) -> DataFrame:
    """The entries of the keys (``doc_id``, ``copy``) that the store holds, each asked for once.

    Returns ``doc_id``, ``copy``, ``copies`` (of that id), ``shard``, ``place`` and ``length``; a key
    that the store does not hold gives no row, nor does a key that is null.
    """
    parts = store.table("parts")
    some = parts.select("n_parts").head()
    n = some.n_parts if some else 1
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("copy").cast("long").alias("copy")).na.drop()
    dealt = asked.distinct().withColumn("part", part_of("doc_id", "copy", n)).join(parts.select("part", "file"), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(2).dictionary_encode()
            at = files.indices.to_numpy()
            for k, file in enumerate(files.dictionary.to_pylist()):
                rows = np.flatnonzero(at == k)
                key = batch.column(0).to_numpy()[rows].view(np.uint64)
                copy = batch.column(1).to_numpy()[rows]
                found, entries = index_part(file)
                slot = found.slots(key, copy)
                held = entries[slot]
                right = (slot >= 0) & (held["key"] == mix(key)) & (held["copy"] == copy)
                held = held[right]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[right].view(np.int64)), pa.array(copy[right]), *(pa.array(held[c].astype(np.int64)) for c in ENTRY.names[2:])],
                    ["doc_id", "copy", *ENTRY.names[2:]],
                )

    near = dealt.select("doc_id", "copy", "file", "part").repartition("part").sortWithinPartitions("part")
    return near.drop("part").mapInArrow(run, "doc_id long, copy long, copies long, shard long, place long, length long")


def lookup(store: TokenStore, keys: DataFrame) -> DataFrame:
    """The documents of the keys (column ``doc_id``), all copies of each, read from the shards.

    Returns ``doc_id``, ``copy``, ``start`` (ids of all documents before it in the store), ``n_tokens`` (with the
    end id) and ``ids`` (little-endian unsigned 32-bit).
    """
    first = checkpointed(find(store, keys.select("doc_id", F.lit(0).alias("copy"))))
    several = (
        first.filter("copies > 1")
        .select("doc_id", "copies", F.explode(F.expr("sequence(1, copies - 1, 1024)")).alias("from"))
        .select("doc_id", F.explode(F.expr("sequence(from, least(from + 1023, copies - 1))")).alias("copy"))
    )
    found = first.unionByName(find(store, several))
    shards = store.table("places").select("shard", "file", "width", "start")
    slab = F.expr(f"place div {READ_IDS}")
    near = (
        found.join(shards, "shard")
        .select("doc_id", "copy", (F.col("start") + F.col("place")).alias("start"), "place", "length", "file", "width",
                "shard", slab.alias("slab"))
        .repartition("shard", "slab")
        .sortWithinPartitions("shard", "place")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, given = None, None
        for batch in batches:
            place, length = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            files, width = batch.column(5).to_pylist(), batch.column(6).to_pylist()
            begin = 0
            while begin < len(files):
                end, last = begin + 1, place[begin] + length[begin]
                while (
                    end < len(files) and files[end] == files[begin] and place[end] == last
                    and last + length[end] - place[begin] <= READ_IDS
                ):
                    last += length[end]
                    end += 1
                if files[begin] != name:
                    if given is not None:
                        given.close()
                    name, given = files[begin], open_file(files[begin])
                size = width[begin]
                raw = given.read_at(int((last - place[begin]) * size), int(HEADER + place[begin] * size))
                ids = np.frombuffer(raw, f"<u{size}").astype("<u4")
                ends = np.cumsum(length[begin:end])
                offsets = pa.py_buffer((4 * np.append(0, ends)).astype(np.int64).tobytes())
                values = pa.Array.from_buffers(pa.large_binary(), end - begin, [None, offsets, pa.py_buffer(ids.tobytes())])
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), part.column(4), values.cast(pa.binary())],
                    ["doc_id", "copy", "start", "n_tokens", "ids"],
                )
                begin = end
        if given is not None:
            given.close()

    columns = "doc_id long, copy long, start long, n_tokens long, ids binary"
    return near.drop("shard", "slab").mapInArrow(run, columns)


def decode(ids: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``copy`` and the text that the stored ids spell, the end id left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        given = Tokenizer.from_file(path)
        for batch in batches:
            rows = [np.frombuffer(x, "<u4")[:-1].tolist() for x in batch.column(2).to_pylist()]
            texts = [given.decode(x, skip_special_tokens=False) for x in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "copy", "text"])

    return ids.select("doc_id", "copy", "ids").mapInArrow(run, "doc_id long, copy long, text string")
