"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and their beginnings of 3 to 6 letters: all that occur in the
examples, a bounded, balanced sample of labelled documents (EXAMPLES of each label
at most). How many documents hold a term is counted over the whole corpus. A
term's weight is 1 + log of its count, times its idf, times a power of the likelihood
ratio by which its presence tells the labels of the examples apart, so that a few
marking words are not drowned in a long text; no term is left out. The power is the
one of POWERS, 0 (plain TF-IDF) among them, with which either half of the examples
judges the other best.

Examples lie in blocks of BLOCK. Terms of many examples are a matrix that knows the
largest weight in each block, the others are postings. A text's postings are summed
first, in double precision; with the largest weights they bound what a block can
hold, and blocks that cannot hold a nearer example than those found are skipped: the
neighbours are exact. Of those near, only the matrix's share is summed again. Their
labels vote, weighted by cosine and by how many labelled documents an example stands
for. An example takes no part in judging the row of its own id.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm import anchors
from corvane.llm.bpe import blocks
from corvane.llm.tables import fresh_folder, release
from corvane.llm.tokenstore import file_system

#: Labelled documents of each label that serve as examples, at most.
EXAMPLES = 2048
#: Powers of a term's likelihood ratio that are tried on the examples.
POWERS = (0.0, 0.5, 1.0)
#: Added to that power, so that every term has a weight.
LEAST = 1e-3
BLOCK = 32
#: A term is of many examples if one in so many holds it.
COMMON = 16
#: Texts compared at once, at most.
BATCH = 384
#: Bytes of text taken from a batch at once.
PART_BYTES = 1 << 20
NEIGHBOURS = 15
BEGINNINGS = (3, 4, 5, 6)
#: Postings lie in rows of so many, the last of a term filled up with zeros.
POSTS = 4
#: Blocks scored first, of those that can hold most; they set what the others must reach.
FIRST = 4
#: A sum that no cosine makes positive.
LEFT_OUT = -1e6
#: Votes of no evidence: so much weight at the rate of the labels.
PRIOR = 0.5


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@lru_cache(1)
def _in_word() -> np.ndarray:
    table = np.ones(0x110000, bool)
    table[:128] = [chr(c).isalnum() for c in range(128)]
    return table


class Known:
    """Sorted hashes, found by where those that begin with the same bits start."""

    def __init__(self, hashes: np.ndarray):
        bits = max(1, len(hashes).bit_length())
        self.count, self.shift = len(hashes), np.uint64(64 - bits)
        self.start = np.searchsorted(hashes >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))  # a last one that none is beyond

    def __len__(self) -> int:
        return self.count

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where hashes stand, or -1."""
        at = self.start[(hashes >> self.shift).astype(np.int64)].astype(np.int64)
        short = np.flatnonzero(self.hashes[at] < hashes)
        while len(short):
            at[short] += 1
            short = short[self.hashes[at[short]] < hashes[short]]
        return np.where((self.hashes[at] == hashes) & (at < self.count), at, -1)


def term_hashes(text: str) -> np.ndarray:
    """The distinct terms of a text, as 64-bit hashes."""
    return counted_terms([text])[1]


def counted_terms(texts: list[str], known: Known | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of each text: the text's number, the term, how often it occurs there; in this order.

    A term is its 64-bit hash, or its place in ``known``, and others are left out. Every distinct
    word of all the texts is hashed and looked up once, with its beginnings.
    """
    given = [unicodedata.normalize("NFC", t).lower() for t in texts]
    code = np.frombuffer(("\n".join(given) + "\n").encode("utf-32-le"), np.uint32)
    edge = np.diff(_in_word()[code].astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    stops = np.cumsum(np.fromiter(map(len, given), np.int64, len(given)) + 1)
    sums = anchors.prefix_sums(code.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    hashes = anchors.mix(anchors.stretch_hash(sums, begin, end))
    order = np.argsort(hashes)
    hashes = hashes[order]
    new = np.append(True, hashes[1:] != hashes[:-1]) if len(hashes) else np.zeros(0, bool)
    whole, at, word = hashes[new], order[new], np.empty(len(order), np.int64)
    word[order] = np.cumsum(new) - 1
    words = max(1, len(whole))
    held, times = np.unique(np.searchsorted(stops, begin, "right") * words + word, return_counts=True)
    doc, word = held // words, held % words
    begin, size = begin[at], end[at] - begin[at]
    docs, terms, counts = [], [], []
    for n in (0, *BEGINNINGS):
        own = np.flatnonzero(size >= n)
        if n:
            made = anchors.mix(anchors.stretch_hash(sums, begin[own], begin[own] + n) + np.uint64(n))
        else:
            made = whole
        term = np.full(words, -1, np.int64)
        term[own] = made.view(np.int64) if known is None else known.places(made)
        long = np.zeros(words, bool)
        long[own] = True if known is None else term[own] >= 0
        some = np.flatnonzero(long[word])
        docs.append(doc[some])
        terms.append(term[word[some]])
        counts.append(times[some])
    doc, term, times = map(np.concatenate, (docs, terms, counts))
    if known is None:
        term = term.view(np.uint64)
    order = np.lexsort((term, doc)) if known is None else np.argsort(doc * max(1, len(known)) + term)
    doc, term, times = doc[order], term[order], times[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])) if len(doc) else doc > 0)
    return doc[new], term[new], np.add.reduceat(times, new) if len(new) else times


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def parts(rows: list) -> Iterator[list]:
    """The rows in as few parts of about equal length, BATCH at most, as there can be."""
    size = -(-len(rows) // max(1, -(-len(rows) // BATCH)))
    return (rows[k : k + size] for k in range(0, len(rows), max(1, size)))


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes
    idf: np.ndarray  # times how well a term tells the labels apart
    ids: np.ndarray  # of the examples, and so on
    label: np.ndarray
    stands_for: np.ndarray
    sizes: np.ndarray  # how many terms each example has
    term: np.ndarray  # the numbers of the terms of all examples, one after the other
    weight: np.ndarray
    prior: np.ndarray  # the rate of the labels, and the score of a text without terms

    def __post_init__(self):
        self.rate, self.empty_score = self.prior.tolist()
        self.blocks = -(-len(self.ids) // BLOCK)
        self.begin = np.cumsum(self.sizes) - self.sizes
        example = np.repeat(np.arange(len(self.sizes)), self.sizes)
        held = np.bincount(self.term, minlength=len(self.terms))
        self.common = np.full(len(self.terms), -1, np.int64)
        many = np.flatnonzero(held * COMMON >= max(1, len(self.ids)))
        self.common[many] = np.arange(len(many))
        own = self.common[self.term] >= 0
        self.matrix = np.zeros((self.blocks, len(many), BLOCK), np.float32)
        self.matrix[example[own] // BLOCK, self.common[self.term[own]], example[own] % BLOCK] = self.weight[own]
        self.most = np.ascontiguousarray(self.matrix.max(2, initial=0).T)
        self.common_term, self.common_weight = self.common[self.term[own]].astype(np.int32), self.weight[own]
        self.common_size = np.bincount(example[own], minlength=len(self.sizes))
        self.common_begin = np.cumsum(self.common_size) - self.common_size
        # single precision: n products of unit vectors, n additions and the rounding of their factors
        self.slack = 2 * (len(many) + 4) * 2.0**-24
        term, example, weight = self.term[~own], example[~own], self.weight[~own]
        order = np.argsort(term, kind="stable")
        size = np.bincount(term, minlength=len(self.terms))
        self.post_rows = -(-size // POSTS)
        self.post_begin = np.cumsum(self.post_rows) - self.post_rows
        at = ranges(self.post_begin * POSTS, size)
        self.post_example = np.zeros((int(self.post_rows.sum()), POSTS), np.int32)
        self.post_weight = np.zeros(self.post_example.shape)
        self.post_example.reshape(-1)[at], self.post_weight.reshape(-1)[at] = example[order], weight[order]
        self.known = Known(self.terms)
        self.place = {k: n for n, k in enumerate(self.ids.tolist())}

    @property
    def rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        cuts = self.begin[1:]
        return list(zip(np.split(self.term, cuts), np.split(self.weight, cuts), strict=True)) if len(self.ids) else []

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.vectors([text])[0]

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The numbers and weights of the known terms of each text, at unit length."""
        doc, term, count = counted_terms(texts, self.known)
        weight = (1 + np.log(count)) * self.idf[term]
        cuts = np.searchsorted(doc, np.arange(1, len(texts)))
        parts = zip(np.split(term, cuts), np.split(weight, cuts), strict=True)
        return [(t, w / np.sqrt((w**2).sum()) if len(t) else w) for t, w in parts]

    def nearest(self, terms: np.ndarray, weights: np.ndarray) -> list[tuple[float, int]]:
        """(cosine, example) of the nearest examples with a common term; ties to the lesser example."""
        return self.nearest_all([(terms, weights)])[0]

    def nearest_all(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], without: np.ndarray | None = None
    ) -> list[list[tuple[float, int]]]:
        """The nearest examples of each vector; ``without`` names the one that each leaves out, or -1."""
        n, width = len(vectors), self.blocks * BLOCK
        if not width:
            return [[] for _ in vectors]
        asked, rare = np.zeros((n, self.matrix.shape[1]), np.float32), np.zeros((n, width))
        for k, (terms, weights) in enumerate(vectors):
            common = self.common[terms]
            asked[k, common[common >= 0]] = weights[common >= 0]
            rows = self.post_rows[terms]
            at = ranges(self.post_begin[terms], rows)
            part = self.post_weight.take(at, axis=0).reshape(-1)
            part *= np.repeat(weights, rows * POSTS)
            rare[k] = np.bincount(self.post_example.take(at, axis=0).reshape(-1), part, minlength=width)
        if without is not None:
            own = np.flatnonzero(without >= 0)
            rare[own, without[own]] = LEFT_OUT
        sums = rare.copy()
        bound = asked @ self.most + sums.reshape(n, self.blocks, BLOCK).max(2) + self.slack
        scored = np.zeros((n, self.blocks), bool)

        def visit(wanted: np.ndarray) -> None:
            for block in np.flatnonzero(wanted.any(0)).tolist():
                own, part = np.flatnonzero(wanted[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                sums[own, part] += asked[own] @ self.matrix[block]
            scored[wanted] = True

        first = np.zeros((n, self.blocks), bool)
        some = min(FIRST, self.blocks)
        np.put_along_axis(first, np.argpartition(bound, self.blocks - some, 1)[:, self.blocks - some :], True, 1)
        visit(first)
        place = max(0, some * BLOCK - NEIGHBOURS)
        reached = np.partition(sums.reshape(n, self.blocks, BLOCK)[first].reshape(n, -1), place, 1)[:, place]
        # sums are right but for the slack: what is as near but for it is compared below
        visit(~scored & (bound > self.slack) & (bound >= reached[:, None] - self.slack))
        sums.reshape(n, self.blocks, BLOCK)[~scored] = 0
        place = width - min(width, NEIGHBOURS)
        least = np.partition(sums, place, 1)[:, place]
        close = (sums > 0) & (sums >= least[:, None] - 2 * self.slack)
        out = []
        exact = np.zeros(asked.shape[1])
        for k, ((terms, weights), own) in enumerate(zip(vectors, close, strict=True)):
            near = np.flatnonzero(own)
            if not len(near):
                out.append([])
                continue
            # common terms again in double precision, in the order of the example's terms, whatever the batch
            common = self.common[terms]
            exact[common[common >= 0]] = weights[common >= 0]
            size = self.common_size[near]
            at = ranges(self.common_begin[near], size)
            product = exact[self.common_term[at]] * self.common_weight[at]
            cosine = rare[k, near] + np.bincount(np.repeat(np.arange(len(near)), size), product, minlength=len(near))
            exact[common[common >= 0]] = 0
            best = sorted(((round(float(c), 12), k) for c, k in zip(cosine, near.tolist(), strict=True) if c > 0), key=lambda x: (-x[0], x[1]))
            out.append(best[:NEIGHBOURS])
        return out

    def judge(self, text: str) -> tuple[float, list[tuple[int, float]]]:
        """Score and evidence: the ids of the nearest examples with their cosines."""
        return self.judge_all([text])[0]

    def judge_all(self, texts: list[str], ids: list[int | None] | None = None) -> list[tuple[float, list[tuple[int, float]]]]:
        """``judge`` for each text; where ``ids`` gives a row's id, the example of this id does not vote."""
        own = [-1] * len(texts) if ids is None else [self.place.get(k, -1) for k in ids]
        asked = list(zip(texts, own, strict=True))
        distinct, made = list(dict.fromkeys(asked)), {}
        for part in parts(distinct):
            vectors = self.vectors([t for t, _ in part])
            near = self.nearest_all(vectors, np.array([k for _, k in part], np.int64))
            for key, (terms, _), found in zip(part, vectors, near, strict=True):
                if len(terms):
                    made[key] = (self.vote(found), [(int(self.ids[k]), s) for s, k in found])
                else:
                    made[key] = (self.empty_score, [])
        return [made[key] for key in asked]

    def vote(self, found: list[tuple[float, int]]) -> float:
        """The score that neighbours (cosine, example) give."""
        near = np.array([k for _, k in found], np.int64)
        vote = np.array([s for s, _ in found]) * self.stands_for[near]
        return (float((vote * self.label[near]).sum()) + PRIOR * self.rate) / (float(vote.sum()) + PRIOR)

    def save(self, folder: str) -> str:
        """Writes the arrays to a new folder below ``folder`` and returns its path."""
        folder = f"{folder}/{uuid.uuid4().hex}"
        for field in fields(self):
            save_array(f"{folder}/{field.name}", getattr(self, field.name))
        return folder


def save_array(uri: str, values: np.ndarray) -> None:
    where, path = file_system(uri)
    where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with where.open_output_stream(path) as out:
        np.lib.format.write_array(out, np.ascontiguousarray(values), allow_pickle=False)


def load_array(uri: str) -> np.ndarray:
    where, path = file_system(uri)
    with where.open_input_file(path) as given:
        return np.lib.format.read_array(given, allow_pickle=False)


def load(folder: str, rows: bool = True) -> Model:
    """The model that ``fit`` wrote. A task loads it once; a worker does not keep it for the operators that follow.

    Without ``rows`` it only judges: ``term`` and ``weight`` are let go once they are in matrix and postings.
    """
    model = Model(*(load_array(f"{folder}/{field.name}") for field in fields(Model)))
    if not rows:
        model.term = model.weight = None
        release()
    return model


def telling(label: np.ndarray, owner: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
    """The likelihood ratio by which each of ``n`` terms tells the labels of the examples apart.

    ``owner`` and ``term`` say which example, by its place in ``label``, holds which term.
    """
    n1 = float(label.sum())
    n0 = len(label) - n1
    k1 = np.bincount(term, label[owner], minlength=n)
    k0 = np.bincount(term, minlength=n) - k1
    share = (k1 + k0) / len(label)
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = (
            np.where(k > 0, k * np.log(k / expected), 0.0)
            for k, expected in ((k1, share * n1), (k0, share * n0), (n1 - k1, (1 - share) * n1), (n0 - k0, (1 - share) * n0))
        )
        return np.maximum(2 * sum(gains), 0)


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> str:
    """Makes the model from ``labels`` (``doc_id``, ``toxic``) and the corpus they belong to; the folder it is in.

    Rows with a null label or id do not count; a document labelled twice counts as
    toxic if any row says so. Of equal texts one is an example. Without labels of
    both kinds there are no terms, and every score is the rate of the labels.

    The folder is a new one below the shared folder. One task lists the terms of at most 2 * ``examples``
    examples, all tasks count who holds them, one task weighs them; the driver sees paths and two counts alone.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "toxicity")
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = None
    for label in (0, 1):
        own = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
        picked = own if picked is None else picked.union(own)
    # at most 2 * examples rows of two numbers
    sample = docs.join(F.broadcast(picked), "doc_id")
    sample = sample.groupBy(F.sha2("text", 256).alias("same")).agg(
        F.min(F.struct("doc_id", "toxic", "text")).alias("one")
    ).select("one.*")

    def all_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, chars=PART_BYTES):
            found = [counted_terms([t])[1:] for t in texts]
            lists = (pa.array([x[k].view(np.int64) for x in found], pa.list_(pa.int64())) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], ["doc_id", "toxic", "terms", "counts"])

    held = sample.select("doc_id", "toxic", "text").mapInArrow(
        all_terms, "doc_id long, toxic int, terms array<long>, counts array<long>"
    )
    held.write.parquet(f"{folder}/examples")
    held = spark.read.parquet(f"{folder}/examples")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hashes, labels = np.zeros(0, np.uint64), set()
        for batch in batches:
            labels |= set(batch.column(0).to_pylist())
            hashes = np.union1d(hashes, batch.column(1).flatten().to_numpy().view(np.uint64))
        path = f"{folder}/{uuid.uuid4().hex}"
        save_array(path, hashes if len(labels) == 2 else hashes[:0])
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    terms = held.select("toxic", "terms").repartition(1).mapInArrow(listed, "path string").first()
    terms = terms.path if terms else None

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        number = load_array(terms) if terms else np.zeros(0, np.uint64)
        known, total = Known(number), np.zeros(len(number) + 1, np.int64)
        for _, texts in blocks(batches, chars=PART_BYTES):
            total[-1] += len(texts)
            for some in parts(texts):
                total[:-1] += np.bincount(counted_terms(some, known)[1], minlength=len(number))
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["term", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(holding, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # two sorts of rows for one task: examples, and counts with a null toxic
    rows = held.select("doc_id", "toxic", "terms", "counts").unionByName(
        counted.select(
            "term", F.lit(None).cast("int").alias("toxic"), F.array("term").alias("terms"), F.array("n").alias("counts")
        ).withColumnRenamed("term", "doc_id")
    )

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = load_array(terms) if terms else np.zeros(0, np.uint64)
        corpus, some = np.zeros(len(number) + 1, np.int64), []
        for batch in batches:
            count = np.asarray(batch.column(1).is_null())
            corpus[batch.column(0).to_numpy()[count]] = batch.column(3).filter(pa.array(count)).flatten().to_numpy()
            one = batch.filter(pa.array(~count))
            for key, y, t, n in zip(*(c.to_pylist() if k < 2 else c for k, c in enumerate(one.columns)), strict=True):
                some.append((key, y, t.values.to_numpy().view(np.uint64), n.values.to_numpy()))
        path = made(sorted(some, key=lambda x: x[0]), number, corpus, totals).save(folder)
        del some, corpus, number
        release()
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    model = rows.repartition(1).mapInArrow(weighed, "path string").first()
    return model.path


def made(held: list[tuple], number: np.ndarray, corpus: np.ndarray, totals: dict[int, int]) -> Model:
    """The model from examples (id, label, term hashes, counts) in order of their ids.

    ``number`` are the terms that count; ``corpus`` says how many documents hold each, and how many there are.
    """
    if not len(number):
        return weighted(held, number, corpus, totals, POWERS[0])
    wrong = [misjudged(held, number, corpus, totals, p) for p in POWERS]
    return weighted(held, number, corpus, totals, POWERS[wrong.index(min(wrong))])


def misjudged(held: list[tuple], number: np.ndarray, corpus: np.ndarray, totals: dict[int, int], power: float) -> float:
    """How many labelled documents are judged wrongly if each half of the examples is judged by the other.

    The halves are made within each label. An example counts as many documents as it stands for.
    """
    turn = {0: 0, 1: 0}
    halves = ([], [])
    for one in held:
        halves[turn[one[1]] % 2].append(one)
        turn[one[1]] += 1
    wrong = 0.0
    for judges, judged in (halves, halves[::-1]):
        model = weighted(judges, number, corpus, totals, power)
        for part in parts(judged):
            vectors = []
            for _, _, t, n in part:
                w = (1 + np.log(n)) * model.idf[at := np.searchsorted(number, t)]
                vectors.append((at, w / np.sqrt((w**2).sum()) if len(t) else w))
            for (_, y, t, _), found in zip(part, model.nearest_all(vectors), strict=True):
                score = model.vote(found) if len(t) else model.empty_score
                wrong += ((score >= 0.5) != y) * totals[y] / turn[y]
    return round(wrong, 6)


def weighted(held: list[tuple], number: np.ndarray, corpus: np.ndarray, totals: dict[int, int], power: float) -> Model:
    """``made`` with a given power of the likelihood ratios."""
    rate = totals.get(1, 0) / max(1, sum(totals.values()))
    label = np.array([y for _, y, *_ in held], np.int64)
    n1 = int(label.sum())
    n0 = len(label) - n1
    if not len(number):
        held = [(key, y, t[:0], n[:0]) for key, y, t, n in held]
    sizes = np.array([len(t) for _, _, t, _ in held], np.int64)
    owner = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
    none = np.zeros(0, np.uint64)
    term = np.searchsorted(number, np.concatenate([none, *(t for _, _, t, _ in held)])).astype(np.int32)
    counts = np.concatenate([none.astype(np.int64), *(n for *_, n in held)])
    idf = np.log((1 + corpus[-1]) / (1 + corpus[:-1])) + 1
    if len(number):
        idf *= telling(label, owner, term, len(number)) ** power + LEAST
    weight = {0: totals.get(0, 0) / max(1, n0), 1: totals.get(1, 0) / max(1, n1)}
    least_weight = min([w for w in weight.values() if w > 0], default=1.0)
    raw = (1 + np.log(counts)) * idf[term]
    vectors, begin = [], 0
    for (key, y, *_), size in zip(held, sizes.tolist(), strict=True):
        found, w = term[begin : begin + size], raw[begin : begin + size]
        vectors.append((key, y, found, w / np.sqrt((w**2).sum()) if size else w))
        begin += size
    bare = [(weight[y], y) for _, y, t, _ in vectors if not len(t)]
    bare_weight = sum(w for w, _ in bare)
    empty = (sum(w * y for w, y in bare) + least_weight * rate) / (bare_weight + least_weight)
    # examples with the same leading term lie together, so that block bounds are tight
    filled = sorted((x for x in vectors if len(x[2])), key=lambda x: (int(x[2][np.argmax(x[3])]), x[0]))
    return Model(
        number, idf,
        np.array([x[0] for x in filled], np.int64), np.array([x[1] for x in filled], np.int64),
        np.array([weight[x[1]] / least_weight for x in filled], np.float64),
        np.array([len(x[2]) for x in filled], np.int64),
        np.concatenate([np.zeros(0, np.int32), *(x[2] for x in filled)]),
        np.concatenate([np.zeros(0), *(x[3] for x in filled)]),
        np.array([rate, empty if len(held) else rate]),
    )


def score(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``evidence``: nearest examples and their cosines, by the model in a folder.

    A null text is empty; a text without any term of the examples gets the rate of
    such examples. In place: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("example", pa.int64()), ("cosine", pa.float64())]))
        release()
        loaded = load(model, rows=False)
        for part, texts in blocks(batches, chars=PART_BYTES):
            judged = loaded.judge_all(texts, part.column(0).to_pylist())
            evidence = [[{"example": k, "cosine": s} for k, s in found] for _, found in judged]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([s for s, _ in judged], pa.float64()), pa.array(evidence, kind)],
                ["doc_id", "score", "evidence"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, evidence array<struct<example: long, cosine: double>>"
    )


def with_score(docs: DataFrame, model: str, name: str = "toxicity_score") -> DataFrame:
    """``docs`` with all their columns and the score of each ``text`` as a further one."""
    key = docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        loaded = load(model, rows=False)
        for part, texts in blocks(batches, chars=PART_BYTES):
            judged = loaded.judge_all(texts, part.column(key).to_pylist())
            found = pa.array([s for s, _ in judged], pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, name])
        del loaded
        release()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
