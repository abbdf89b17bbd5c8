"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors are integers. A block of them is an index: for every dimension, postings of
the rows by quantised value. To a query, a posting segment (dimension and value
level) has an impact: the most it can add to a score, measured from the least its
dimension gives to any row. Segments are processed by falling impact, in a few
rounds. After each round

* the best rows so far are scored exactly: their k-th score is a threshold,
* no row can reach more than what it has gathered plus, for each dimension it has
  not been met in yet, the impact of the next segment.

Processing stops once that bound proves that so few rows can still reach the
threshold that scoring them exactly costs less than another round. Those rows are
scored exactly, so quantisation never decides a result.

The stated queries meet all rows in blocks: each block of rows goes with each block
of queries, once, and sends back k rows per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
ROWS, QUERIES = 8192, 1024
LEVELS = 16
#: Share of the rows that are scored exactly rather than processed further.
FEW = 0.03
ROUNDS = 8


class Index:
    """Postings of a block of integer vectors by dimension and quantised value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = self.vectors.min(0), self.vectors.max(0)
        # the width of a level is the same in a dimension, and at least 1
        self.width = np.maximum(1, -(-(self.high - self.low + 1) // LEVELS))
        level = (self.vectors - self.low) // self.width
        self.dims = self.vectors.shape[1]
        slot = (np.arange(self.dims) * LEVELS + level).T.ravel()
        row = np.tile(np.arange(len(ids)), self.dims)
        by_slot = np.argsort(slot, kind="stable")
        self.rows = row[by_slot]
        self.begin = np.searchsorted(slot[by_slot], np.arange(self.dims * LEVELS + 1))
        number = np.arange(LEVELS)
        self.least = self.low[:, None] + number * self.width[:, None]
        self.most = np.minimum(self.least + self.width[:, None] - 1, self.high[:, None])

    def top(self, query: np.ndarray, k: int, skip: int | None) -> list[tuple[int, int]]:
        """The k rows of highest (score, least id), without the row ``skip``; exact."""
        n = len(self.ids)
        usable = self.ids != skip if skip is not None else np.ones(n, bool)
        base = np.where(query > 0, query * self.low, query * self.high)  # the least of each dimension
        impact = np.where(query[:, None] > 0, query[:, None] * self.most, query[:, None] * self.least) - base[:, None]
        filled = np.diff(self.begin).reshape(self.dims, LEVELS) > 0
        dim, level = np.nonzero(filled)
        value = impact[dim, level]
        order = np.argsort(-value, kind="stable")
        dim, level, value = dim[order], level[order], value[order]
        size = self.begin[dim * LEVELS + level + 1] - self.begin[dim * LEVELS + level]
        done = np.cumsum(size)
        # what a row has gathered, and ``met_once``, more than all it can gather, for each
        # dimension it was met in; without room for both in a double, all rows are scored
        met_once = float(1 << int(impact.max(1).sum()).bit_length())
        state = np.zeros(n)
        candidates = np.flatnonzero(usable)
        at = 0
        for turn in range(1, ROUNDS if self.dims * met_once < 2.0**52 else 1):
            to = int(np.searchsorted(done, done[-1] * turn / ROUNDS, "right"))
            if to <= at:
                continue
            rows, gain = self._postings(dim[at:to], level[at:to], value[at:to])
            state += np.bincount(rows, gain + met_once, n)
            at = to
            met = np.floor(state[candidates] / met_once)
            gathered = state[candidates] - met * met_once
            # segments go by falling impact: none ahead has more than the next
            bound = gathered + (self.dims - met) * (value[at] if at < len(value) else 0)
            best = candidates[np.argpartition(-gathered, min(k, len(candidates)) - 1)[:k]]
            scores = self.vectors[best] @ query
            if len(scores) == k:
                candidates = candidates[bound >= scores.min() - base.sum()]
            if len(candidates) <= max(k, FEW * n):
                break
        scores = self.vectors[candidates] @ query
        best = np.lexsort((self.ids[candidates], -scores))[:k]
        return [(int(self.ids[candidates[b]]), int(scores[b])) for b in best]

    def _postings(self, dim, level, value):
        slot = dim * LEVELS + level
        size = self.begin[slot + 1] - self.begin[slot]
        place = np.cumsum(size)
        source = np.repeat(self.begin[slot] - (place - size), size) + np.arange(place[-1] if len(place) else 0)
        return self.rows[source], np.repeat(value, size).astype(np.float64)


def exact_top(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, k: int, skip: int | None) -> list[tuple[int, int]]:
    """As ``Index.top`` by integers of any size, for components whose products a long could not hold."""
    scores = [min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in vectors.astype(object) @ query.astype(object)]
    rows = sorted((-s, int(i)) for s, i in zip(scores, ids, strict=True) if i != skip)
    return [(i, -s) for s, i in rows[:k]]


def integer_vectors(vectors: DataFrame, column: str, scale: int = 256) -> DataFrame:
    """``vec_id`` and the vector with each component x as floor(scale * x).

    Vectors that are null or hold null, infinite or undefined components are left out.
    """
    value = F.col(column)
    sound = value.isNotNull() & F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(value, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).select("vec_id", whole.alias("vector"))


def search(queries: DataFrame, rows: DataFrame, k: int = K, skip_own: bool = True) -> DataFrame:
    """The k rows of highest inner product for every query.

    Both have ``vec_id`` and ``vector`` (integers, of one length). Returns
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; ties go to the smaller
    id; fewer rows than k, fewer results. With ``skip_own`` a query does not find
    rows of its own id. Vectors of another length than the query's have no score
    with it. Of rows with one id and vector each counts. Scores are exact whatever
    the components; one beyond a long's range is given as that range's end.
    """
    row_blocks = max(1, -(-rows.count() // ROWS))
    query_blocks = max(1, -(-queries.count() // QUERIES))

    def block(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    every = F.sequence(F.lit(0), F.lit(row_blocks - 1))
    asked = queries.select(
        F.explode(every).alias("row_block"), block(query_blocks).alias("query_block"), "vec_id", "vector",
        F.lit(True).alias("asks"),
    )
    every = F.sequence(F.lit(0), F.lit(query_blocks - 1))
    held = rows.select(
        block(row_blocks).alias("row_block"), F.explode(every).alias("query_block"), "vec_id", "vector",
        F.lit(False).alias("asks"),
    )

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        frame["size"] = frame["vector"].map(len)
        for size, own in frame.groupby("size"):
            asks = own["asks"].to_numpy()
            if not size or asks.all() or not asks.any():
                continue
            ids = own["vec_id"].to_numpy()[~asks]
            vectors = np.stack(own["vector"].to_numpy()[~asks]).astype(np.int64)
            # below it, sums of products stay in a long
            limit = 1 << (60 - int(size).bit_length()) // 2
            wide = ((vectors >= limit) | (vectors <= -limit)).any(1)
            index = Index(ids[~wide], vectors[~wide]) if not wide.all() else None
            for key, vector in zip(own["vec_id"].to_numpy()[asks], own["vector"].to_numpy()[asks], strict=True):
                query, skip = vector.astype(np.int64), key if skip_own else None
                if ((query >= limit) | (query <= -limit)).any():
                    found = exact_top(ids, vectors, query, k, skip)
                else:
                    found = index.top(query, k, skip) if index else []
                    if wide.any():
                        found += exact_top(ids[wide], vectors[wide], query, k, skip)
                out += [(key, i, s) for i, s in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    best = asked.union(held).groupBy("row_block", "query_block").applyInPandas(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
