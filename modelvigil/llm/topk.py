"""Exact top-k inner products by block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.llm.common import table

#: Documents of one range block, of one slice (the blocks a task holds), and queries of one chunk.
BLOCK, SLICE, QUERIES = 64, 8_192, 8_192
SCALE, K, EVERY = 256, 5, 50
#: Queries looked at together, and the share of blocks left to them above which one product scores all.
STRIP, DENSE = 256, 0.25
#: Sums up to this are exact in double precision.
_EXACT = 2.0**52


def usable(vector: str) -> Column:
    """True for a vector of at least one component, all of them finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros to the longest or to ``width``."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def _coherent(rows: np.ndarray) -> np.ndarray:
    """An order in which rows with the same strongest term, and like values of it, are neighbours, so that the ranges of
    a block's terms are narrow."""
    strongest = np.abs(rows).argmax(axis=1) if rows.size else np.zeros(len(rows), dtype=np.int64)
    value = rows[np.arange(len(rows)), strongest] if rows.size else strongest
    return np.lexsort((-value, value < 0, strongest))


def _best(score: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to smaller ids."""
    return np.lexsort((names, ~score if score.dtype.kind == "i" else -score))[:k]


def search_slice(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best ``k`` of a slice for each query: positions of queries, ids, scores, and the number of blocks scored.

    Rows are ordered by their strongest term and cut into range blocks. Each block keeps the largest and the smallest
    value of every term; the sum over a query's terms of the larger possible product bounds its scores there. Per query
    the block with the highest bound is scored first. Where the k-th score found there rules most other blocks out,
    the rest are taken by falling bound until the bound is below the k-th score so far; where it rules few out, for
    a strip of queries, all that is left is scored in one product. A bound that equals the k-th score is still looked
    at, for the sake of smaller ids.
    """
    arranged = _coherent(rows)
    ids, rows = ids[arranged], rows[arranged]
    starts = np.arange(0, len(rows), block)
    top, low = np.maximum.reduceat(rows, starts, axis=0), np.minimum.reduceat(rows, starts, axis=0)
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    exact = largest < _EXACT
    forward = rows.astype(np.float64) if exact else rows
    asked = queries.astype(np.float64) if exact else queries
    if exact:
        up, down = np.maximum(asked, 0), np.minimum(asked, 0)
        bounds = up @ top.T.astype(np.float64) + down @ low.T.astype(np.float64)
    else:  # products may wrap round like any long, so nothing can be pruned
        bounds = np.full((len(queries), len(starts)), np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    scored = 0

    def take(number: int, at: int, best: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = slice(starts[at], starts[at] + block)
        score, other = forward[own] @ asked[number], ids[own] != query_ids[number]
        best, names = np.concatenate([best, score[other]]), np.concatenate([names, ids[own][other]])
        keep = _best(best, names, k)
        return best[keep], names[keep]

    for a in range(0, len(asked), STRIP):
        strip = range(a, min(a + STRIP, len(asked)))
        first = bounds[strip].argmax(axis=1)
        begun = [take(number, at, forward[:0, 0], ids[:0]) for number, at in zip(strip, first)]
        least = [best[-1] if len(best) == k else None for best, _ in begun]
        left = np.array([bounds[n] >= floor if floor is not None else np.ones(len(starts), dtype=bool) for n, floor in zip(strip, least)])
        if left.mean() > DENSE:
            scored += int(left.sum())
            score = asked[strip] @ forward.T
            hit = np.array([row >= floor if floor is not None else np.ones(len(row), dtype=bool) for row, floor in zip(score, least)])
            hit &= ids != query_ids[strip][:, None]
            for number, row, own in zip(strip, score, hit):
                best, names = row[own], ids[own]
                keep = _best(best, names, k)
                found.append((np.full(len(keep), number), names[keep], best[keep]))
            continue
        for number, at, (best, names), own in zip(strip, first, begun, left):
            scored += 1
            rest = np.flatnonzero(own)
            for other in rest[np.argsort(-bounds[number, rest], kind="stable")].tolist():
                if len(best) == k and bounds[number, other] < best[-1]:
                    break
                if other != at:
                    scored += 1
                    best, names = take(number, other, best, names)
            found.append((np.full(len(best), number), names, best))
    query, names, score = (np.concatenate(part) for part in zip(*found))
    return query, names, score.astype(np.int64), scored


_FOUND = "query_id long, vec_id long, score long"
_FOUND_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = K, slice_rows: int = SLICE, chunk: int = QUERIES, block: int = BLOCK
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` rows with the largest inner product for each
    query, or all if there are fewer.

    ``rows`` and ``queries`` have ``vec_id`` (long) and ``terms`` (array of longs; a shorter one counts as filled up
    with zeros); other columns are not read. A query's own id is no candidate for it. Ties go to the smaller id.
    Rows with a null id or null terms take no part; a repeated row is a candidate as often as it comes, of queries
    with one id any one is asked. No rows or no queries give no result. Scores wrap round like any long where a sum
    exceeds 64 bits.

    Rows are dealt by hash to slices of about ``slice_rows`` and queries to chunks of about ``chunk``; each slice
    meets each chunk in one task of bounded size, which returns ``k`` rows a query. A ranked window merges the
    slices of a query. Equal rows are counted first, and at most ``k`` of them are carried on, as no more can win.
    """
    sound = F.col("vec_id").isNotNull() & F.col("terms").isNotNull()
    asked = queries.where(sound).select("vec_id", "terms").dropDuplicates(["vec_id"])
    counted = rows.where(sound).groupBy("vec_id", "terms").agg(F.count(F.lit(1)).alias("n"))
    slices = max(1, -(-rows.where(sound).count() // slice_rows))
    chunks = max(1, -(-asked.count() // chunk))
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")))
    left = counted.withColumn("copy", copies).select(
        "vec_id", "terms",
        F.pmod(F.xxhash64("vec_id", "terms", "copy"), F.lit(slices)).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )
    right = asked.select(
        "vec_id", "terms",
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"),
    )

    def search(own: pa.Table, other: pa.Table) -> pa.Table:
        if not own.num_rows or not other.num_rows:
            return _FOUND_OUT.empty_table()
        ids, names = own.column("vec_id").to_numpy(), other.column("vec_id").to_numpy()
        asked_rows = _matrix(other.column("terms"))
        matrix = _matrix(own.column("terms"), asked_rows.shape[1])
        asked_rows = _matrix(other.column("terms"), matrix.shape[1])
        order = np.argsort(ids, kind="stable")
        query, found, score, _ = search_slice(ids[order], matrix[order], names, asked_rows, k, block)
        return pa.table({"query_id": names[query], "vec_id": found, "score": score}, schema=_FOUND_OUT)

    found = left.groupBy("slice", "chunk").cogroup(right.groupBy("slice", "chunk")).applyInArrow(search, _FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``terms``: floor(scale * component), each in double; unusable vectors are left out."""
    terms = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    usable_ = vectors.where(usable("embedding"))
    return usable_.select(F.col("vec_id").cast("long").alias("vec_id"), terms.alias("terms"))


def op1_topk(spark, folder: str) -> DataFrame:
    rows = scaled(table(spark, folder, "embeddings"))
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))


ORACLE = f"""
WITH terms AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS terms
    FROM embeddings
    WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, r.vec_id,
           CAST(list_sum(list_transform(list_zip(q.terms, r.terms), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM terms q JOIN terms r ON q.vec_id <> r.vec_id
    WHERE q.vec_id % {EVERY} = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
           vec_id, score
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
