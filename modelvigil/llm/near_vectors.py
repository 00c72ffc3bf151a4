"""Near-duplicate vectors by collision-counting projections."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from modelvigil.llm.common import release_worker_memory, slices, table
from modelvigil.llm.components import connected_components
from modelvigil.session import stored

COSINE = 0.95
#: Projections counted, and how many of them have been counted at each look at the pairs still in question.
PROJECTIONS, LOOKS = 128, (64, 128)
#: Chance that a pair at exactly the wanted cosine falls short of the count, at each look.
MISS = 1e-5
#: Chance that a pair at exactly the wanted cosine shares no bucket.
APART = 4e-5
#: Vectors of one bucket, as planned; buckets of more than ``PIECE`` times that are cut into pieces that meet in pairs.
BLOCK, PIECE = 4_096, 8
#: Directions on each side of a bucket, at most, and bits of a bucket's number.
MOST_SIDES, BUCKET_BITS = 512, 20
#: Groups of vectors all near one centre: how many, rows that make one, rows whose mean is the centre.
CENTRES, CENTRE_ROWS, CENTRE_MEAN = 4_096, 32, 16
#: Rows that leave a task at a time, and ids that are broadcast at most.
OUT_ROWS, FEW_IDS = 100_000, 1_000_000
SEED = 20_250


def needed_counts(cosine: float = COSINE, looks: tuple[int, ...] = LOOKS, miss: float = MISS) -> list[int]:
    """Collisions that a pair must have at each look.

    Two vectors collide on a Gaussian direction if their projections have one sign, which happens with chance
    ``1 - angle / pi``. The count of a pair at the wanted cosine is thus binomial; closer pairs collide more often.
    The largest count that such a pair misses with at most ``miss``.
    """
    p = 1 - math.acos(cosine) / math.pi
    counts = []
    for n in looks:
        below, count = 0.0, 0
        while (below := below + math.comb(n, count) * p**count * (1 - p) ** (n - count)) <= miss:
            count += 1
        counts.append(count)
    return counts


def directions(width: int, count: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """The same Gaussian directions in every task."""
    return np.random.default_rng(seed).standard_normal((count, width)).T


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def sign_bits(units: np.ndarray) -> np.ndarray:
    """The signs of the projections of each vector, 64 in a number: a row of numbers for each look."""
    signs = units @ directions(units.shape[1]) >= 0
    return np.ascontiguousarray(np.packbits(signs, axis=1).view(">u8").T.astype(np.uint64))


def colliding(left: np.ndarray, right: np.ndarray, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs with enough collisions, given signs; those short of them at one look are not counted on."""
    apart = np.bitwise_count(left[0][:, None] ^ right[0]).ravel()
    at = np.flatnonzero(apart <= LOOKS[0] - counts[0])  # several times as fast as nonzero() of a table
    apart = apart[at]
    a, b = np.divmod(at, max(right.shape[1], 1))
    for k in range(1, len(LOOKS)):
        apart = apart + np.bitwise_count(left[k][a] ^ right[k][b])
        passed = np.flatnonzero(apart <= LOOKS[k] - counts[k])
        a, b, apart = a[passed], b[passed], apart[passed]
    return a, b


def linked_pairs(
    left: np.ndarray, right: np.ndarray | None, cosine: float = COSINE, strip: int = 64
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of unit vectors with at least this cosine; ``right`` None: pairs within ``left``.

    For a strip of queries, the collisions of each pair are counted; what passes the last count is verified.
    """
    other = left if right is None else right
    if not len(left) or not len(other):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    counts, own, bits = needed_counts(cosine), sign_bits(left), sign_bits(other)
    found_a, found_b = [], []
    for at in range(0, len(left), strip):
        a, b = colliding(own[:, at : at + strip], bits, counts)
        a += at
        if right is None:
            a, b = a[b > a], b[b > a]
        near = np.einsum("ij,ij->i", left[a], other[b]) >= cosine
        found_a.append(a[near])
        found_b.append(b[near])
    return np.concatenate(found_a), np.concatenate(found_b)


def best_buckets(first: np.ndarray, second: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` pairs of a first and a second direction with the largest sums of projections, best first."""
    sides = first.shape[1]
    probes, top = min(probes, sides * second.shape[1]), min(probes, sides)

    def largest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.argpartition(values, sides - top, axis=1)[:, sides - top :] if top < sides else np.argsort(values, axis=1)
        return at, np.take_along_axis(values, at, 1)

    (i, x), (j, y) = largest(first), largest(second)
    sums = (x[:, :, None] + y[:, None, :]).reshape(len(first), -1)
    names = (i[:, :, None] * sides + j[:, None, :]).reshape(len(first), -1)
    return np.take_along_axis(names, np.argsort(-sums, axis=1, kind="stable")[:, :probes], 1)


@functools.lru_cache(maxsize=64)
def bucket_plan(cosine: float, sides: int, trials: int = 20_000) -> tuple[int, int]:
    """Tables, and buckets of a vector in each, with which a pair at the cosine shares none with chance ``APART``.

    The projections of two unit vectors on Gaussian directions are normal variables with the cosine as correlation,
    in any space and whatever the vectors; so drawn projections tell the chance. Closer pairs share more.
    """
    if sides == 1:
        return 1, 1
    rng, most, missed = np.random.default_rng(SEED), min(16, sides * sides), np.zeros(17)
    for _ in range(trials // 1_000):
        one = rng.standard_normal((2, 1_000, sides))
        two = cosine * one + math.sqrt(1 - cosine * cosine) * rng.standard_normal(one.shape)
        a, b = best_buckets(*one, most), best_buckets(*two, most)
        shared = a[:, :, None] == b[:, None, :]
        place = np.maximum(np.arange(most)[:, None], np.arange(most))
        least = np.where(shared, place, most).min(axis=(1, 2))  # with more probes than that they meet
        missed[1 : most + 1] += (least[:, None] >= np.arange(1, most + 1)).sum(axis=0)
    missed = np.maximum(missed, 1) / trials  # what was never seen may happen once
    plans = [
        (tables * probes, tables * probes * probes, tables, probes)
        for tables in (2, 3, 4) for probes in range(1, most + 1) if missed[probes] ** tables <= APART
    ]
    return min(plans)[2:] if plans else (4, most)


def planned_buckets(rows: int, cosine: float, block: int) -> tuple[int, int, int]:
    """Directions on each side, tables and probes for so many vectors: about half a block of them in a bucket."""
    sides = 1
    while sides < MOST_SIDES and rows > block and bucket_plan(cosine, sides)[1] * rows / sides**2 > block / 2:
        sides *= 2
    return sides, *bucket_plan(cosine, sides)


def bucket_names(units: np.ndarray, sides: int, tables: int, probes: int) -> np.ndarray:
    """The buckets of each vector, numbered over all tables; the best one of the first table comes first."""
    if sides == 1:
        return np.zeros((len(units), 1), dtype=np.int32)
    axes = directions(units.shape[1], 2 * sides * tables, SEED + 1).astype(np.float32)
    places = (units.astype(np.float32) @ axes).reshape(len(units), 2 * tables, sides)
    each = [best_buckets(places[:, 2 * t], places[:, 2 * t + 1], probes) + t * sides * sides for t in range(tables)]
    return np.concatenate(each, axis=1).astype(np.int32)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """Whole numbers of 31 bits in no order."""
    return (values.astype(np.int64).view(np.uint64) * _MIX >> np.uint64(33)).astype(np.int64)


def first_buckets(buckets: np.ndarray) -> np.ndarray:
    """Three buckets of each row, the first ones in mixed order, in one number."""
    order = np.argsort(mixed(buckets.ravel()).reshape(buckets.shape), axis=1, kind="stable")
    few = np.take_along_axis(buckets, order[:, np.minimum([0, 1, 2], buckets.shape[1] - 1)], 1).astype(np.int64)
    return few[:, 0] | few[:, 1] << BUCKET_BITS | few[:, 2] << 2 * BUCKET_BITS


def met_before(a: np.ndarray, b: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """True where two numbers of :func:`first_buckets` share a bucket before this one: the pair was counted there.

    The first bucket of all that a pair shares never has one before it, so no pair is left out; one that shares none
    of those three may be found again.
    """
    mask, now, out = (1 << BUCKET_BITS) - 1, mixed(bucket), np.zeros(len(a), dtype=bool)
    for i in range(3):
        x = a >> i * BUCKET_BITS & mask
        for j in range(3):
            out |= (x == b >> j * BUCKET_BITS & mask) & (mixed(x) < now)
    return out


class Balls:
    """Centres, and which vectors lie within half the wanted angle of one: any two of those are linked."""

    def __init__(self, centres: np.ndarray, cosine: float, plan: tuple[int, int, int]):
        self.centres, self.probes = centres, plan[2]
        self.least = math.sqrt((1 + cosine) / 2) + 1e-9
        names = bucket_names(centres, *plan)[:, : self.probes] if len(centres) else np.zeros((0, self.probes))
        order = np.argsort(names.ravel(), kind="stable")
        self.names, self.of = names.ravel()[order], order // self.probes

    def of_units(self, units: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """The number of the nearest centre that shares a bucket of the first table, from 1; 0 if none is near."""
        out = np.zeros(len(units), dtype=np.int32)
        if not len(self.centres):
            return out
        best = np.full(len(units), self.least)
        for asked in buckets[:, : self.probes].T:
            low, high = (np.searchsorted(self.names, asked, side=side) for side in ("left", "right"))
            for k in range(int((high - low).max(initial=0))):
                row = np.flatnonzero(high - low > k)
                at = self.of[low[row] + k]
                near = np.einsum("ij,ij->i", units[row], self.centres[at])
                better = near > best[row]
                out[row[better]], best[row[better]] = at[better] + 1, near[better]
        return out


def ball_centres(cells: np.ndarray, counts: np.ndarray, units: np.ndarray, cosine: float) -> np.ndarray:
    """Means of the vectors of each cell, cells of many vectors first, without those near one before."""
    names, first = np.unique(cells, return_index=True)
    order = np.argsort(cells, kind="stable")
    starts = np.searchsorted(cells[order], names)
    means = np.add.reduceat(units[order], starts, axis=0) if len(names) else units[:0]
    lengths = np.linalg.norm(means, axis=1)
    sound = lengths > 0
    means, many = means[sound] / lengths[sound, None], counts[first][sound]
    means = means[np.lexsort((names[sound], -many))]
    close, kept = math.cos(math.acos(cosine) / 4), np.ones(len(means), dtype=bool)
    for i in range(len(means)):
        if kept[i]:
            kept[i + 1 :] &= means[i + 1 :] @ means[i] < close
    return means[kept]


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, some at a time, but those of one value together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        last = int(np.searchsorted(key, key[-1], side="left"))
        if last or (held and held[0].column(0)[0].as_py() != key[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def tiles(left: np.ndarray, right: np.ndarray | None, strip: int = 64, reach: int = 4_096) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of rows that meet, given their ball numbers in order: rows of one ball do not, rows of none all do.

    ``right`` None: rows within ``left``, where a range also holds pairs in which the first row is not before.
    """
    other = left if right is None else right
    for s, e in zip(starts := np.flatnonzero(np.diff(left, prepend=-1)), [*starts[1:], len(left)]):
        for at in range(s, e, strip):
            if right is None:
                ranges = [(at if left[s] == 0 else e, len(other))]
            elif left[s] == 0:
                ranges = [(0, len(other))]
            else:
                ranges = [(0, int(np.searchsorted(other, left[s], "left"))), (int(np.searchsorted(other, left[s], "right")), len(other))]
            for low, high in ranges:
                for b in range(low, high, reach):
                    yield int(at), int(min(at + strip, e)), int(b), int(min(b + reach, high))


_UNIT = "unit long, vec_id long, copies long, d1 long, d2 long, vector binary, s1 long, s2 long, buckets binary"
_DEALT = "key long, unit long, s1 long, s2 long, first long, ball int"
_SCHEMAS = {
    "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _SCHEMAS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of the array as its bytes."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    offsets = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(size))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(rows)])


def _rows(column: pa.Array, kind: str) -> np.ndarray:
    """What :func:`_binary` made bytes of; not of no rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _mapped(df: DataFrame, work, ddl: str, sliced: bool = True) -> DataFrame:
    """Run ``work`` over the record batches of ``df``; it yields dicts of the columns of ``ddl``."""
    names, out = df.columns, _schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_memory()
        batches = (batch.rename_columns(names) for batch in batches)
        for columns in work(slices(batches, 1_000_000) if sliced else batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, ddl)


def _coded(distinct: DataFrame, width: int, kind: str, plan: tuple[int, int, int]) -> DataFrame:
    """Signs and buckets of each vector, and the vector as bytes, short ones filled up with zeros."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            lists = batch.column("vector")
            lengths = np.diff(lists.offsets.to_numpy())
            rows = np.zeros((len(lengths), width), dtype=kind)
            rows[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            units = unit_rows(rows)
            signs = sign_bits(units).view(np.int64)
            yield {name: batch.column(name) for name in ("unit", "vec_id", "copies", "d1", "d2")} | {
                "vector": _binary(rows), "s1": signs[0], "s2": signs[1],
                "buckets": _binary(bucket_names(units, *plan)),
            }

    return _mapped(distinct, work, _UNIT)


def _centres(units: DataFrame, rows: int, width: int, kind: str, cosine: float) -> np.ndarray:
    """Centres of balls, from the cells of equal leading signs that hold many vectors.

    A cell has some bits more than vectors that have nothing in common would need to be alone in one. Only where the
    centres lie depends on which vectors of a cell are looked at; what is near one is found among all.
    """
    bits = min(48, max(8, math.ceil(math.log2(rows + 1)) + 1))
    cell = F.shiftrightunsigned("s1", 64 - bits)
    many = units.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CENTRE_ROWS)
    many = many.orderBy(F.desc("n"), "cell").limit(CENTRES).collect()
    if not many:
        return np.zeros((0, width))
    counts = units.sparkSession.createDataFrame(many, "cell long, n long")
    few = F.pmod(F.xxhash64("unit", F.lit(SEED)), F.lit(1 << 30)).cast("double") * F.col("n") < F.lit(float(CENTRE_MEAN << 30))
    picked = units.select(cell.alias("cell"), "unit", "vector").join(F.broadcast(counts), "cell").where(few)
    found = picked.select("cell", "n", "vector").collect()
    if not found:
        return np.zeros((0, width))
    vectors = unit_rows(_rows(pa.array([r.vector for r in found], pa.binary()), kind))
    return ball_centres(np.array([r.cell for r in found], dtype=np.int64), np.array([r.n for r in found], dtype=np.int64), vectors, cosine)


class Pieces:
    """How the rows of large buckets are cut: a ball with many rows there has pieces of its own, all others share some.

    Each piece meets all others of its bucket and itself, but the pieces of a ball do not meet one another.
    """

    def __init__(self, counts: list[tuple[int, int, int]], limit: int):
        self.parts: dict[tuple[int, int], tuple[int, int]] = {}
        self.total: dict[int, int] = {}
        for bucket, ball, n in sorted(counts):  # ball 0: all that have no pieces of their own
            start, parts = self.total.get(bucket, 0), -(-n // limit)
            self.parts[bucket, ball], self.total[bucket] = (start, parts), start + parts
        self.buckets = np.array(sorted(self.total), dtype=np.int64)

    def of_rows(self, bucket: np.ndarray, ball: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each row's piece, the pieces of its bucket, and the first one and the number of those it does not meet."""
        mine, start, out, total = np.zeros((4, len(bucket)), dtype=np.int64)
        total += 1
        if not len(self.buckets):
            return mine, total, start, out
        at = np.flatnonzero(self.buckets[np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)] == bucket)
        names, which = np.unique(np.stack([bucket[at], ball[at].astype(np.int64)]), axis=1, return_inverse=True)
        found = []
        for x, y in names.T.tolist():
            own = y > 0 and (x, y) in self.parts
            first, parts = self.parts.get((x, y if own else 0), (0, 1))
            found.append((first, max(parts, 1), self.total[x], parts if own else 0))
        first, parts, total[at], out[at] = np.array(found, dtype=np.int64).reshape(-1, 4)[which.ravel()].T
        mine[at], start[at] = first + mixed(unit[at]) % parts, first
        return mine, total, start, out


def _marked(units: DataFrame, balls: Balls, kind: str, plan: tuple[int, int, int]) -> DataFrame:
    """The vectors in a ball (``bucket`` null), and for each bucket the rows ``n`` of each ball and of none."""
    sides, tables, _ = plan

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        alone, inside = np.zeros(tables * sides * sides, dtype=np.int64), np.zeros((3, 0), dtype=np.int64)
        for batch in batches:
            buckets = _rows(batch.column("buckets"), "i4")
            number = np.zeros(len(buckets), dtype=np.int32)
            if len(balls.centres):
                number = balls.of_units(unit_rows(_rows(batch.column("vector"), kind)), buckets)
            alone += np.bincount(buckets[number == 0].ravel(), minlength=len(alone))
            at = np.flatnonzero(number)
            if len(at):
                more = [buckets[at].ravel(), np.repeat(number[at], buckets.shape[1]), np.ones(buckets[at].size)]
                inside = np.concatenate([inside, np.stack(more).astype(np.int64)], axis=1)
                names, which = np.unique(inside[:2], axis=1, return_inverse=True)
                inside = np.concatenate([names, np.bincount(which.ravel(), inside[2])[None].astype(np.int64)])
                yield {name: batch.column(name).take(pa.array(at)) for name in ("vec_id", "copies")} | {
                    "ball": number[at], "bucket": pa.nulls(len(at), pa.int64()), "n": pa.nulls(len(at), pa.int64()),
                }
        at = np.flatnonzero(alone)
        counts = np.concatenate([np.stack([at, np.zeros_like(at), alone[at]]), inside], axis=1)
        none = pa.nulls(counts.shape[1], pa.int64())
        yield {"vec_id": none, "copies": none, "ball": counts[1].astype(np.int32), "bucket": counts[0], "n": counts[2]}

    read = units.select("vec_id", "copies", "buckets", *["vector"] * bool(len(balls.centres)))
    return _mapped(read, work, "vec_id long, copies long, ball int, bucket long, n long")


def _pieces(marked: DataFrame, limit: int) -> Pieces:
    """Pieces of the buckets with more than ``limit`` rows."""
    sums = marked.where(F.col("bucket").isNotNull()).groupBy("bucket", "ball").agg(F.sum("n").alias("n"))
    own = (F.col("ball") > 0) & (F.col("n") > limit)
    large = sums.groupBy("bucket").agg(
        F.sum("n").alias("total"), F.sum(F.when(~own, F.col("n"))).alias("rest"),
        F.collect_list(F.when(own, F.struct("ball", "n"))).alias("own"),
    ).where(F.col("total") > limit)
    counts = []
    for r in large.collect():
        counts += [(r.bucket, 0, r.rest or 0), *((r.bucket, x.ball, x.n) for x in r.own)]
    return Pieces(counts, limit)


def _dealt(units: DataFrame, balls: Balls, kind: str, pieces: Pieces) -> DataFrame:
    """A row for each bucket of a vector; in a bucket of pieces, one for each piece that its own meets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            buckets = _rows(batch.column("buckets"), "i4")
            number = np.zeros(len(buckets), dtype=np.int32)
            if len(balls.centres):
                number = balls.of_units(unit_rows(_rows(batch.column("vector"), kind)), buckets)
            unit, s1, s2 = (batch.column(name).to_numpy() for name in ("unit", "s1", "s2"))
            first = first_buckets(buckets)
            bucket = buckets.ravel().astype(np.int64)
            owner = np.repeat(np.arange(len(unit)), buckets.shape[1])
            mine, total, start, out = pieces.of_rows(bucket, number[owner], unit[owner])
            copies = total - out
            ends = np.cumsum(copies)
            for a in range(0, int(ends[-1]), OUT_ROWS):
                row = np.arange(a, min(a + OUT_ROWS, int(ends[-1])))
                at = np.searchsorted(ends, row, side="right")
                other = row - (ends[at] - copies[at])
                other += np.where(other >= start[at], out[at], 0)
                i = owner[at]
                key = bucket[at] | np.minimum(mine[at], other) << BUCKET_BITS | np.maximum(mine[at], other) << 2 * BUCKET_BITS
                yield {"key": key, "unit": unit[i], "s1": s1[i], "s2": s2[i], "first": first[i], "ball": number[i]}

    return _mapped(units.select("unit", "s1", "s2", "buckets", *["vector"] * bool(len(balls.centres))), work, _DEALT)


def _candidates(dealt: DataFrame, cosine: float, pieces: Pieces) -> DataFrame:
    """Pairs ``a`` < ``b`` of units with enough collisions, from rows sorted by bucket; some more than once."""
    counts, mask = needed_counts(cosine), (1 << BUCKET_BITS) - 1

    def met(rows: list[np.ndarray], key: int) -> Iterator[tuple[np.ndarray, ...]]:
        unit, signs, first, ball = rows
        bucket, low, high = key & mask, key >> BUCKET_BITS & mask, key >> 2 * BUCKET_BITS
        side = np.zeros(len(unit), dtype=bool)
        if low < high:
            side = pieces.of_rows(np.full(len(unit), bucket), ball, unit)[0] == high
        order = np.lexsort((unit, ball, side))
        unit, signs, first, ball = unit[order], signs[:, order], first[order], ball[order]
        n = int((~side).sum())
        for s, e, b, c in tiles(ball[:n], ball[n:] if low < high else None):
            if low < high:
                b, c = b + n, c + n
            x, y = colliding(signs[:, s:e], signs[:, b:c], counts)
            if len(x):
                x, y = x + s, y + b
                x, y = x[y > x], y[y > x]
                yield unit[x], unit[y], first[x], first[y], np.full(len(x), bucket)

    def new(found: list[tuple[np.ndarray, ...]]) -> dict:
        x, y, one, two, bucket = (np.concatenate(part) for part in zip(*found))
        first = ~met_before(one, two, bucket)
        return {"a": np.minimum(x, y)[first], "b": np.maximum(x, y)[first]}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        kept, many = [], 0
        for rows in groups(batches):
            key, unit, s1, s2, first, ball = (rows.column(name).to_numpy() for name in _schema(_DEALT).names)
            signs = np.stack([s1, s2]).view(np.uint64)
            starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
            for s, e in zip(starts, [*starts[1:], len(key)]):
                if e - s > 1:
                    for found in met([unit[s:e], signs[:, s:e], first[s:e], ball[s:e]], int(key[s])):
                        kept.append(found)
                        many += len(found[0])
                        if many >= OUT_ROWS:
                            yield new(kept)
                            kept, many = [], 0
        if kept:
            yield new(kept)

    sorted_rows = dealt.repartition("key").sortWithinPartitions("key")
    return _mapped(sorted_rows, work, "a long, b long", sliced=False)


def _verified(pairs: DataFrame, kind: str, cosine: float) -> DataFrame:
    """The pairs whose vectors have at least the cosine."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            left, right = (unit_rows(_rows(batch.column(name), kind)) for name in ("x", "y"))
            near = pa.array(np.einsum("ij,ij->i", left, right) >= cosine)
            yield {name: batch.column(name).filter(near) for name in ("u", "v", "u_copies", "v_copies")}

    return _mapped(pairs, work, "u long, v long, u_copies long, v_copies long")


def _sound(vector: str) -> Column:
    """True for vectors of finite components that are not all zero.

    Extremes are compiled, and NaN counts as the largest value; a function of each component is several times as slow.
    """
    low, high = F.array_min(vector), F.array_max(vector)
    finite = ~F.isnan(high) & (high < float("inf")) & (low > float("-inf"))
    return F.coalesce(finite & ((low != 0) | (high != 0)) & ~F.exists(vector, lambda x: x.isNull()), F.lit(False))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors`` (``vec_id``, ``embedding``).

    Two rows link if their cosine in double precision is at least ``cosine``; nothing below it links, and a pair at
    exactly that cosine is missed with a chance of about one in 15,000. Vectors that are null, empty, zero or hold
    null or non-finite components, and rows with a null id, link with nothing. A shorter vector counts as filled up
    with zeros. Rows that repeat an id are rows of their own. Other columns are not read.

    Equal vectors are one row with a number of copies. A bucket is a pair of Gaussian directions; each distinct vector
    goes, as its signs on other directions, to the buckets with its largest projections, some in each of a few
    independent tables, so many that pairs at the cosine share one. Inside a bucket, of about half a ``block``,
    the collisions of signs are counted; pairs with enough of them are verified on their vectors. Vectors within half
    the angle of a common centre are all linked and do not meet, so large groups of near copies are not compared.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    rows = rows.withColumn("vector", F.when(_sound("embedding") & F.col("vec_id").isNotNull(), F.col("embedding")))
    kind = "f4" if isinstance(rows.schema["embedding"].dataType.elementType, FloatType) else "f8"
    n, width = rows.agg(F.count("vector"), F.max(F.size("vector"))).first()
    width = max(width or 1, 1)
    plan = planned_buckets(n, cosine, block)

    def digest(seed: int) -> Column:
        return F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(seed), "vector"))

    distinct = rows.where(F.col("vector").isNotNull()).groupBy("vector").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")
    )
    distinct = distinct.select(
        F.monotonically_increasing_id().alias("unit"), "vec_id", "copies", digest(1).alias("d1"), digest(2).alias("d2"), "vector"
    )
    units = stored(_coded(distinct, width, kind, plan), "near-vectors")
    balls = Balls(_centres(units, n, width, kind, cosine), cosine, plan)
    marked = stored(_marked(units, balls, kind, plan), "near-balls")
    pieces = _pieces(marked, max(PIECE * block, n * plan[1] * plan[2] // 100_000))

    found = stored(_candidates(_dealt(units, balls, kind, pieces), cosine, pieces).distinct(), "near-pairs")
    ends = found.select(F.col("a").alias("unit")).union(found.select(F.col("b").alias("unit"))).distinct()
    ends = F.broadcast(ends) if ends.count() <= FEW_IDS else ends
    few = stored(units.select("unit", "vec_id", "copies", "vector").join(ends, "unit", "left_semi"), "near-ends")
    pairs = found.join(few.toDF("a", "u", "u_copies", "x"), "a").join(few.toDF("b", "v", "v_copies", "y"), "b")
    links = _verified(pairs.select("u", "v", "u_copies", "v_copies", "x", "y"), kind, cosine)
    links = stored(
        links.select(F.col("u").alias("vec_id"), F.col("v_copies").alias("links"), F.col("v").alias("root"))
        .union(links.select("v", "u_copies", "u")), "near-links"
    )
    if len(balls.centres):
        members = marked.where(F.col("bucket").isNull()).select("vec_id", "copies", "ball")
        sums = members.groupBy("ball").agg(F.sum("copies").alias("total"), F.min("vec_id").alias("root"), F.count(F.lit(1)).alias("n"))
        inside = members.join(F.broadcast(sums.where(F.col("n") > 1)), "ball")
        links = links.union(inside.select("vec_id", (F.col("total") - F.col("copies")).alias("links"), "root"))

    components = connected_components(links.select(F.col("vec_id").alias("u"), F.col("root").alias("v")))
    linked = links.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("links"))
    labels = (
        units.select("d1", "d2", F.col("vec_id").alias("rep"), "copies")
        .join(linked, "rep", "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .where(F.col("links").isNotNull() | (F.col("copies") > 1))  # others are alone
        .select("d1", "d2", F.coalesce("links", F.lit(0)).alias("links"), "copies", F.coalesce("component", "rep").alias("component"))
    )
    component = F.coalesce("component", "vec_id")
    ids = rows.select("vec_id", digest(1).alias("d1"), digest(2).alias("d2"))
    return ids.join(labels, ["d1", "d2"], "left").select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op2_near_vectors(spark, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


ORACLE = f"""
WITH RECURSIVE sound AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
    FROM embeddings
    WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v
    FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach AS (
    SELECT vec_id AS node, vec_id AS other FROM embeddings
    UNION
    SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.other),
components AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
degrees AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT e.vec_id, coalesce(d.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e
JOIN components c ON c.node = e.vec_id
LEFT JOIN degrees d ON d.u = e.vec_id
"""
