"""SimHash fingerprints of word shingles and near duplicates by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from modelvigil.llm.common import map_columns, quoted, table
from modelvigil.llm.components import connected_components
from modelvigil.session import materialise

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Bits of the blocks of a fingerprint. Two that differ in at most 3 bits agree in at least 2 of 5 blocks.
BLOCKS = (13, 13, 13, 13, 12)
AGREE = len(BLOCKS) - RADIUS
#: Fingerprints of one bucket compared in one piece; larger buckets are cut and their pieces compared in pairs.
PIECE = 8_192
#: Rows whose bit planes are held at a time.
PLANE_ROWS = 65_536

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: each is set if it is set in over half of the XXH64 values of the text's word shingles.

    A-Z are lower-cased, words end at ASCII white space. Fewer words than a shingle are hashed as they are; no word
    (or a null text) gives zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        some = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``print`` (the fingerprint's 64 bits as a long) of every row."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "print": [_signed(fingerprint(t)) for t in batch["text"]]}

    out = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    return map_columns(docs, columns, "doc_id long, print long", work, out)


def close_lanes(planes: list[int], shift: int, lanes: int, radius: int = RADIUS) -> int:
    """Bit ``i`` is set if rows ``i`` and ``i + shift`` differ in at most ``radius`` (1 to 3) bits.

    ``planes[k]`` holds bit ``k`` of all rows, one row a lane; ``lanes`` marks the rows to compare. The distances of
    all lanes are counted at once in carry-save form, and the count ends when no lane is left within the radius.
    """
    ones = twos = 0
    alive = lanes
    for plane in planes:
        differs = (plane ^ (plane >> shift)) & alive
        if not differs:
            continue
        carry = ones & differs
        ones ^= differs
        over = twos & carry
        twos ^= carry
        if radius < 3:
            over |= twos & ones if radius == 2 else twos
        alive &= ~over
        if not alive:
            return 0
    return alive


def _bits(value: int, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(value.to_bytes(n // 8 + 1, "little"), dtype=np.uint8), count=n, bitorder="little")


def linked_rows(buckets: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all rows of a bucket within the radius of one another, as few as connect them."""
    n = len(prints)
    _, place, sizes = np.unique(buckets, return_inverse=True, return_counts=True)
    # Large buckets first: the rows that still have a partner at some distance are then a prefix.
    order = np.lexsort((place, -sizes[place]))
    size, bucket, prints = sizes[place][order], place[order], prints[order]
    root = np.arange(n)
    held, planes = n + 1, []
    for shift in range(1, int(size[0])):
        active = int(np.searchsorted(-size, -shift, side="left"))  # rows in buckets of more than shift rows
        if not planes or active < held // 2:
            held = active
            matrix = np.unpackbits(prints[:held].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            rows = np.packbits(matrix.T, axis=1, bitorder="little")
            planes = [int.from_bytes(row.tobytes(), "little") for row in rows]
        same = bucket[: active - shift] == bucket[shift:active]
        lanes = int.from_bytes(np.packbits(same, bitorder="little").tobytes(), "little")
        close = close_lanes(planes, shift, lanes, radius)
        if close:
            left = np.flatnonzero(_bits(close, active))
            left = left[root[left] != root[left + shift]]
            for a, b in zip(left.tolist(), (left + shift).tolist()):
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
            while len(left) and (root[root] != root).any():
                root = root[root]
    tied = np.flatnonzero(root != np.arange(n))
    return prints[tied], prints[root[tied]]


def _bucket_keys() -> list[Column]:
    """Keys of the bucket tables: the choice of blocks, then the bits in them."""
    starts = np.cumsum([0, *BLOCKS]).tolist()
    parts = [F.shiftrightunsigned("print", a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in zip(starts, BLOCKS)]
    keys = []
    for number, chosen in enumerate(combinations(range(len(BLOCKS)), AGREE)):
        key = F.lit(number).cast("long")
        for k in chosen:
            key = F.shiftleft(key, BLOCKS[k]).bitwiseOR(parts[k])
        keys.append(key)
    return keys


def near_links(prints: DataFrame, piece: int = PIECE) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints (column ``print``) that connect all within the radius.

    Every fingerprint goes to one bucket for each choice of blocks; within a bucket all are compared bit-sliced.
    A bucket of more than ``piece`` rows is cut by hash and its pieces meet in pairs, so that no task gets an
    unbounded bucket and no comparison is left out.
    """
    keyed = prints.select("print", F.explode(F.array(*_bucket_keys())).alias("key"))
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > piece)
    large = large.select("key", F.ceil(F.col("n") / piece).cast("int").alias("cuts"))
    cut = keyed.join(large, "key", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("print"), F.col("cuts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    pair = F.least("own", "other") * F.col("cuts") + F.greatest("own", "other")
    cut = cut.select("print", "key", pair.cast("long").alias("pair"))
    dealt = cut.repartition("key", "pair").sortWithinPartitions("key", "pair")
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        bucket = -1
        last = None
        ids: list[int] = []
        rows: list[int] = []

        def found() -> dict:
            u, v = linked_rows(np.array(ids), np.array(rows, dtype="<i8").view("<u8"))
            return {"u": u.view("<i8").tolist(), "v": v.view("<i8").tolist()}

        for batch in batches:
            for key, pair_, value in zip(batch["key"], batch["pair"], batch["print"]):
                if (key, pair_) != last:
                    if len(rows) >= PLANE_ROWS:
                        yield found()
                        ids, rows = [], []
                    last, bucket = (key, pair_), bucket + 1
                ids.append(bucket)
                rows.append(value)
        if rows:
            yield found()

    return map_columns(dealt, ["key", "pair", "print"], "u long, v long", work, out)


def _placed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``print``, ``lowest`` (smallest id of the component) and ``root`` (its print) of every row."""
    found = materialise(fingerprints(docs))
    distinct = found.where(F.col("doc_id").isNotNull()).groupBy("print").agg(F.min("doc_id").alias("first"))
    components = connected_components(near_links(distinct.select("print")))
    placed = distinct.join(components, distinct["print"] == components["node"], "left")
    # Fingerprints with links get the smallest document of their component.
    tied = placed.where(F.col("component").isNotNull())
    lowest = tied.groupBy("component").agg(F.min("first").alias("lowest"))
    reached = tied.select("print", "component").join(lowest, "component").select("print", "lowest", F.col("component").alias("root"))
    alone = placed.where(F.col("component").isNull()).select("print", F.col("first").alias("lowest"), F.col("print").alias("root"))
    return found.join(reached.union(alone), "print", "left").select("doc_id", "print", "lowest", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (the smallest ``doc_id`` reachable by links
    of at most three differing bits, itself included) for every row.

    Null text counts as empty, whose fingerprint zero links like any other. A row with a null ``doc_id`` keeps its
    fingerprint, takes no part in links and has a null component. Repeated ids are one node. Other columns are
    not read. Equal fingerprints are one row before any bucket is built, so copies cost nothing there.
    """
    return _placed(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("lowest")).alias("component_id"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The first document of each group of linked fingerprints, with all its columns.

    Rows without an id are kept. The smallest id of a group is its first; of the rows of a group that share this id,
    the smallest by all columns in their order, maps last and as JSON. Rows that share an id but are not linked are documents of their own.
    """
    placed = _placed(docs)
    groups = materialise(placed.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("lowest").alias("lowest"), F.count(F.lit(1)).alias("n")
    ))
    repeated = groups.where(F.col("n") > 1).select("doc_id")
    dropped = groups.where((F.col("n") > 1) | (F.col("lowest") != F.col("doc_id"))).select("doc_id")
    names = [quoted(name) for name in docs.columns]
    kept = docs.join(dropped, "doc_id", "left_anti").select(*names)
    if repeated.isEmpty():
        return kept
    twice = docs.join(repeated, "doc_id", "left_semi").select(F.struct(*names).alias("row"))
    rows = twice.select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    schema = StructType([*rows.schema.fields[:2], StructField("print", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([_signed(fingerprint(text)) for text in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), prints], ["row", "doc_id", "print"])

    firsts = placed.join(repeated, "doc_id", "left_semi").where(F.col("lowest") == F.col("doc_id")).distinct()
    first = rows.mapInArrow(work, schema).join(firsts, ["doc_id", "print"]).groupBy("doc_id", "root")
    ordered = [F.col(f"row.{quoted(f.name)}") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    lowest = F.min_by("row", F.struct(*ordered, F.to_json("row")))
    return kept.union(first.agg(lowest.alias("row")).select("row.*"))


def op7_simhash(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
