"""Hierarchical multi-length packing of token sequences."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.llm import tokens
from modelvigil.llm.common import crc, map_columns, table

#: Context sizes, long to short. Each has windows of its own; a sequence as long as one of them needs no padding.
TIERS = (2048, 1024, 512, 256)
#: Documents and tokens that are packed together; both bound a task's memory.
BATCH_DOCS, BATCH_TOKENS = 20_000, 4_000_000
#: Tokens of one training step, in longest windows: so many of them, twice as many of half their length, or a mix.
STEP = 16
#: Padding tokens that a window may keep before a shorter document is cut to fill it.
SLACK = 0

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long, ids binary"
)
_OUT = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
    ("step_group", pa.int64()), ("ids", pa.binary()),
])


class _Pool:
    """Document ends by length, with the longest one up to a bound found from a bit mask."""

    def __init__(self, longest: int):
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(longest + 1)]
        self.mask = 0

    def add(self, doc: int, start: int, length: int) -> None:
        self.by_length[length].append((doc, start))
        self.mask |= 1 << length

    def longest(self, bound: int) -> int:
        return (self.mask & ((2 << bound) - 1)).bit_length() - 1

    def shortest(self) -> int:
        return (self.mask & -self.mask).bit_length() - 1

    def take(self, length: int) -> tuple[int, int]:
        found = self.by_length[length].pop()
        if not self.by_length[length]:
            self.mask ^= 1 << length
        return found


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS, slack: int = SLACK) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of pieces (document, start, length), none longer than the first tier.

    Whole windows of the first tier are cut off long documents first. What is left of each is routed by its length to
    the smallest tier that holds it, and the tiers are packed from long to short, in windows of their own: the longest
    end of the tier starts one, the longest ends that fit, of this and then of the shorter tiers, fill it. Only if none
    fits and more than ``slack`` tokens are free is the shortest longer end cut; its rest is routed anew. So a long
    context holds long documents, short ones share short contexts, and windows are full. The tokens of the last,
    unfilled window are cut into exact smaller sizes, which need no padding either.
    """
    window = tiers[0]
    sequences: list[list[tuple[int, int, int]]] = []
    pool = _Pool(window)
    for doc, length in enumerate(lengths):
        full = length // window
        sequences += [[(doc, k * window, window)] for k in range(full)]
        if length > full * window:
            pool.add(doc, full * window, length - full * window)
    for size, below in zip(tiers, [*tiers[1:], 0]):
        while pool.mask and (length := pool.longest(size)) > below:
            doc, start = pool.take(length)
            pieces, free = [(doc, start, length)], size - length
            while free > 0 and pool.mask:
                if (length := pool.longest(free)) > 0:
                    doc, start = pool.take(length)
                elif free > slack:
                    longer = pool.shortest()
                    doc, start = pool.take(longer)
                    length = free
                    pool.add(doc, start + free, longer - free)
                else:
                    break
                pieces.append((doc, start, length))
                free -= length
            sequences += [pieces] if free <= slack else _exact(pieces, tiers)
    return sequences


def _exact(pieces: list[tuple[int, int, int]], tiers: tuple[int, ...]) -> list[list[tuple[int, int, int]]]:
    """The pieces of an unfilled window dealt to sequences of tier sizes and halves of the last one, long ones first."""
    total, sizes = sum(p[2] for p in pieces), []
    for size in (*tiers, *(tiers[-1] >> i for i in range(1, tiers[-1].bit_length()))):
        sizes += [size] * (total // size)
        total %= size
    out, queue = [], list(reversed(pieces))
    for size in sizes:
        own = []
        while size:
            doc, start, length = queue.pop()
            used = min(size, length)
            own.append((doc, start, used))
            if used < length:
                queue.append((doc, start + used, length - used))
            size -= used
        out.append(own)
    return out


def step_groups(
    sequences: list[list[tuple[int, int, int]]], tiers: tuple[int, ...] = TIERS, size: int = STEP
) -> list[int]:
    """A step for each sequence: steps of about ``size`` longest windows of tokens, with like numbers of tokens and like
    attention costs, whatever tiers their sequences are of.

    The cost of a sequence is the sum of the squares of its pieces. Long sequences come first, costly before cheap
    ones; each goes to the step with the fewest tokens so far, of these to the one with the least cost.
    """
    totals = [sum(p[2] for p in s) for s in sequences]
    steps = max(1, -(-sum(totals) // (size * tiers[0])))
    costs = [sum(p[2] ** 2 for p in s) for s in sequences]
    loads = [(0, 0, step) for step in range(steps)]
    out = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: (-totals[i], -costs[i], i)):
        tokens_, cost, step = loads[0]
        out[i] = step
        heapq.heapreplace(loads, (tokens_ + totals[i], cost + costs[i], step))
    return out


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, step: int = STEP,
    batch_docs: int = BATCH_DOCS, batch_tokens: int = BATCH_TOKENS, slack: int = SLACK, with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``tiers[0]`` tokens, with their ids unless ``with_ids`` is off.

    Each task packs the rows of its own partition, some ten thousand documents at a time, while they stream by:
    nothing is shuffled, and memory is bounded by ``batch_docs`` and ``batch_tokens`` (a longer single document
    is held as a whole). ``docs`` must give the same rows in the same order when a task is repeated, as a table
    scan does. Sequence and step numbers are unique over all partitions and rise within one.

    Null text counts as empty; every document ends with ``end_id``, so an empty one is a piece of one token.
    A null ``doc_id`` stays null. Repeated rows are packed as often as they come. No rows give no pieces. Columns
    other than ``doc_id`` and ``text`` are not read.
    """

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        end = np.array([end_id], dtype="<u4").tobytes()
        first = TaskContext.get().partitionId() << 33
        sequence, group = first, first
        ids: list[bytes] = []
        names: list[int] = []
        held = 0

        def closed() -> dict:
            nonlocal sequence, group
            found = pack([len(x) // 4 for x in ids], tiers, slack)
            steps = step_groups(found, tiers, step)
            rows: dict[str, list] = {name: [] for name in _OUT.names}
            for pieces, own in zip(found, steps):
                offset, total = 0, sum(p[2] for p in pieces)
                tier = min((t for t in tiers if t >= total), default=tiers[0])
                for doc, start, length in pieces:
                    code = ids[doc][4 * start : 4 * (start + length)]
                    for name, value in zip(_OUT.names, (
                        names[doc], start, length, crc(code), len(ids[doc]) // 4, sequence, offset, tier,
                        group + own, code if with_ids else None,
                    )):
                        rows[name].append(value)
                    offset += length
                sequence += 1
            group += max(steps, default=-1) + 1
            return rows

        encode = tokens.encoder(tokenizer)
        for batch in batches:
            for doc_id, code in zip(batch["doc_id"], encode.stream(t or "" for t in batch["text"])):
                ids.append(code + end)
                names.append(doc_id)
                held += len(code) // 4 + 1
                if len(ids) >= batch_docs or held >= batch_tokens:
                    yield closed()
                    ids, names, held = [], [], 0
        if ids:
            yield closed()

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    return map_columns(docs, columns, SCHEMA, work, _OUT, stateful=True)


def op4_packing(spark, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Digest of the packed pieces: all columns but the ids themselves."""
    return pack_documents(docs, tokens.default_path("byte_bpe_50k.json"), with_ids=False).drop("ids")
