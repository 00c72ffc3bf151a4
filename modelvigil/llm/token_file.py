"""Token ids in directly addressable codes: files that give any token without decoding a block."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.llm import tokens
from modelvigil.llm.common import crc, map_columns, table
from modelvigil.session import scratch_path

MAGIC = b"DACTOKEN"
#: Bits of one chunk; each level of the code holds one chunk of every id that reaches it.
CHUNK = 8
#: Bits of a continuation bitmap between two entries of its rank directory.
RANK_BITS = 512
#: Tokens after which a task starts another file; a longer single document is one file.
FILE_TOKENS = 4_000_000
#: Tasks that read files back, at most.
READ_TASKS = 4_096
_HEAD = struct.Struct("<8sIIQQ")
_LEVEL = struct.Struct("<QQQQ")


def encode_file(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """One file: header, level table, document directory, then chunks, continuation bitmap and ranks of each level.

    Level ``k`` holds bits ``8k`` to ``8k + 7`` of the ids that have any bit from ``8k`` on (level 0: of all ids).
    A set bit in the bitmap says that the id goes on in the next level, at the place that is the number of set
    bits before it. A null ``doc_id`` is flagged.
    """
    levels, rest = [], ids.astype(np.uint64)
    while True:
        more = (rest >> np.uint64(CHUNK)) > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), dtype=np.uint8)])
        ones = np.bitwise_count(bits.view("<u8")).reshape(-1, RANK_BITS // 64).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        levels.append(((rest & np.uint64(255)).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes(), len(rest)))
        rest = rest[more] >> np.uint64(CHUNK)
        if not len(rest):
            break
    directory = (
        np.array([d if d is not None else 0 for d in doc_ids], dtype="<i8").tobytes()
        + np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes()
        + np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes()
    )
    at = _HEAD.size + len(levels) * _LEVEL.size + len(directory)
    out, places = [], []
    for chunks, bits, ranks, n in levels:
        places.append(_LEVEL.pack(n, at, at + len(chunks), at + len(chunks) + len(bits)))
        out += [chunks, bits, ranks]
        at += len(chunks) + len(bits) + len(ranks)
    head = _HEAD.pack(MAGIC, CHUNK, len(levels), len(ids), len(doc_ids))
    return b"".join([head, *places, directory, *out])


class TokenFile:
    """Reader of one file. ``token`` reads a few bytes of each level through ``read_at(offset, size)``."""

    def __init__(self, read_at):
        self.read_at = read_at
        magic, chunk, levels, self.n_tokens, self.n_docs = _HEAD.unpack(read_at(0, _HEAD.size))
        if magic != MAGIC or chunk != CHUNK:
            raise ValueError("not a token file")
        table_ = read_at(_HEAD.size, levels * _LEVEL.size)
        self.levels = list(_LEVEL.iter_unpack(table_))
        self.directory = _HEAD.size + levels * _LEVEL.size

    def token(self, place: int) -> int:
        """The id at ``place``: per level one chunk, and one rank entry with its block of the bitmap."""
        if not 0 <= place < self.n_tokens:
            raise IndexError(place)
        value = 0
        for k, (_, chunks, bits, ranks) in enumerate(self.levels):
            value |= self.read_at(chunks + place, 1)[0] << (CHUNK * k)
            block, inside = divmod(place, RANK_BITS)
            words = int.from_bytes(self.read_at(bits + block * RANK_BITS // 8, RANK_BITS // 8), "little")
            if not words >> inside & 1:
                return value
            (before,) = struct.unpack("<Q", self.read_at(ranks + 8 * block, 8))
            place = before + (words & ((1 << inside) - 1)).bit_count()
        raise ValueError("an id goes on behind the last level")

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and their starts; the last start is the number of tokens."""
        at, n = self.directory, self.n_docs
        names = np.frombuffer(self.read_at(at, 8 * n), dtype="<i8").tolist()
        missing = np.frombuffer(self.read_at(at + 8 * n, n), dtype=np.uint8)
        starts = np.frombuffer(self.read_at(at + 9 * n, 8 * (n + 1)), dtype="<u8").astype(np.int64)
        return [None if gone else name for name, gone in zip(names, missing)], starts

    def all_tokens(self) -> np.ndarray:
        """Every id, level by level from the last."""
        upper = np.zeros(0, dtype=np.uint32)
        for n, chunks, bits, _ in reversed(self.levels):
            value = np.frombuffer(self.read_at(chunks, n), dtype=np.uint8).astype("<u4")
            packed = np.frombuffer(self.read_at(bits, -(-n // RANK_BITS) * RANK_BITS // 8), dtype=np.uint8)
            more = np.unpackbits(packed, count=n, bitorder="little").view(bool)
            if len(upper):
                value[more] |= upper << np.uint32(CHUNK)
            upper = value
        return upper


def open_file(path: str) -> tuple[TokenFile, pa.NativeFile]:
    store, inner = fs.FileSystem.from_uri(path)
    handle = store.open_input_file(inner)

    def read_at(offset: int, size: int) -> bytes:
        handle.seek(offset)
        return handle.read(size)

    return TokenFile(read_at), handle


_MANIFEST = "part long, place long, path string, first_doc long, n_docs long, n_tokens long"
_MANIFEST_OUT = pa.schema([
    ("part", pa.int64()), ("place", pa.int64()), ("path", pa.string()), ("first_doc", pa.int64()),
    ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
])


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, file_tokens: int = FILE_TOKENS,
    partitions: int | None = None,
) -> None:
    """Write the ids of all documents in ascending ``doc_id`` order below ``folder``.

    Rows are dealt by ranges of ``doc_id`` and sorted inside them (nulls first, then by text), encoded, and
    written in files of about ``file_tokens`` tokens. ``folder/manifest`` lists the files in order; it is written
    by Spark's commit protocol, and file names are unique for each attempt of a task, so a lost or repeated task
    leaves at most files that no manifest names. ``folder`` may be any place that executors share and pyarrow opens.

    Null text counts as empty. Repeated rows are written as often as they come. No rows give an empty manifest.
    """
    store, inner = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{inner}/ids", recursive=True)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        end = np.array([end_id], dtype="<u4").tobytes()
        context = TaskContext.get()
        target, base = fs.FileSystem.from_uri(folder)
        place = 0
        names: list[int] = []
        parts: list[bytes] = []
        held = 0

        def written() -> dict:
            nonlocal place
            name = f"ids/{context.partitionId():06d}-{place:04d}-{uuid.uuid4().hex}.dac"
            data = encode_file(np.frombuffer(b"".join(parts), dtype="<u4"), names, [len(x) // 4 for x in parts])
            with target.open_output_stream(f"{base}/{name}") as sink:
                sink.write(data)
            place += 1
            return {
                "part": [context.partitionId()], "place": [place - 1], "path": [f"{folder}/{name}"],
                "first_doc": [names[0]], "n_docs": [len(names)], "n_tokens": [held],
            }

        encode = tokens.encoder(tokenizer)
        for batch in batches:
            for doc_id, code in zip(batch["doc_id"], encode.stream(t or "" for t in batch["text"])):
                parts.append(code + end)
                names.append(doc_id)
                held += len(code) // 4 + 1
                if held >= file_tokens:
                    yield written()
                    names, parts, held = [], [], 0
        if names:
            yield written()

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    dealt = wanted.repartitionByRange(partitions, "doc_id") if partitions else wanted.repartitionByRange("doc_id")
    ordered = dealt.sortWithinPartitions("doc_id", "text")
    map_columns(ordered, ["doc_id", "text"], _MANIFEST, work, _MANIFEST_OUT, stateful=True).write.parquet(f"{folder}/manifest")


_DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"
_DIGEST_OUT = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
])


def read_token_files(spark, folder: str) -> DataFrame:
    """A row for each document, from the files: its place in the whole, its number of tokens, the crc32 of its ids.

    The manifest has one row for some millions of tokens, so one task may sum what lies before each file. The files
    themselves are dealt to as many tasks as there are files, at most ``READ_TASKS``; as the number is given,
    adaptive execution does not join these tiny partitions into one.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    tasks = max(1, min(manifest.count(), READ_TASKS))
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"]):
                file, handle = open_file(path)
                with handle:
                    names, starts = file.documents()
                    code = memoryview(file.all_tokens().tobytes())
                lengths = np.diff(starts)
                yield {
                    "doc_id": names, "start": (starts[:-1] + base).tolist(), "n_tokens": lengths.tolist(),
                    "ids_crc32": [crc(code[4 * a : 4 * (a + n)]) for a, n in zip(starts[:-1].tolist(), lengths.tolist())],
                }

    return map_columns(placed.repartition(tasks, "part", "place"), ["path", "base"], _DIGEST, work, _DIGEST_OUT)


def op9_token_file(spark, folder: str) -> DataFrame:
    target = scratch_path(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), target, tokens.default_path("word_bpe_49k.json"))
    return read_token_files(spark, target)
