"""Spelling variants: words one edit apart, found through one-edit neighbourhoods over a reduced alphabet."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelvigil.llm.common import map_columns, table
from modelvigil.session import materialise

LEAST_LENGTH, LEAST_COUNT, FACTOR, EVERY = 5, 3, 2, 97
#: Symbols that letters are hashed to. More of them leave fewer pairs to verify, but make larger neighbourhoods.
SYMBOLS = 12
#: Distinct words that a task counts before it passes them on, and words whose neighbourhoods are made at a time.
COUNTED, WORDS = 200_000, 2_000
#: Bits of the filter of reduced words: about so many a word, between these powers of two (128 kB to 16 MB).
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 16, 20, 27
#: Rounds of pointer doubling; each form at least doubles the count, so no chain has over 63 words.
DOUBLINGS = 7

_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def runs(doc_id: int | None, text: str, every: int = EVERY) -> Iterator[tuple[str, int]]:
    """Words of a text with their counts: maximal runs of letters, small ASCII letters, one code point deleted where
    ``every`` divides the crc32 of ``doc_id:run``. Runs that can only give shorter words are left out."""
    lower = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(lower)).items():
        h = zlib.crc32(run.encode(), before)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        yield run, n


def word_counts(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, of every word of ``LEAST_LENGTH`` code points or more.

    Each task counts its own words, so a frequent word is a row for some hundred thousand distinct ones.
    """
    out = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        counts: dict[str, int] = defaultdict(int)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for word, n in runs(doc_id, text or "", every):
                    counts[word] += n
                if len(counts) >= COUNTED:
                    yield {"word": list(counts), "n": list(counts.values())}
                    counts.clear()
        yield {"word": list(counts), "n": list(counts.values())}

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    return map_columns(docs, columns, "word string, n long", work, out).groupBy("word").agg(F.sum("n").alias("n"))


def reduced(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """Words of one length as rows of symbols from 1 to ``symbols``."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64).reshape(len(words), -1)
    return ((points * _MIX) >> np.uint64(33)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def keys(rows: np.ndarray) -> np.ndarray:
    """64-bit keys of reduced words; equal words have equal keys."""
    return (rows * _powers(rows.shape[1])).sum(axis=1, dtype=np.uint64)


def neighbourhood(rows: np.ndarray, symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the whole one-edit neighbourhoods of reduced words, themselves included, and the row of each key.

    A key is the word as a polynomial, so an edit moves what lies behind it by one power. Edits that give the same
    word (deleting or repeating a symbol of a run) are made once.
    """
    n, length = rows.shape
    powers = _powers(length + 1)
    before = np.zeros((n, length + 1), dtype=np.uint64)
    np.cumsum(rows * powers[:length], axis=1, out=before[:, 1:])
    whole, every = before[:, -1], np.arange(n)
    found, owners = [whole], [every]
    for i in range(length + 1):
        if i < length:
            fresh = np.flatnonzero(rows[:, i] != rows[:, i - 1]) if i else every
            found.append(before[fresh, i] + (whole[fresh] - before[fresh, i + 1]) * _INVERSE)
            owners.append(fresh)
        for symbol in map(np.uint64, range(1, symbols + 1)):
            if i < length:
                fresh = np.flatnonzero(rows[:, i] != symbol)
                found.append(whole[fresh] + (symbol - rows[fresh, i]) * powers[i])
                owners.append(fresh)
            fresh = np.flatnonzero(rows[:, i - 1] != symbol) if i else every
            found.append(before[fresh, i] + symbol * powers[i : i + 1] + (whole[fresh] - before[fresh, i]) * np.uint64(_BASE))
            owners.append(fresh)
    return np.concatenate(found), np.concatenate(owners)


def _slots(found: np.ndarray, bits: int) -> np.ndarray:
    return ((found * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _by_length(words: list[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = defaultdict(list)
    for word in words:
        groups[len(word)].append(word)
    for group in groups.values():
        # A neighbourhood grows with the length, so longer words come in smaller lots.
        step = max(1, min(WORDS, 40_000 // len(group[0])))
        for a in range(0, len(group), step):
            yield group[a : a + step]


def with_keys(words: DataFrame, bits: int, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``n``, ``key`` of its reduced form and its ``slot`` in a filter of ``2**bits``."""
    out = pa.schema([("word", pa.string()), ("n", pa.int64()), ("key", pa.int64()), ("slot", pa.int64())])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            count = dict(zip(batch["word"], batch["n"]))
            for group in _by_length(batch["word"]):
                key = keys(reduced(group, symbols))
                yield {"word": group, "n": [count[w] for w in group], "key": key.view(np.int64), "slot": _slots(key, bits)}

    return map_columns(words, ["word", "n"], "word string, n long, key long, slot long", work, out)


def filter_of(slots: DataFrame, bits: int) -> np.ndarray:
    """A bit for each slot in use. It has ``2**bits`` bits, whatever the number of words; Spark merges its parts."""
    slot = F.col("slot") + 1  # buckets and bits are counted from one
    parts = slots.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    out = np.zeros(max(1 << bits, 32_768), dtype=np.bool_)
    for r in parts.collect():
        out[(r.bucket - 1) * 32_768 : r.bucket * 32_768] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")
    return np.packbits(out, bitorder="little")


def neighbour_keys(words: DataFrame, known: np.ndarray, bits: int, symbols: int = SYMBOLS) -> DataFrame:
    """``word`` and each ``key`` of its reduced neighbourhood that the filter does not rule out, once."""
    out = pa.schema([("word", pa.string()), ("key", pa.int64())])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for group in _by_length(batch["word"]):
                found, owners = neighbourhood(reduced(group, symbols), symbols)
                slots = _slots(found, bits)
                likely = known[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 > 0
                found, owners = found[likely], owners[likely]
                order = np.lexsort((found, owners))
                found, owners = found[order], owners[order]
                fresh = np.ones(len(found), dtype=bool)
                fresh[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
                yield {"word": pa.array(group).take(pa.array(owners[fresh])), "key": found[fresh].view(np.int64)}

    return map_columns(words, ["word"], "word string, key long", work, out)


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``near``, ``near_n``: every ordered pair of different ``words`` (``word``, ``n``; distinct) that are
    exactly one inserted, deleted or replaced code point apart.

    Two such words have reduced forms that are equal or one edit apart, so the reduced form of one is in the reduced
    neighbourhood of the other. Neighbourhoods are joined with the reduced vocabulary on 64-bit keys, and what meets
    is verified on the words themselves.
    """
    n = max(words.count(), 1)
    bits = min(max((FILTER_BITS * n - 1).bit_length(), FILTER_LEAST), FILTER_MOST)
    keyed = materialise(with_keys(words, bits, symbols))
    wanted = neighbour_keys(words, filter_of(keyed.select("slot"), bits), bits, symbols)
    other = keyed.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "key")
    met = wanted.join(other, "key").where(F.col("word") != F.col("near"))
    return met.where(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word reached by following ``form``, of rows (``word``, ``form``) without cycles.

    The distance followed doubles with each round.
    """
    links = materialise(forms.select("word", F.col("form").alias("root")))
    for _ in range(DOUBLINGS):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(links.join(further, "root", "left"))
        links = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where(F.col("next").isNotNull()).isEmpty():
            return links
    raise RuntimeError("a chain of forms does not end")


def best_form(near_n: Column, near: Column) -> Column:
    """Of the near words that with the largest count; ties: the smallest in code-point order."""
    return F.min(F.struct((-near_n).alias("minus_n"), near.alias("near")))


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, factor: int = FACTOR, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word with ``least_count`` occurrences.

    Null and empty texts have no words; a null ``doc_id`` is empty in the hash that deletes letters. Repeated rows
    count as often as they come; no rows give no words. Other columns are not read. Texts may be of any length.
    """
    words = materialise(word_counts(docs).where(F.col("n") >= least_count))
    near = near_pairs(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best_form(F.col("near_n"), F.col("near")).alias("best")
    )
    holds = -F.col("best.minus_n") >= F.lit(factor) * F.col("n")
    judged = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(holds, F.col("best.near")).alias("form"), F.when(holds, -F.col("best.minus_n")).alias("form_n"),
    ))
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n",
    )


def op13_spelling(spark, folder: str) -> DataFrame:
    return variants(table(spark, folder, "documents"))
