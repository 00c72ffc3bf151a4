"""A learnt vocabulary of words, and word arrays turned into its ids by a distributed dictionary join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelvigil.operators.ranking import with_order_position
from modelvigil.session import materialise

PAD_ID, EOS_ID, UNKNOWN_ID, FIRST_ID = 0, 1, 2, 3
#: The most frequent words, which are broadcast (some 8 MB), and the longest word among them.
HEAD, HEAD_CHARS = 1 << 19, 64


def learn_vocabulary(df: DataFrame, *columns: str, first_id: int = FIRST_ID) -> DataFrame:
    """``word``, ``n`` and ``id`` of every word in the array columns: frequent words first, ties by code points.

    Ids are dense from ``first_id`` and no two words share one. Null arrays and null words count for nothing. Words are
    counted before they are shuffled, and ranked range by range, so neither a frequent word nor their number meets in
    one task. The table is computed once.
    """
    words = F.concat(*[F.coalesce(column, F.array().cast("array<string>")) for column in columns])
    said = df.select(F.explode(words).alias("word")).where(F.col("word").isNotNull())
    counts = said.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_order_position(counts, [F.desc("n"), F.asc("word")])
    return materialise(ranked.select("word", "n", (F.col("position") + first_id).alias("id")))


def _known(vocabulary: DataFrame, frequent: Column) -> Broadcast:
    """The frequent words and their ids, bounded in number and length, for the tasks to look words up in."""
    rows = vocabulary.where(frequent & F.col("word").isNotNull()).select("word", "id").toArrow()
    known = pa.RecordBatch.from_arrays([rows.column(0).combine_chunks(), rows.column(1).cast(pa.int64()).combine_chunks()], ["word", "id"])
    return vocabulary.sparkSession.sparkContext.broadcast(known)


def _ids_of(words: pa.Array, known: pa.RecordBatch) -> pa.Array:
    """Ids of all words of a list array, null for a word that is not known."""
    return known.column("id").take(pc.index_in(words.flatten(), value_set=known.column("word").cast(words.type.value_type)))


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def encode_words(df: DataFrame, column: str, vocabulary: DataFrame, into: str, head: int = HEAD) -> DataFrame:
    """``df`` with the ids of the word array ``column``, in its order, as ``into``.

    A word the vocabulary lacks has ``UNKNOWN_ID``, a null word too; a null array gives no ids. At most ``head``
    frequent, short words are broadcast, and every array looks its words up where it is, a batch of rows in one call.
    If that is the whole vocabulary, nothing is shuffled. Otherwise the words not found there, each rare, meet the rest
    of the vocabulary by shuffle and are gathered by a digest of their row's words; rows with equal words share them.
    """
    first = vocabulary.agg(F.min("id")).first()[0] or 0
    frequent = (F.col("id") < first + head) & (F.length("word") <= HEAD_CHARS)
    known = _known(vocabulary, frequent)
    rare = vocabulary.where(F.col("word").isNotNull() & ~frequent).select(F.col("word").alias("_word"), F.col("id").alias("_id"))
    words = F.coalesce(column, F.array().cast("array<string>"))

    @F.arrow_udf("array<bigint>")
    def found(lists: pa.Array) -> pa.Array:
        return _lists(_lengths(lists), _ids_of(lists, known.value))

    @F.arrow_udf("array<bigint>")
    def whole(lists: pa.Array) -> pa.Array:
        return _lists(_lengths(lists), _ids_of(lists, known.value).fill_null(UNKNOWN_ID))

    @F.arrow_udf("array<string>")
    def missing(lists: pa.Array) -> pa.Array:
        absent = _ids_of(lists, known.value).is_null()
        row = np.repeat(np.arange(len(lists)), _lengths(lists))[absent.to_numpy(zero_copy_only=False)]
        return _lists(np.bincount(row, minlength=len(lists)), lists.flatten().filter(absent))

    @F.arrow_udf("array<bigint>")
    def filled(ids: pa.Array, others: pa.Array) -> pa.Array:
        values = ids.flatten()
        return _lists(_lengths(ids), pc.replace_with_mask(values, values.is_null(), others.flatten()))

    if rare.isEmpty():
        return df.withColumn(into, whole(words))
    name = F.unhex(F.sha2(F.concat(F.size(words).cast("string"), F.lit(":"), F.array_join(words, "\x00", "\x01")), 256))
    named = df.withColumn("_name", name)
    absent = named.select("_name", F.posexplode(missing(words)).alias("_at", "_word")).join(rare, "_word", "left")
    entry = F.struct("_at", F.coalesce("_id", F.lit(UNKNOWN_ID).cast("bigint")).alias("_id"))
    gathered = absent.groupBy("_name").agg(F.array_sort(F.collect_set(entry)).alias("_others"))
    gathered = gathered.select("_name", F.transform("_others", lambda p: p["_id"]).alias("_others"))
    met = named.withColumn("_known", found(words)).join(gathered.hint("shuffle_hash"), "_name", "left")
    return met.withColumn(into, filled("_known", "_others")).drop("_name", "_known", "_others")
