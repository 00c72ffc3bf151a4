"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.llm.common import quoted, table
from modelvigil.operators.joins import join_group_rows
from modelvigil.session import materialise

#: No source is repeated more often than this, relative to the least repeated one.
REPEAT = 2.0
#: Halvings of the exponent's interval, and how many of them one pass over the source table decides.
HALVINGS, AT_ONCE = 40, 5
#: Documents of one block of a source, about; and words of one block of the mixed order.
BLOCK_DOCS, BLOCK_WORDS = 4_096, 1_000_000
SEED = 17

# What separates words in the size of a text.
WORD = r"[^ \t\n\r]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, label: str, *parts: Column | str) -> Column:
    """A repeatable number below 2**32 from the md5 of the seed, a label and the parts, none of them null."""
    values = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(label), *values)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _measure(totals: DataFrame, exponents: list[float], repeat: bool) -> list[float]:
    """For each exponent the largest repetition against the least, or the entropy of the weights, in one pass."""
    share = F.log(F.col("total"))
    columns = []
    for number, a in enumerate(exponents):
        if repeat:  # a source's repetitions are share**(a - 1), up to a common factor
            columns.append(F.exp(F.lit(1 - a) * (F.max(share) - F.min(share))).alias(f"m{number}"))
        else:
            power = F.exp(F.lit(a) * (share - F.lit(math.log(2**40))))
            z = F.sum(power)
            columns.append((F.log(z) - F.sum(power * F.log(power)) / z).alias(f"m{number}"))
    return [float(x) for x in totals.agg(*columns).first()]


def exponent(totals: DataFrame, repeat: float | None = REPEAT, entropy: float | None = None) -> float:
    """The exponent in [0, 1] that source shares are raised to; 1 leaves them as they are, 0 makes them equal.

    With ``entropy`` (in nats) the largest one whose weights still reach it; otherwise the smallest one that repeats
    no source over ``repeat`` (at least 1) times as often as the least repeated. Entropy and repetition both fall
    as the exponent rises, so its interval is halved ``HALVINGS`` times. One pass over ``totals`` (a row a source,
    column ``total``) measures every midpoint that the next ``AT_ONCE`` halvings may ask for. An entropy out of
    reach gives 0 or 1.
    """
    by_repeat = entropy is None
    if by_repeat and not (repeat or 0) >= 1:
        raise ValueError("repeat must be at least 1")
    fits = (lambda m: m <= repeat) if by_repeat else (lambda m: m < entropy)  # the exponent wanted is not above
    ends = _measure(totals, [0.0, 1.0], by_repeat)
    if fits(ends[0]):
        return 0.0
    if not fits(ends[1]):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(0, HALVINGS, AT_ONCE):
        start, step = low, (high - low) / 2**AT_ONCE
        measured = _measure(totals, [start + step * i for i in range(1, 2**AT_ONCE)], by_repeat)
        at = width = 2 ** (AT_ONCE - 1)
        for _ in range(AT_ONCE):
            width //= 2
            if fits(measured[at - 1]):
                high, at = start + step * at, at - width
            else:
                low, at = start + step * at, at + width
    return high if by_repeat else low


def mix(
    docs: DataFrame, repeat: float | None = REPEAT, entropy: float | None = None, budget: int | None = None,
    seed: int = SEED, block_docs: int = BLOCK_DOCS, block_words: int = BLOCK_WORDS, size: Column | None = None,
) -> DataFrame:
    """Documents in a mixed order that follows temperature weights of their sources.

    Returns ``row`` (all columns of ``docs``, whatever their names), ``copy`` (from 0), ``block`` and ``place`` (the
    order inside a block; ties by id). A document counts ``size`` (its words, and one for its end), so no size is
    zero. Shares of sources are raised to the exponent that :func:`exponent` finds. Without ``budget`` each source
    gets the least quota at which every document appears at least once; with a budget in words it gets its weight of
    it, and a source may then be cut short. A null source is a source of its own, a null text is empty, a null
    ``doc_id`` is replaced by the text in draws. Repeated rows are rows of their own. No rows give none.

    A source is cut by hash into blocks of about ``block_docs``. Each pass over a source visits its blocks, and the
    documents inside a block, in another repeatable permutation, until the next document would exceed the quota.
    Only block totals are summed over a whole source. A document at a share of its source's quota goes to the mixed
    block at that share of all blocks, so each block of about ``block_words`` holds the target mix.
    """
    size = words("text") + 1 if size is None else size
    sized = docs.select(
        F.struct(*map(quoted, docs.columns)).alias("row"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("source_key"),
        F.coalesce(F.col("doc_id").cast("string"), F.col("text") if "text" in docs.columns else F.lit(""), F.lit("")).alias("id"),
        size.cast("long").alias("size"),
    )
    narrow = materialise(sized.select("source_key", F.md5("id").alias("id_hash"), "size"))
    totals = narrow.groupBy("source_key").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("total"))
    totals = materialise(totals)
    largest, all_words, sources = totals.agg(F.max("total"), F.sum("total"), F.count(F.lit(1))).first()
    if not sources:
        none = "copy int, block long, place long"
        return sized.select("row").withColumns({
            name: F.lit(None).cast(kind) for name, kind in (part.split() for part in none.split(", "))
        })
    a = exponent(totals, repeat, entropy)
    if budget is None:
        quota = F.col("total") * F.exp(F.lit(a - 1) * (F.log("total") - F.lit(math.log(largest))))
    else:
        z = totals.agg(F.sum(F.exp(F.lit(a) * F.log(F.col("total") / F.lit(float(all_words)))))).first()[0]
        quota = F.lit(budget / z) * F.exp(F.lit(a) * F.log(F.col("total") / F.lit(float(all_words))))
    plan = totals.select(
        "source_key", "total", F.floor(quota + 0.5).cast("long").alias("quota"),
        F.ceil(F.col("docs") / block_docs).cast("long").alias("parts"),
    )
    mixed_blocks = F.greatest(F.ceil(F.lit(plan.agg(F.sum("quota")).first()[0] / block_words)), F.lit(1)).cast("long")

    def parted(rows: DataFrame, id_hash: Column) -> DataFrame:
        placed = join_group_rows(rows, plan, ["source_key"], "id_key")
        return placed.withColumn("part", draw(seed, "block", id_hash) % F.col("parts"))

    sums = parted(narrow.withColumn("id_key", F.col("id_hash")), F.col("id_hash")).groupBy("source_key", "part").agg(
        F.sum("size").alias("part_total"), F.first("total").alias("total"), F.first("quota").alias("quota"),
        F.first("parts").alias("parts"),
    )
    passes = F.greatest(F.ceil(F.col("quota") / F.col("total")), F.lit(1)).cast("int")
    visits = sums.withColumn("copy", F.explode(F.sequence(F.lit(0), passes - 1)))
    order = Window.partitionBy("source_key", "copy").orderBy(draw(seed, "visit", "copy", "part"), "part")
    before = F.coalesce(F.sum("part_total").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    visits = visits.withColumn("before", F.col("copy") * F.col("total") + before)
    visits = visits.groupBy("source_key", "part").agg(
        F.collect_list(F.struct("copy", "before")).alias("visits"), F.first("quota").alias("quota_")
    )
    whole = sized.withColumn("id_hash", F.md5("id")).drop("id").withColumn("id_key", F.col("id_hash"))
    whole = parted(whole, F.col("id_hash")).select("row", "source_key", "part", "id_hash", "size")
    met = whole.join(visits, ["source_key", "part"]).withColumn("visit", F.explode("visits")).select(
        "row", "source_key", "part", "id_hash", "size", "visit.copy", "visit.before", "quota_",
    )
    inside = Window.partitionBy("source_key", "part", "copy").orderBy(draw(seed, "copy", "copy", "id_hash"), "id_hash", "size")
    sofar = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = met.withColumn("end", F.col("before") + sofar).where(F.col("end") <= F.col("quota_"))
    share = (F.col("end") - F.col("size")) / F.col("quota_")
    return taken.select(
        "row", F.col("copy").cast("int").alias("copy"),
        F.floor(share * mixed_blocks).cast("long").alias("block"),
        draw(seed, "place", "copy", "id_hash").alias("place"),
    )


def op10_mixing(spark, folder: str) -> DataFrame:
    # The text itself goes only so far as a row without an id needs it to be told from others.
    unnamed = F.when(F.col("doc_id").isNull(), F.md5("text"))
    docs = table(spark, folder, "documents").select("doc_id", "source", (words("text") + 1).alias("size"), unnamed.alias("text"))
    mixed = mix(docs, size=F.col("size"))
    return mixed.select("row.doc_id", "row.source", "row.size", "copy", "block", "place")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with rows repeated as the mix asks, in its order, and no other columns.

    Null sources, ids and texts, repeated rows and empty tables are handled as :func:`mix` says.
    """
    mixed = mix(docs)
    return mixed.repartitionByRange("block", "place").sortWithinPartitions("block", "place").select("row.*")


def _draw_sql(label: str, *parts: str) -> str:
    text = ", ':', ".join([f"'{SEED}'", f"'{label}'", *parts])
    return f"CAST(concat('0x', substr(md5(concat({text})), 1, 8)) AS BIGINT)"


ORACLE = f"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) + 1 AS BIGINT) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), md5(text), '')) AS id_hash
    FROM documents),
totals AS (
    SELECT source, count(*) AS docs, CAST(sum(size) AS BIGINT) AS total FROM sized GROUP BY source),
halvings AS (
    SELECT 0 AS i, CAST(0 AS DOUBLE) AS low,
           CASE WHEN (SELECT exp(max(ln(total)) - min(ln(total))) FROM totals) <= {REPEAT} THEN 0e0 ELSE 1e0 END AS high
    UNION ALL
    SELECT i + 1, CASE WHEN fits THEN low ELSE mid END, CASE WHEN fits THEN mid ELSE high END
    FROM (SELECT i, low, high, (low + high) / 2 AS mid,
                 exp((1 - (low + high) / 2) * (SELECT max(ln(total)) - min(ln(total)) FROM totals)) <= {REPEAT} AS fits
          FROM halvings WHERE i < {HALVINGS})),
solved AS (SELECT high AS a FROM halvings WHERE i = {HALVINGS}),
plan AS (
    SELECT source, total,
           CAST(floor(total * exp((a - 1) * (ln(total) - (SELECT ln(max(total)) FROM totals))) + 0.5) AS BIGINT) AS quota,
           CAST(ceil(docs / CAST({BLOCK_DOCS} AS DOUBLE)) AS BIGINT) AS parts
    FROM totals, solved),
mixed AS (SELECT greatest(CAST(ceil(sum(quota) / CAST({BLOCK_WORDS} AS DOUBLE)) AS BIGINT), 1) AS blocks FROM plan),
parted AS (
    SELECT s.*, p.total, p.quota, {_draw_sql("block", "id_hash")} % p.parts AS part
    FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
copies AS (
    SELECT *, unnest(range(greatest(CAST(ceil(quota / CAST(total AS DOUBLE)) AS BIGINT), 1))) AS copy FROM parted),
visits AS (
    SELECT source, part, copy, any_value(total) * copy + coalesce(sum(sum(size)) OVER (
               PARTITION BY source, copy ORDER BY {_draw_sql("visit", "copy", "part")}, part
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM copies GROUP BY source, part, copy),
ends AS (
    SELECT c.*, v.before + sum(size) OVER (
               PARTITION BY c.source, c.part, c.copy ORDER BY {_draw_sql("copy", "c.copy", "id_hash")}, id_hash, size
               ROWS UNBOUNDED PRECEDING) AS last
    FROM copies c
    JOIN visits v ON v.source IS NOT DISTINCT FROM c.source AND v.part = c.part AND v.copy = c.copy)
SELECT doc_id, source, size, CAST(copy AS INT) AS copy,
       CAST(floor((last - size) / CAST(quota AS DOUBLE) * blocks) AS BIGINT) AS block,
       {_draw_sql("place", "copy", "id_hash")} AS place
FROM ends, mixed WHERE last <= quota
"""
