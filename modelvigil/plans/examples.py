"""Registered queries of dataset preparation and training arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelvigil.functions.text import format_chat
from modelvigil.operators import conversations, dataset, ranking, vocabulary
from modelvigil.presets import NOISE_PREFIXES, NOISE_SUFFIXES, ROWS_PER_LABEL, TYPO_SWAPS
from modelvigil.session import scratch_path
from modelvigil.sources import files, views

SEED = 42
MIX = {"click": 4.0, "signup": 4.0}


def dedup_ci(spark, folder):
    return dataset.dedup_ci(views.labelled_docs(spark, folder)).select("ex_id", "label")


def cap_per_label(spark, folder):
    return dataset.cap_per_label(views.labelled_docs(spark, folder), ROWS_PER_LABEL).select("ex_id", "label")


def group_split(spark, folder):
    return dataset.group_split(views.labelled_docs(spark, folder), seed=SEED).select("ex_id", "group_id", "split")


def group_split_hashed(spark, folder):
    split = dataset.group_split(views.labelled_docs(spark, folder), seed=SEED, exact=False)
    return split.select("ex_id", "group_id", "split")


def leakage_audit(spark, folder):
    """Empty: a group split leaks nothing."""
    return dataset.leakage_audit(dataset.group_split(views.labelled_docs(spark, folder), seed=SEED))


def leakage_row_split(spark, folder):
    return dataset.leakage_audit(dataset.row_split(views.labelled_docs(spark, folder), seed=SEED))


def augment_noise(spark, folder):
    noisy = dataset.augment_noise(views.labelled_docs(spark, folder), seed=SEED)
    return noisy.select("ex_id", F.md5("noisy_text").alias("noisy_md5"), F.length("noisy_text").alias("n_chars"))


def resample_mix(spark, folder):
    events = views.pred_log(spark, folder)
    kept = dataset.resample_mix(events, MIX, key="event_id", seed=SEED, day="day", start_day=15)
    return kept.select("event_id", "day", "label")


def hash_shuffle(spark, folder):
    docs = views.labelled_docs(spark, folder).select("ex_id", "label")
    return ranking.with_shuffle_position(docs, "ex_id", SEED)


def prompts(spark, folder):
    docs = views.labelled_docs(spark, folder)
    return docs.select("ex_id", "label", format_chat(views.SYSTEM_TEXT, F.col("text")).alias("prompt"))


def sft_format(spark, folder):
    return prompts(spark, folder).select("ex_id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("n_chars"))


def _shown(arrays):
    joined = {c: F.md5(F.array_join(c, ",")) for c in ("input_ids", "labels", "attention_mask")}
    return arrays.select(
        "ex_id", "window", *[c for c in ("batch",) if c in arrays.columns],
        F.size("input_ids").alias("n_tokens"),
        F.size(F.filter("labels", lambda t: t == -100)).alias("n_masked"),
        *[v.alias(f"{c}_md5") for c, v in joined.items()],
    )


def sft_vocabulary(spark, folder):
    """Every word of prompts and answers with its own id, frequent ones first."""
    split = prompts(spark, folder).select(*[dataset.split_words(F.col(c)).alias(c) for c in ("prompt", "label")])
    return vocabulary.learn_vocabulary(split, "prompt", "label")


def _coded(spark, folder):
    return dataset.build_examples(prompts(spark, folder).drop("text"), token_id=sft_vocabulary(spark, folder))


def sft_mask(spark, folder):
    return _shown(_coded(spark, folder))


def sft_pad(spark, folder):
    sizes = dataset.example_sizes(prompts(spark, folder))
    return _shown(dataset.pad_batches(_coded(spark, folder), seed=SEED, sizes=sizes))


def sft_chat(spark, folder):
    """All turns of all conversations in windows, the loss on what assistants say."""
    arrays = conversations.chat_examples(views.read_table(spark, folder, "conversations"))
    joined = {c: F.md5(F.array_join(c, ",")) for c in ("input_ids", "labels")}
    return arrays.select(
        "conv_id", "window", "n_turns", F.size("input_ids").alias("n_tokens"),
        F.size(F.filter("labels", lambda t: t != -100)).alias("n_learnt"), *[v.alias(f"{c}_md5") for c, v in joined.items()],
    )


def example_lines(spark, folder):
    """Documents as JSON lines, some of them cut off or without a field, read back: what is sound, and what is not."""
    docs = views.read_table(spark, folder, "documents")
    whole = F.to_json(F.struct("text", F.col("lang").alias("label")))
    kind = F.pmod(F.col("doc_id"), F.lit(10))
    line = F.when(kind == 3, F.substring(whole, 1, 9)).when(kind == 5, F.to_json(F.struct("text"))).otherwise(whole)
    path = scratch_path(spark, "examples")
    docs.select(line.alias("value")).write.text(f"{path}/lines")
    landed = files.land_examples(files.read_examples(spark, f"{path}/lines"), f"{path}/landed")
    sound = landed.rows.select(F.lit("sound").alias("status"), "label", F.length("text").cast("long").alias("n_chars"))
    rejected = landed.rejected.select(F.col("reason").alias("status"), F.lit(None).cast("string").alias("label"), F.lit(0).cast("long").alias("n_chars"))
    return sound.union(rejected).groupBy("status", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))


QUERIES = {
    q.__name__: q
    for q in (
        dedup_ci, cap_per_label, group_split, group_split_hashed, leakage_audit, leakage_row_split, augment_noise,
        resample_mix, hash_shuffle, sft_format, sft_vocabulary, sft_mask, sft_pad, sft_chat,
        example_lines,
    )
}

DOCS = """
docs AS (
    SELECT doc_id AS ex_id, text, concat('lang_', lang) AS label, source, concat(lang, '_', source) AS group_id
    FROM documents)
"""

GROUP_SPLIT = """
shuffled AS (
    SELECT group_id, row_number() OVER (ORDER BY md5(concat('42', group_id)), group_id) AS r, count(*) OVER () AS g
    FROM (SELECT DISTINCT group_id FROM docs)),
group_split AS (
    SELECT ex_id, group_id,
           CASE WHEN r <= greatest(1, floor(g * CAST(0.7 AS DOUBLE))) THEN 'train'
                WHEN r <= greatest(1, floor(g * CAST(0.7 AS DOUBLE))) + greatest(1, floor(g * CAST(0.15 AS DOUBLE)))
                THEN 'val' ELSE 'test' END AS split
    FROM docs JOIN shuffled USING (group_id))
"""


def _draw(key: str, seed: str = "42") -> str:
    return f"CAST(concat('0x', substring(md5(concat('{seed}', {key})), 1, 8)) AS BIGINT)"


def _share(key: str, seed: str = "42") -> str:
    return f"{_draw(key, seed)} / CAST(4294967296 AS DOUBLE)"


def _split(key: str) -> str:
    return f"""CASE WHEN {_share(key)} < CAST(0.7 AS DOUBLE) THEN 'train'
                    WHEN {_share(key)} < CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE) THEN 'val' ELSE 'test' END"""


_AUDIT = """
    SELECT group_id, count(DISTINCT split) AS n_sides, count(*) AS n_rows FROM {0}
    GROUP BY group_id HAVING count(DISTINCT split) > 1"""

_SYSTEM = views.SYSTEM_TEXT.replace("'", "''")

_ARRAYS = DOCS + f""",
prompts AS (
    SELECT ex_id, label, concat('<|im_start|>system', chr(10), '{_SYSTEM}<|im_end|>', chr(10), '<|im_start|>user',
                                chr(10), text, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10)) AS prompt
    FROM docs),
words AS (
    SELECT ex_id, list_filter(regexp_split_to_array(prompt, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS p, [label] AS a
    FROM prompts),
vocabulary AS MATERIALIZED (
    SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, word) + 2 AS id
    FROM (SELECT unnest(list_concat(p, a)) AS word FROM words) GROUP BY word),
placed_words AS (
    SELECT ex_id, unnest(list_concat(p, a)) AS word, unnest(range(len(p) + len(a))) AS i, len(p) AS answer_at FROM words),
ids AS (
    SELECT ex_id, coalesce(list(id ORDER BY i) FILTER (i < answer_at), []) AS p,
           list_append(coalesce(list(id ORDER BY i) FILTER (i >= answer_at), []), 1) AS a
    FROM placed_words JOIN vocabulary USING (word) GROUP BY ex_id),
windows AS (
    SELECT *, 512 - len(a) AS room,
           unnest(range(greatest(CAST(ceil(len(p) / CAST(512 - len(a) AS DOUBLE)) AS BIGINT), 1))) AS w FROM ids),
arrays AS (
    SELECT ex_id, CAST(w AS INT) AS "window", list_concat(p[w * room + 1:(w + 1) * room], a) AS input_ids,
           list_concat(list_transform(p[w * room + 1:(w + 1) * room], lambda x: -100), a) AS labels FROM windows)
"""

_SHOWN = """
    SELECT ex_id, "window", {batch} CAST(len(input_ids) AS INT) AS n_tokens,
           CAST(len(list_filter(labels, lambda t: t = -100)) AS INT) AS n_masked,
           md5(array_to_string(input_ids, ',')) AS input_ids_md5, md5(array_to_string(labels, ',')) AS labels_md5,
           md5(array_to_string(attention_mask, ',')) AS attention_mask_md5 FROM {table}"""



_CHAT = """
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL AND turn IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(role, 'user'), coalesce(text, '')) = 1),
    spoken AS (
        SELECT conv_id, turn, role,
               list_concat([concat('<|im_start|>', regexp_replace(role, '[ \t\n\x0B\f\r]+', '_', 'g'))],
                           list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> ''),
                           ['<|im_end|>']) AS words
        FROM said),
    begun AS (
        SELECT *, coalesce(sum(len(words)) OVER (PARTITION BY conv_id ORDER BY turn
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM spoken),
    tokens AS (
        SELECT conv_id, turn, start + i AS place, word, role = 'assistant' AND i > 0 AS learnt
        FROM (SELECT conv_id, turn, role, start, unnest(words) AS word, unnest(range(len(words))) AS i FROM begun)),
    vocabulary AS MATERIALIZED (
        SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) + 2 AS id FROM tokens GROUP BY word),
    arrays AS (
        SELECT conv_id, CAST(place // 512 AS INT) AS "window", CAST(count(DISTINCT turn) AS INT) AS n_turns,
               list(id ORDER BY place) AS input_ids, list(CASE WHEN learnt THEN id ELSE -100 END ORDER BY place) AS labels
        FROM tokens JOIN vocabulary USING (word) GROUP BY ALL)
    SELECT conv_id, "window", n_turns, CAST(len(input_ids) AS INT) AS n_tokens,
           CAST(len(list_filter(labels, lambda t: t <> -100)) AS INT) AS n_learnt,
           md5(array_to_string(input_ids, ',')) AS input_ids_md5, md5(array_to_string(labels, ',')) AS labels_md5
    FROM arrays"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _texts(values) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


_SWAPS = "\n".join(
    f"                       WHEN contains(t, {_text(a)}) AND {_draw('ex_id', f'42:swap{i}:')} % 2 = 0 THEN {_texts((a, b))}"
    for i, (a, b) in enumerate(TYPO_SWAPS)
)

_NOISE_SQL = f"""
    WITH framed AS (
        SELECT doc_id AS ex_id,
               concat({_texts(NOISE_PREFIXES)}[{_draw('doc_id', '42:prefix:')} % {len(NOISE_PREFIXES)} + 1], text,
                      {_texts(NOISE_SUFFIXES)}[{_draw('doc_id', '42:suffix:')} % {len(NOISE_SUFFIXES)} + 1]) AS t
        FROM documents),
    picked AS (
        SELECT *, CASE WHEN {_share('ex_id', '42:typo:')} >= CAST(0.12 AS DOUBLE) THEN NULL
{_SWAPS} END AS swap
        FROM framed),
    noisy AS (
        SELECT ex_id, CASE WHEN swap IS NULL THEN t
                           ELSE concat(substring(t, 1, strpos(t, swap[1]) - 1), swap[2],
                                       substring(t, strpos(t, swap[1]) + length(swap[1]))) END AS n
        FROM picked)
    SELECT ex_id, md5(n) AS noisy_md5, CAST(length(n) AS INT) AS n_chars FROM noisy"""

ORACLES = {
    "dedup_ci": f"WITH {DOCS} SELECT min(ex_id) AS ex_id, label FROM docs GROUP BY label, lower(text)",
    "cap_per_label": f"""WITH {DOCS}
        SELECT ex_id, label FROM docs QUALIFY row_number() OVER (PARTITION BY label ORDER BY ex_id) <= 90""",
    "group_split": f"WITH {DOCS}, {GROUP_SPLIT} SELECT * FROM group_split",
    "group_split_hashed": f"WITH {DOCS} SELECT ex_id, group_id, {_split('group_id')} AS split FROM docs",
    "leakage_audit": f"WITH {DOCS}, {GROUP_SPLIT}" + _AUDIT.format("group_split"),
    "leakage_row_split": f"WITH {DOCS}, row_split AS (SELECT group_id, {_split('ex_id')} AS split FROM docs)"
    + _AUDIT.format("row_split"),
    "augment_noise": _NOISE_SQL,
    "resample_mix": f"""
        SELECT event_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS day, event_type AS label
        FROM events
        WHERE CAST(ts AS DATE) < DATE '2024-01-16' OR event_type IN ('click', 'signup')
           OR {_share('event_id')} < CAST(0.25 AS DOUBLE)""",
    "hash_shuffle": f"""WITH {DOCS}
        SELECT ex_id, label, row_number() OVER (ORDER BY md5(concat('42', ex_id)), ex_id) - 1 AS position FROM docs""",
    "sft_format": f"""WITH {_ARRAYS}
        SELECT ex_id, md5(prompt) AS prompt_md5, CAST(length(prompt) AS INT) AS n_chars FROM prompts""",
    "sft_vocabulary": f"WITH {_ARRAYS} SELECT word, n, id FROM vocabulary",
    "sft_chat": _CHAT,
    "example_lines": """
        WITH lines AS (
            SELECT *, CASE WHEN doc_id % 10 = 3 THEN 'malformed' WHEN text IS NULL THEN 'no text'
                           WHEN doc_id % 10 = 5 OR lang IS NULL THEN 'no label' ELSE 'sound' END AS status
            FROM documents)
        SELECT status, CASE WHEN status = 'sound' THEN lang END AS label, count(*) AS n,
               CAST(sum(CASE WHEN status = 'sound' THEN length(text) ELSE 0 END) AS BIGINT) AS n_chars
        FROM lines GROUP BY ALL""",
    "sft_mask": f"""WITH {_ARRAYS},
        full_arrays AS (SELECT *, list_transform(input_ids, lambda x: 1) AS attention_mask FROM arrays)"""
    + _SHOWN.format(batch="", table="full_arrays"),
    "sft_pad": f"""WITH {_ARRAYS},
        placed AS (SELECT *, (row_number() OVER (ORDER BY md5(concat('42', ex_id, ':', "window")), concat(ex_id, ':', "window")) - 1) // 8 AS batch
                   FROM arrays),
        sized AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) AS longest FROM placed),
        padded AS (
            SELECT ex_id, "window", batch,
                   list_resize(input_ids, longest, 0) AS input_ids,
                   list_resize(labels, longest, -100) AS labels,
                   list_resize(list_transform(input_ids, lambda x: 1), longest, 0) AS attention_mask FROM sized)"""
    + _SHOWN.format(batch="batch,", table="padded"),
}
