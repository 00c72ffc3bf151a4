"""Registered queries of the hyper-parameter search tables, one search per document source."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelvigil.functions.draws import draw
from modelvigil.operators import bayes, search
from modelvigil.plans.rolling import rounded
from modelvigil.session import materialise
from modelvigil.sources import views

KEYS = ["search_id", "trial_idx"]


def search_trials(spark, folder):
    return rounded(views.trial_results(spark, folder), "val_accuracy", "test_accuracy")


def search_grid(spark, folder):
    """The grid every source is searched over: planned cells per search."""
    sources = views.labelled_docs(spark, folder).select(F.col("source").alias("search_id")).distinct()
    axes = views.TRIAL_AXES
    cells = search.grid_array(axes)
    return sources.select("search_id", F.inline(cells))


def patience_stop(spark, folder):
    return rounded(search.patience_stop(views.trial_results(spark, folder)), "val_accuracy", "best_so_far")


def leaderboard(spark, folder):
    """Only trials that early stopping let run are ranked."""
    board = search.leaderboard(search.patience_stop(views.trial_results(spark, folder)).where("executed"))
    return rounded(board.select(*KEYS, "val_accuracy", "place"), "val_accuracy")


def search_untried(spark, folder):
    run = search.patience_stop(views.trial_results(spark, folder)).where("executed")
    return search.untried(search_grid(spark, folder), run)


def verify_winner(spark, folder):
    trials = materialise(views.trial_results(spark, folder))
    ran = search.patience_stop(trials).where("executed").select(*KEYS, "val_accuracy")
    return rounded(search.verify_winner(ran, trials), "val_accuracy", "test_accuracy", "gap")


def ablation(spark, folder):
    """Accuracy and self-consistency by one axis of the grid."""
    trials = views.trial_results(spark, folder).join(views.trial_consistency(spark, folder), KEYS).select(
        "min_hits", F.col("n_test").alias("n"), F.col("n_test_correct").alias("n_correct"),
        F.col("test_accuracy").alias("accuracy"), "n_agree", "n_examples",
    )
    return rounded(search.ablation(trials, "min_hits"), "accuracy", "best_accuracy", "self_consistency")


def _trained(spark, folder):
    """Features of all documents, and counts of the training side; a hash of the id chooses the side."""
    docs = views.labelled_docs(spark, folder).select("ex_id", "label", "text", (draw(F.col("ex_id"), 42) < 0.7).alias("train"))
    features = bayes.word_features(docs, "ex_id", keep=["label", "train"])
    return docs.drop("text"), features, bayes.statistics(docs.where("train"), features.where("train"))


def train_statistics(spark, folder):
    """What all classifiers of the grid are made of: occurrences and texts of each word by label."""
    stats = _trained(spark, folder)[2]
    sides = F.arrays_zip(F.array(*[F.lit(v) for v in stats.labels]).alias("label"), F.col("n"), F.col("d"))
    return stats.table.select("word", "docs", F.inline(sides)).where(F.col("d") > 0)


def train_select(spark, folder):
    """All naive Bayes cells fitted from one table and measured on the validation rows together."""
    docs, features, stats = _trained(spark, folder)
    grid = bayes.cells()
    scored = bayes.posteriors(docs.where(~F.col("train")), features.where(~F.col("train")), stats, grid, "ex_id")
    return rounded(bayes.select_cell(scored, stats, grid), "val_accuracy")


def train_posteriors(spark, folder):
    """Every validation row by the default cell: the label chosen and its score in millionths."""
    docs, features, stats = _trained(spark, folder)
    grid = [{"alpha": 1.0, "min_docs": 1, "presence": False}]
    scored = bayes.posteriors(docs.where(~F.col("train")), features.where(~F.col("train")), stats, grid, "ex_id")
    own = F.get("scores", F.lit(0))
    return scored.select("ex_id", "label", bayes.chosen(own, stats.labels).alias("predicted"), F.array_max(own).alias("score"))


QUERIES = {
    q.__name__: q
    for q in (search_trials, search_grid, patience_stop, leaderboard, search_untried, verify_winner, ablation,
              train_statistics, train_select, train_posteriors)
}

_TRIALS = """
letters AS (
    SELECT source AS search_id, concat('lang_', lang) AS label, length(text) AS size,
           CASE WHEN CAST(concat('0x', substring(md5(concat('42', doc_id)), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)
                     < 0.5 THEN 'val' ELSE 'test' END AS side,
           length(text) - length(regexp_replace(text, '[ßäöü]', '', 'g')) AS h0,
           length(text) - length(regexp_replace(text, '[ñáíóú]', '', 'g')) AS h1,
           length(text) - length(regexp_replace(text, '[èéêçà]', '', 'g')) AS h2
    FROM documents),
cells AS (
    SELECT a.min_hits, b.min_per_1000, c.first_class,
           CAST(row_number() OVER (ORDER BY a.min_hits, b.min_per_1000, c.first_class) - 1 AS INT) AS trial_idx
    FROM (VALUES (1), (2), (4)) a(min_hits), (VALUES (0), (2), (8)) b(min_per_1000),
         (VALUES (0), (1), (2)) c(first_class)),
answers AS (
    SELECT l.search_id, l.side, c.*,
           h0 >= min_hits AND h0 * 1000 >= size * min_per_1000 AS y0,
           h1 >= min_hits AND h1 * 1000 >= size * min_per_1000 AS y1,
           h2 >= min_hits AND h2 * 1000 >= size * min_per_1000 AS y2, l.label
    FROM letters l CROSS JOIN cells c),
said AS (
    SELECT *, CAST(label = CASE
        WHEN first_class = 0 THEN CASE WHEN y0 THEN 'lang_de' WHEN y1 THEN 'lang_es' WHEN y2 THEN 'lang_fr' ELSE 'lang_en' END
        WHEN first_class = 1 THEN CASE WHEN y1 THEN 'lang_es' WHEN y2 THEN 'lang_fr' WHEN y0 THEN 'lang_de' ELSE 'lang_en' END
        ELSE CASE WHEN y2 THEN 'lang_fr' WHEN y0 THEN 'lang_de' WHEN y1 THEN 'lang_es' ELSE 'lang_en' END END AS INT) AS ok
    FROM answers),
trials AS (
    SELECT search_id, trial_idx, min_hits, min_per_1000, first_class,
           count(*) FILTER (side = 'val') AS n_val, count(*) FILTER (side = 'test') AS n_test,
           count(*) FILTER (side = 'val' AND ok = 1) AS n_val_correct,
           count(*) FILTER (side = 'test' AND ok = 1) AS n_test_correct,
           avg(ok) FILTER (side = 'val') AS val_accuracy, avg(ok) FILTER (side = 'test') AS test_accuracy
    FROM said GROUP BY ALL)
"""

_REPLAY = _TRIALS + """,
replay AS (
    SELECT search_id, trial_idx, val_accuracy, TRUE AS executed,
           coalesce(val_accuracy > CAST(-1 AS DOUBLE) + CAST(0.005 AS DOUBLE), FALSE) AS improved,
           CAST(coalesce(val_accuracy, -1) AS DOUBLE) AS best_so_far,
           CASE WHEN val_accuracy IS NULL THEN 1 ELSE 0 END AS stalls
    FROM trials WHERE trial_idx = 0
    UNION ALL
    SELECT t.search_id, t.trial_idx, t.val_accuracy, r.stalls < 3,
           r.stalls < 3 AND coalesce(t.val_accuracy > r.best_so_far + CAST(0.005 AS DOUBLE), FALSE),
           CASE WHEN r.stalls < 3 AND t.val_accuracy > r.best_so_far + CAST(0.005 AS DOUBLE) THEN t.val_accuracy
                ELSE r.best_so_far END,
           CASE WHEN r.stalls >= 3 THEN r.stalls
                WHEN t.val_accuracy > r.best_so_far + CAST(0.005 AS DOUBLE) THEN 0 ELSE r.stalls + 1 END
    FROM replay r JOIN trials t ON t.search_id = r.search_id AND t.trial_idx = r.trial_idx + 1)
"""

_BAYES = """
sides AS (
    SELECT doc_id AS ex_id, concat('lang_', lang) AS label,
           list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS words,
           CAST(concat('0x', substring(md5(concat('42', doc_id)), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)
               < CAST(0.7 AS DOUBLE) AS train
    FROM documents),
features AS MATERIALIZED (
    SELECT ex_id, label, train, word, count(*) AS tf FROM (SELECT ex_id, label, train, unnest(words) AS word FROM sides)
    GROUP BY ALL),
counted AS MATERIALIZED (
    SELECT word, label, sum(tf) AS n, count(*) AS d FROM features WHERE train AND label IS NOT NULL GROUP BY ALL),
seen AS (SELECT word, sum(d) AS docs FROM counted GROUP BY word),
classes AS (
    SELECT label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM sides WHERE train AND label IS NOT NULL GROUP BY label),
bayes_cells AS (
    SELECT *, CAST(row_number() OVER (ORDER BY alpha, min_docs, presence) - 1 AS INT) AS trial_idx
    FROM (VALUES (CAST(0.1 AS DOUBLE)), (1.0), (10.0)) a(alpha), (VALUES (1), (3)) b(min_docs), (VALUES (FALSE), (TRUE)) c(presence)),
whole AS (
    SELECT trial_idx, label, sum(CASE WHEN presence THEN d ELSE n END) AS total
    FROM bayes_cells JOIN seen ON docs >= min_docs JOIN counted USING (word) GROUP BY ALL),
kept AS (SELECT trial_idx, count(*) AS words FROM bayes_cells JOIN seen ON docs >= min_docs GROUP BY trial_idx),
weights AS MATERIALIZED (
    SELECT c.trial_idx, c.presence, s.word, k.label,
           CAST(round(ln((coalesce(CASE WHEN c.presence THEN t.d ELSE t.n END, 0) + c.alpha)
                         / (coalesce(w.total, 0) + c.alpha * kept.words)) * 1000000) AS BIGINT) AS weight
    FROM bayes_cells c JOIN seen s ON s.docs >= c.min_docs JOIN kept ON kept.trial_idx = c.trial_idx CROSS JOIN classes k
    LEFT JOIN counted t ON t.word = s.word AND t.label = k.label
    LEFT JOIN whole w ON w.trial_idx = c.trial_idx AND w.label = k.label),
sums AS (
    SELECT f.ex_id, w.trial_idx, w.label, sum(w.weight * CASE WHEN w.presence THEN 1 ELSE f.tf END) AS score
    FROM features f JOIN weights w ON w.word = f.word WHERE NOT f.train GROUP BY ALL),
scored AS (
    SELECT s.ex_id, s.label, c.trial_idx, k.label AS guess,
           CAST(coalesce(m.score, 0) AS BIGINT) + CAST(round(ln(k.share) * 1000000) AS BIGINT) AS score
    FROM sides s CROSS JOIN bayes_cells c CROSS JOIN classes k
    LEFT JOIN sums m ON m.ex_id = s.ex_id AND m.trial_idx = c.trial_idx AND m.label = k.label
    WHERE NOT s.train),
said_by AS (
    SELECT ex_id, label, trial_idx, guess AS predicted, score FROM scored
    QUALIFY row_number() OVER (PARTITION BY ex_id, trial_idx ORDER BY score DESC, guess) = 1)
"""

ORACLES = {
    "train_statistics": f"""WITH {_BAYES}
        SELECT word, CAST(docs AS BIGINT) AS docs, label, CAST(n AS BIGINT) AS n, d FROM counted JOIN seen USING (word)""",
    "train_posteriors": f"""WITH {_BAYES}
        SELECT ex_id, label, predicted, score FROM said_by JOIN bayes_cells USING (trial_idx)
        WHERE alpha = 1 AND min_docs = 1 AND NOT presence""",
    "train_select": f"""WITH {_BAYES}
        SELECT *, CAST(row_number() OVER (ORDER BY val_accuracy DESC, trial_idx) AS INT) AS place
        FROM (SELECT trial_idx, alpha, min_docs, presence, count(*) AS n_val,
                     count(*) FILTER (predicted = label) AS n_correct,
                     round(count(*) FILTER (predicted = label) / CAST(count(*) AS DOUBLE), 6) AS val_accuracy
              FROM said_by JOIN bayes_cells USING (trial_idx) GROUP BY ALL)""",
    "search_trials": f"""WITH {_TRIALS}
        SELECT * REPLACE (round(val_accuracy, 6) AS val_accuracy, round(test_accuracy, 6) AS test_accuracy) FROM trials""",
    "search_grid": f"""WITH {_TRIALS}
        SELECT search_id, trial_idx, min_hits, min_per_1000, first_class
        FROM (SELECT DISTINCT search_id FROM letters) CROSS JOIN cells""",
    "patience_stop": f"""WITH RECURSIVE {_REPLAY}
        SELECT search_id, trial_idx, round(val_accuracy, 6) AS val_accuracy, executed, improved,
               round(best_so_far, 6) AS best_so_far, CAST(stalls AS INT) AS stalls FROM replay""",
    "leaderboard": f"""WITH RECURSIVE {_REPLAY}
        SELECT search_id, trial_idx, round(val_accuracy, 6) AS val_accuracy,
               CAST(row_number() OVER (PARTITION BY search_id ORDER BY val_accuracy DESC NULLS LAST, trial_idx) AS INT) AS place
        FROM replay WHERE executed""",
    "search_untried": f"""WITH RECURSIVE {_REPLAY}
        SELECT t.search_id, t.trial_idx, t.min_hits, t.min_per_1000, t.first_class
        FROM trials t JOIN replay r USING (search_id, trial_idx) WHERE NOT r.executed""",
    "verify_winner": f"""WITH RECURSIVE {_REPLAY}
        SELECT search_id, trial_idx, round(t.val_accuracy, 6) AS val_accuracy, round(test_accuracy, 6) AS test_accuracy,
               round(t.val_accuracy - test_accuracy, 6) AS gap
        FROM trials t JOIN replay r USING (search_id, trial_idx) WHERE r.executed
        QUALIFY row_number() OVER (PARTITION BY search_id ORDER BY t.val_accuracy DESC NULLS LAST, trial_idx) = 1""",
    "ablation": f"""WITH {_TRIALS},
        halves AS (
            SELECT source AS search_id, doc_id, run,
                   CASE WHEN run = 0 THEN substring(text, 1, length(text) // 2) ELSE substring(text, length(text) // 2 + 1) END AS part
            FROM documents, (VALUES (0), (1)) r(run)
            WHERE CAST(concat('0x', substring(md5(concat('42', doc_id)), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) >= 0.5),
        half_letters AS (
            SELECT search_id, doc_id, run, length(part) AS size,
                   length(part) - length(regexp_replace(part, '[ßäöü]', '', 'g')) AS h0,
                   length(part) - length(regexp_replace(part, '[ñáíóú]', '', 'g')) AS h1,
                   length(part) - length(regexp_replace(part, '[èéêçà]', '', 'g')) AS h2
            FROM halves),
        half_found AS (
            SELECT l.search_id, l.doc_id, l.run, c.*, h0 >= min_hits AND h0 * 1000 >= size * min_per_1000 AS y0,
                   h1 >= min_hits AND h1 * 1000 >= size * min_per_1000 AS y1,
                   h2 >= min_hits AND h2 * 1000 >= size * min_per_1000 AS y2
            FROM half_letters l CROSS JOIN cells c),
        half_said AS (
            SELECT search_id, doc_id, trial_idx, min_hits, CASE
                WHEN first_class = 0 THEN CASE WHEN y0 THEN 'lang_de' WHEN y1 THEN 'lang_es' WHEN y2 THEN 'lang_fr' ELSE 'lang_en' END
                WHEN first_class = 1 THEN CASE WHEN y1 THEN 'lang_es' WHEN y2 THEN 'lang_fr' WHEN y0 THEN 'lang_de' ELSE 'lang_en' END
                ELSE CASE WHEN y2 THEN 'lang_fr' WHEN y0 THEN 'lang_de' WHEN y1 THEN 'lang_es' ELSE 'lang_en' END END AS said
            FROM half_found),
        agreed AS (
            SELECT min_hits, avg(agree) AS self_consistency
            FROM (SELECT min_hits, CAST(min(said) = max(said) AS INT) AS agree FROM half_said
                  GROUP BY search_id, doc_id, trial_idx, min_hits) GROUP BY min_hits)
        SELECT min_hits, count(*) AS n_trials, round(sum(n_test_correct) / CAST(sum(n_test) AS DOUBLE), 6) AS accuracy,
               round(max(test_accuracy), 6) AS best_accuracy, round(any_value(self_consistency), 6) AS self_consistency
        FROM trials JOIN agreed USING (min_hits) GROUP BY min_hits""",
}
