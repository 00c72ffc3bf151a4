"""The pipeline's row-keeping stages on columns of any name and type."""

from pyspark.sql import functions as F

from modelvigil.llm import language, mixing, secrets, simhash
from modelvigil.llm.tokens import default_path
from tests.llm.frames import documents

ROWS = [
    (1, "the house and the tree are here", "en", "a"), (1, "the house and the tree are here", "en", "a"),
    (2, "das haus und der baum sind hier", "de", "b"), (None, "token = abcdefghijklmnop", "en", None), (3, "", None, "a"),
    (4, None, "de", "a"), (1, "another text under this id", "en", "b"),
]


def odd(spark):
    docs = documents(spark, ROWS)
    return docs.withColumns({
        "a.b": F.col("doc_id"), "c`d": F.lit("x"), "tags": F.create_map(F.lit("k"), F.col("lang")),
        "nested": F.array(F.create_map(F.lit("k"), F.col("doc_id"))),
    })


def test_stages_keep_odd_columns(spark):
    docs = odd(spark)
    for stage in (
        language.identified, simhash.keep_first, lambda d: secrets.mask_secrets(d, default_path("byte_bpe_50k.tiktoken")),
        mixing.mixed_documents,
    ):
        out = stage(docs)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        rows = out.collect()
        assert rows and all(r["a.b"] == r.doc_id and r["c`d"] == "x" and r.tags == {"k": r.lang} for r in rows)
        if stage is simhash.keep_first:
            firsts = sorted((r.doc_id or 0, r.text or "") for r in rows)
    # Null, empty: fingerprint zero, linked; the smallest id of the two stays.
    assert firsts == sorted([(0, ROWS[3][1]), (1, ROWS[0][1]), (1, ROWS[6][1]), (2, ROWS[2][1]), (3, "")])


def test_documents_without_ids_are_dealt_apart(spark, tmp_path):
    rows = [(None, f"text number {i}", None, "s") for i in range(400)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    mixed = mixing.op10_mixing(spark, str(tmp_path)).collect()
    assert len(mixed) == 400 and len({r.place for r in mixed}) == 400
