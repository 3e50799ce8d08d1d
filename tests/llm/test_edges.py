"""Every operator on odd rows: nulls in every column, repeated rows, a very long text, and extra columns named like an operator's own."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from opslake.llm import op2_decontaminate, op3_toxicity, op4_pii, op5_language, op6_repeats, op7_jaccard, op8_embeddings, op9_quality, op10_bpe

from .conftest import prose

BPE = public_tokenizers.path("word_bpe_49k.json")
#: Names that the operators use for columns of their own, or return.
CLASHING = "a b c e f h i k l n p q r s t x y id at key keys seg part node nodes region label root size hash score n_words n_ids ids words pos shingles set component_id n_links kept item item_id lang_pred place doc span spans entity entities attempt start end".split()

R = random.Random(9)
ITEM = prose(R, 30)
LONG = prose(R, 30_000)
TEXTS = [(1, "Write to bob.smith@mail.example.com or (555) 201-3344, says Mr. Paul Weber."), (2, ITEM), (3, f"{prose(R, 20)} {ITEM} {prose(R, 20)}"), (4, LONG), (5, LONG), (6, ""), (7, None), (8, "\t \n"), (9, "x")]
ROWS = [(i, t, "en" if i % 2 else None, None if i % 3 else "src", None if t is None else len(t), i % 2, 1) for i, t in TEXTS]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality int, toxic int"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (None, "")], "item_id long, text string")


OPERATORS = {
    "op2": lambda s, d: op2_decontaminate.overlaps(d, items(s)),
    "op3": lambda s, d: op3_toxicity.score(d, op3_toxicity.fit(d, d)),
    "op4": lambda s, d: op4_pii.pseudonymize(d).select("doc_id", "text", "n_entities"),
    "op5": lambda s, d: op5_language.identify(d, op5_language.fit(d)),
    "op6": lambda s, d: op6_repeats.digest(op6_repeats.removed(d)),
    "op7": lambda s, d: op7_jaccard.components(d),
    "op9": lambda s, d: op9_quality.score(d, op9_quality.cotrain(d, d.select("doc_id", "quality").distinct())),
    "op10": lambda s, d: op10_bpe.digests(d, BPE),
}


def told(df):
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    return sorted(map(repr, df.select(rounded).collect()))


def beside(df):
    """The rows with extra columns of clashing names."""
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING if c not in df.columns])


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(spark, name):
    d = docs(spark, ROWS)
    want = told(OPERATORS[name](spark, d))
    assert told(OPERATORS[name](spark, beside(d))) == want
    if name not in ("op2", "op7"):
        assert len(want) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_without_key_and_repeated_rows(spark, name):
    odd = [*ROWS, ROWS[0], ROWS[2], (None, f"call (555) 201-3344 {ITEM}", None, None, None, None, None), (None, None, None, None, None, None, None)]
    got = OPERATORS[name](spark, docs(spark, odd)).collect()
    assert {r.doc_id for r in got} - {None} <= {i for i, _ in TEXTS}
    if name in ("op3", "op4", "op5", "op9", "op10"):
        assert len(got) == len(odd)


def test_embeddings_beside_columns_of_any_name(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (2, [1.0, 0.01], 1), (3, [0.0, 1.0], 1), (4, None, 1), (5, [1.0, None], 1), (6, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    want = told(op8_embeddings.near_duplicates(df))
    extra = df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING if c not in df.columns])
    assert told(op8_embeddings.near_duplicates(extra)) == want and len(want) == len(rows)
