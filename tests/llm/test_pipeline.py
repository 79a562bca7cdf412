"""The pipeline against its stages' plain statements, and the registered queries on small tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.llm.test_operators import base, brute_components
from wordgraph.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        seen.append((docs, spark.read.parquet(str(tmp_path / name))))
        docs = seen[-1][1]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_duplicates", "packing"]
    before, after = seen[0]
    passed = {r["doc_id"] for r in before.collect() if not base(r["text"])[-1]}
    assert {r["doc_id"] for r in after.collect()} <= passed
    before, after = seen[2]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert {r["doc_id"] for r in after.collect()} == {k for k, _, _, kept in brute_components(rows) if kept}
    before, after = seen[3]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}


def test_stages_on_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("op2", "op4", "op5", "op8", "op10"))))
def test_registered(spark, name):
    table = "pages" if name.startswith("op4") else "documents"
    assert E.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()

def test_new_languages_and_odd_rows_through_the_stages(spark):
    """Two texts of a new language stay; clashing extra columns, null ids and texts and repeated rows are carried."""
    import random

    rng = random.Random(3)
    word = lambda: "".join(chr(1072 + rng.randrange(32)) for _ in range(rng.randrange(2, 9)))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rare = [(-1 - i, " ".join(word() for _ in range(150)), "uk", "s", 1) for i in range(2)]
    odd = [(-10, None, "en", None, None), (None, rare[0][1] + " " + rare[1][1], "uk", "s", 1), (-1, *rare[0][1:])]
    given = docs.unionByName(spark.createDataFrame(rare + odd, "doc_id long, text string, lang string, source string, n_chars long")
                             .select(*[F.col(c).cast(docs.schema[c].dataType) for c in docs.columns]))
    for name in ("_hash", "row", "key", "id", "label", "a.b"):
        given = given.withColumn(name, F.lit("mine"))
    given = given.cache()
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, given, SF)
        assert out.columns == given.columns
        rows = out.collect()
        ids = [r["doc_id"] for r in rows]
        assert {-1, -2} <= set(ids), name
        assert all(r["a.b"] == r["_hash"] == r["row"] == "mine" for r in rows)
        assert ids.count(-1) == (1 if name == "near_duplicates" else 2)
        assert None in ids and (name == "near_duplicates" or -10 not in ids)
