import pytest

pytest.importorskip("public_tokenizers")

from .conftest import ODD  # noqa: E402


def test_stages_one_by_one(spark, table):
    """Each stage keeps the columns of documents; copies, near copies and junk go, clean documents stay."""
    import corpus_pipeline
    from quarrylake.llm.common import store

    clean = [(i, " ".join(f"Word{i} goes{j} there{i * j % 7}, and here{j}." for j in range(20)), "en", f"s{i % 3}") for i in range(40)]
    copies = [(100 + i, clean[i][1], "en", "s0") for i in range(5)]
    near = [(200 + i, clean[i][1] + " End now.", "en", "s1") for i in range(5, 8)]
    junk = [(300 + i, "BUY!! NOW!! IT!! IS!! CHEAP!! " * 9, "en", "s2") for i in range(8)] + [(400 + i, " | ".join(f"c{j}" for j in range(40)), "en", "s2") for i in range(4)]
    folder = table(clean + copies + near + junk)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns, name
        docs = store(out, "stage")
        left.append({r.doc_id for r in docs.collect()})
    every = {r[0] for r in clean}
    assert left[0] == every | {r[0] for r in copies + near} and left[1] == every | {r[0] for r in near} and left[2] == every and left[3] <= every
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert len(pieces) == docs.count()


def test_odd_and_empty_tables(spark, odd, empty):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty).count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, odd).collect()} <= {r[0] for r in ODD}
