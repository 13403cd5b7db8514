import pytest

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def table(spark, tmp_path_factory):
    """Write rows (doc_id, text[, lang, source]) as a documents table; its folder."""

    def write(rows, labels=(), extra=""):
        folder = tmp_path_factory.mktemp("sf")
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DDL)
        if extra:
            df = df.selectExpr("*", *extra.split("; "))
        df.repartition(3).write.parquet(f"file://{folder}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"file://{folder}/labels.parquet")
        return f"file://{folder}"

    return write


LONG = " ".join(f"word{i * 7919 % 1000}" for i in range(30_000))
#: Nulls, empties, ties, repeated rows, a very long text, odd characters.
ODD = [
    (1, "a b c d e f g h"), (2, "a  b\tc d e f g h"), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, LONG + " end"), (8, "x"), (9, "é 😀 \x1c y"),
    (10, None, None, None), (10, "twice"), (10, "twice"), (None, "no id"), (None, "no id"), (12, "A B C D E F G H", "fr", None), (13, "9 9 9 9"),
]
#: Extra columns whose names operators use inside.
CLASH = "1 AS id; 2 AS size; 3 AS value; 'x' AS digest; 4 AS _file; 5 AS n; 6 AS component; 7 AS bucket; 8 AS place; 9 AS rep; 10 AS members"


@pytest.fixture(scope="session")
def odd(table):
    return table(ODD, [(1, 1, 0), (3, None, None), (8, 0, 1), (None, 1, 1)], CLASH)


@pytest.fixture(scope="session")
def empty(table):
    return table([])


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
