import pytest

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def rows(spark):
    """A frame from rows and a schema, with columns whose names clash with those used."""

    def make(schema, data, /, **extra):
        df = spark.createDataFrame(data, schema)
        for name, value in extra.items():
            df = df.selectExpr("*", f"{value} as `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def result(spark, sf_dir):
    """A registered query's rows at sf0.01, run once."""
    from epochfold.llm.queries import QUERIES

    known = {}
    by_name = {query.__name__: query for query in QUERIES}

    def run(prefix):
        if prefix not in known:
            (name,) = [n for n in by_name if n.startswith(prefix)]
            known[prefix] = [r.asDict(recursive=True) for r in by_name[name](spark, sf_dir).collect()]
        return known[prefix]

    return run


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
