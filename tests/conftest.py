import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_tasks(monkeypatch):
    """Groups are hot beyond the limit alone, however few rows an average task has."""
    monkeypatch.setattr("affinis.plans.skew.average", lambda spark, total: 0)


@pytest.fixture(autouse=True)
def limits_hold(request):
    """Tests with a limit of a few rows run the split paths."""
    if "limit" in getattr(getattr(request.node, "callspec", None), "params", {}):
        request.getfixturevalue("small_tasks")


@pytest.fixture
def ratings(spark):
    def make(rows):
        return spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")

    return make


@pytest.fixture
def sets(spark):
    """Distinct (id, element) rows of a mapping from id to members."""

    def make(members):
        rows = [(i, e) for i, s in members.items() for e in set(s)]
        return spark.createDataFrame(rows, "id BIGINT, element BIGINT")

    return make


def tuples(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
