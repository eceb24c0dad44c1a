import pytest

from tessera.session import build, ship


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build(4, 4, **{
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(root / "warehouse"),
        "spark.checkpoint.dir": f"file://{root}/checkpoints",
    })
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()
