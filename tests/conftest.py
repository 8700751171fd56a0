import pytest

from weftline import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", cores=4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    return s
