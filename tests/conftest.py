import pytest

from lodestrata.session import session


@pytest.fixture(scope="session")
def spark():
    return session(cores=4, partitions=4, **{"spark.driver.memory": "4g"})
