import pytest

from ledgerfold.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 2, spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
