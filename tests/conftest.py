import os

import pytest

from daymark.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("work"))  # keeps warehouse folders out of the repository
    session = local_session(4, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_days(spark):
    from daymark.sources.events import read_patient_days

    return read_patient_days(spark, SMALL).cache()
