import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from folioforge.session import local_session

    return local_session(cpus=4, memory="3g", shuffle_partitions=4)


sys.path.insert(0, str(Path(__file__).resolve().parent))
