import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from padronix.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, app="tests")


@pytest.fixture
def no_small_tables(monkeypatch):
    """Make every size check fail, so that the shuffle paths run."""
    from padronix.operators import quantiles, sampling, sizing

    monkeypatch.setattr(sizing, "pin_small", lambda table, max_rows=0: None)
    monkeypatch.setattr(quantiles, "pin_small", lambda table, max_rows=0: None)
    monkeypatch.setattr(sampling, "pin_small", lambda table, max_rows=0: None)
