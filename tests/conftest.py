import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wordgraph.session import local_session

    folder = str(tmp_path_factory.mktemp("checkpoints"))
    s = local_session(cores=8, shuffle_partitions=8, app="wordgraph-tests", checkpoint=folder)
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
