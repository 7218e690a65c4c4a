import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from windrow.scale import checkpoint_dir, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("windrow-tests", 8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def engine(spark, sf):
    """Engine and vectors of the small corpus, with short fits."""
    from windrow.plans import engine as E
    from windrow.queries import models, roles as R

    params = models.settings()
    params.epochs, params.restarts, params.svm_features = 6, 3, 256
    return E.build(R.books(spark, sf), R.catalog(spark, sf), R.taxonomy(spark, sf), params)
