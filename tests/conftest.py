import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="citylake-test-", dir="/tmp")
    os.environ.setdefault("CITYLAKE_TMP", scratch)
    from citylake.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="citylake-tests", shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                         "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}"})
    checkpoint_dir(s)  # unset in tests: a private folder is chosen
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


@pytest.fixture(autouse=True)
def no_views_left(request):
    """A test's temporary views end with it: the session is shared, and its views are listed beside every database's tables."""
    s = request.getfixturevalue("spark") if "spark" in request.fixturenames else None
    yield
    if s is not None:
        for r in s.sql("SHOW VIEWS").collect():
            if r.isTemporary:
                s.catalog.dropTempView(r.viewName)
