import os
import sys

import pytest
from hypothesis import settings

# PLAYTALLY_HYPOTHESIS=deep runs the property tests with many more examples.
settings.register_profile("default", max_examples=25, deadline=None)
settings.register_profile("deep", max_examples=300, deadline=None)
settings.load_profile(os.environ.get("PLAYTALLY_HYPOTHESIS", "default"))

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from playtally.session import build_session

    ckpt = tmp_path_factory.mktemp("checkpoint")
    session = build_session("local[4]", app_name="playtally-tests", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(ckpt),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark, request):
    from playtally.session import scratch_dir

    return scratch_dir(spark, request.node.name.replace("[", "-").replace("]", ""))
