import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from opinara.session import local_session

    session = local_session(
        4, shuffle_partitions=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """The hand-computed training corpus: raw lines and parsed reviews."""
    from opinara.sources.readers import lenient_lines

    lines = spark.createDataFrame(
        [
            ("1,5.0,great battery great screen love",),
            ("2,5.0,love case great fit",),
            ("3,1.0,battery died screen broken",),
            ("4,2.0,case broken broken refund great",),
            ("5,1.0",),
        ],
        "value string",
    )
    return lines, lenient_lines(lines)


@pytest.fixture(scope="session")
def golden_test(spark):
    from opinara.sources.readers import lenient_lines

    lines = [
        "1,5.0,great love charger",
        "2,1.0,broken  battery",
        "3,5.0,screen broken refund",
        "4,2.0,love fit",
    ]
    return lenient_lines(spark.createDataFrame([(line,) for line in lines], "value string"))
