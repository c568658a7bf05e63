import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.wholeStage", "false")  # long rule expressions over few rows: compiling costs more than it saves
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.driver.memory", "3g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
