import os
import tempfile
from pathlib import Path

import numpy as np
import pytest

ROOT = Path(__file__).resolve().parent.parent
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-")).config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def speech():
    """A voiced signal of so many seconds: harmonics under an envelope, a little noise, peak 0.3."""

    def make(seconds: float, rate: int = 16_000, seed: int = 0) -> np.ndarray:
        rng, t = np.random.default_rng(seed), np.arange(int(seconds * rate)) / rate
        x = sum(np.sin(2 * np.pi * 140 * k * t + k) / k for k in range(1, 7)) * (0.6 + 0.4 * np.sin(2 * np.pi * 3 * t)) + 0.01 * rng.standard_normal(len(t))
        return (0.3 * x / np.abs(x).max()).astype(np.float32)

    return make
