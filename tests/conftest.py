import json
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from canvass.session import adaptive  # noqa: E402
from canvass.sources import schemas  # noqa: E402
from canvass.sources.responses import stage  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield adaptive(session)
    session.stop()


@pytest.fixture(scope="session")
def submit(spark):
    """Staged submissions from dictionaries; answers as (question, answer) pairs or whole entries."""

    def build(*docs):
        rows = []
        for i, doc in enumerate(docs, start=1):
            doc = {"poll_id": "p", "device_id": "d1", **doc}
            answers = doc.pop("answers", None)
            if answers is not None:
                doc["answers"] = [
                    {"question": a[0], "answer": a[1]} if isinstance(a, tuple) else a for a in answers
                ]
            rows.append((doc.pop("id", i), json.dumps(doc)))
        return stage(spark.createDataFrame(rows, "ingestion_id bigint, raw string")).drop("raw")

    return build


@pytest.fixture(scope="session")
def options(spark):
    """Option table from (id, question, value[, source[, catch_all[, label]]])."""

    def build(*rows, poll="p"):
        full = []
        for r in rows:
            r = list(r) + ["catalog", False, None][len(r) - 3 :]
            full.append((r[0], poll, r[1], r[2], r[3], r[5], None, r[4], None, datetime(2024, 1, 1)))
        return spark.createDataFrame(full, schemas.OPTION_TABLE)

    return build


@pytest.fixture(scope="session")
def taxonomy(spark):
    """Taxonomy from (option id, path or (key, value)[, condition])."""

    def build(*rows):
        full = []
        for r in rows:
            path = r[1] if isinstance(r[1], str) else None
            key, value = (None, None) if path else r[1]
            bucket = "preference" if path else "demographic"
            levels = path.split("|") if path else None
            full.append(
                (r[0], bucket, path, len(levels) if levels else None, levels, key, value, None, 0.9)
                + (r[2] if len(r) > 2 else None, "model", False, datetime(2024, 1, 1))
            )
        return spark.createDataFrame(full, schemas.TAXONOMY_TABLE)

    return build
