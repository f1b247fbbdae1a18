"""Sends this package to the executors, whose Python workers may not find it otherwise."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: the package (and corpus_pipeline, if there) as a zip file on the workers' path."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = Path(__file__).resolve().parent
    folder = os.path.realpath(tempfile.mkdtemp(prefix="maskwright-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(path := f"{folder}/maskwright-{os.getpid()}-{len(_sent)}.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
        if (pipeline := root.parent / "corpus_pipeline.py").exists():
            z.write(pipeline, pipeline.name)
    spark.sparkContext.addPyFile(path)
    _sent.add(app)
