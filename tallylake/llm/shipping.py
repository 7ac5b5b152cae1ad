"""Making the package importable in Python workers where the cluster does not provide it."""

import os
import shutil
import tempfile

import tallylake

_PARENT = os.path.dirname(os.path.dirname(os.path.abspath(tallylake.__file__)))


def ship(spark):
    """Send the package to the executors, once per session, unless PYTHONPATH already leads to it everywhere."""
    context = spark.sparkContext
    if _PARENT in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_tallylake_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="tallylake-")
    context.addPyFile(shutil.make_archive(f"{folder}/tallylake", "zip", _PARENT, "tallylake"))
    context._tallylake_shipped = True
