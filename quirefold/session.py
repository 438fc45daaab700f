"""What a session needs before it runs Python functions of this package."""

import pathlib
import shutil
import tempfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, for sessions not started with it (``--py-files``)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
