"""Options that the jobs share. Defaults come from the environment variables of the deployment."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from ..operators.iceberg import IcebergTable
from ..operators.versions import VersionedTable
from ..schema import STORED
from ..session import open_session, session_conf


def parser(description: str) -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(description=description)
    options.add_argument("--warehouse", default=os.environ.get("WAREHOUSE_PATH", "/opt/warehouse"))
    options.add_argument("--format", choices=("versions", "iceberg"), default="versions", help="table format")
    options.add_argument("--table", default="db.pos_transactions", help="table name below the warehouse")
    return options


def session(app: str, chosen: argparse.Namespace) -> SparkSession:
    return open_session(app, session_conf(chosen.format, chosen.warehouse))


def location(chosen: argparse.Namespace) -> str:
    """The table's folder, or its name in the catalogue."""
    if chosen.format == "iceberg":
        return f"local.{chosen.table}"
    return f"{chosen.warehouse}/{chosen.table.replace('.', '/')}"


def opened(spark: SparkSession, chosen: argparse.Namespace) -> VersionedTable | IcebergTable:
    if chosen.format == "iceberg":
        return IcebergTable(spark, location(chosen))
    return VersionedTable(spark, location(chosen), STORED)
