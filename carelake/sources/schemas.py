"""Delivered descriptions: schema files and patient links of a delivery.

A delivery may describe its own tables: one ``<table>.json`` per table (a file, or a
folder of one) with ``{"fields": [{"name": ..., "type": ...}, ...]}``, and one file that tells how tables name
their patients, ``{"<table>": {"col": ..., "ref_col": ...}, ...}``.  What they say goes
before the static description in ``catalog``; tables that they do not name keep it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from carelake.catalog import DATE_COLUMNS, PATIENT_KEY_MAP

DATE_TYPES = ["date", "datetime"]


def delivered_date_columns(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """{table: date columns in schema order} from the schema files of a folder; a table
    whose schema has no date column has an empty list.  A file that is no schema raises."""
    table = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json(/[^/]*)?$", 1)
    files = spark.read.text(f"{folder.rstrip('/')}/*.json", wholetext=True).select(table.alias("table"), "value")
    fields = F.from_json("value", "fields array<struct<name string, type string>>")["fields"]
    names = F.transform(F.filter(fields, lambda f: f["type"].isin(*DATE_TYPES)), lambda f: f["name"])
    # one row a table
    found = files.select("table", names.alias("names")).collect()
    if bad := sorted(r["table"] for r in found if r["names"] is None):
        raise ValueError(f"no schema: {', '.join(bad)}")
    return {r["table"]: list(r["names"]) for r in found}


def delivered_patient_links(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """{table: {"col", "ref_col"}} from the patient-link file."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    links = json.loads(text)
    if not isinstance(links, dict) or any(not isinstance(x, dict) or not {"col", "ref_col"} <= x.keys() for x in links.values()):
        raise ValueError(f"{path} is no patient-link file")
    return {table: {"col": x["col"], "ref_col": x["ref_col"]} for table, x in links.items()}


def date_columns(delivered: Mapping[str, list[str]] | None = None) -> dict[str, list[str]]:
    """The static date columns, replaced for the tables that ``delivered`` names."""
    return {**DATE_COLUMNS, **(delivered or {})}


def patient_links(delivered: Mapping[str, Mapping[str, str]] | None = None) -> dict[str, Mapping[str, str]]:
    """The static patient links, replaced for the tables that ``delivered`` names."""
    return {**PATIENT_KEY_MAP, **(delivered or {})}
