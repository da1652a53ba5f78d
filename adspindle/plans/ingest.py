"""Raw log and range table to the enriched daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adspindle.operators.filters import ods_projection
from adspindle.operators.places import ip_geo_enrich
from adspindle.sources.adlog import compile_wide_rows
from adspindle.sources.workspace import Workspace


def enrich_log(log: DataFrame, ranges: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    compile_wide_rows(log.sparkSession)
    return ods_projection(ip_geo_enrich(log, ranges, workspace=workspace))
