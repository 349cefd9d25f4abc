"""Change log and register derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlog.sources.register import read_register
from foldlog.sources.tables import read_table
from foldlog.staging import new_path

# A payload per event, in SQL that both engines run: the log's order depends on the exact text.
# state is present, null or absent; finalizedAt likewise; the workshop and the specialist are
# objects in some rows and plain text in others.
PAYLOAD_SQL = """concat(
  '{{"id":"', user_id, '","eventType":"', event_type, '","workOrder":', event_id,
  CASE event_id % 3 WHEN 0 THEN ',"state":"open"' WHEN 1 THEN ',"state":null' ELSE '' END,
  ',"correctiveActions":["a",', event_id % 7, ',{{"k":"v"}}],"partNumber":""',
  ',"analysis":{{"observation":"o', event_id % 11, '","bahia":null,"responsibleWorkshop":{{"workshopName":',
  CASE event_id % 2 WHEN 0 THEN concat('{{"code":', event_id % 5, '}}') ELSE '"plain"' END, '}}}}',
  CASE event_id % 4 WHEN 0 THEN ',"finalizedAt":{{"_seconds":null}}'
                    WHEN 1 THEN concat(',"finalizedAt":{{"_seconds":', {seconds}, '}}')
                    WHEN 2 THEN ',"finalizedAt":{{}}' ELSE '' END,
  ',"createdAt":{{"_seconds":', {seconds}, '}}',
  CASE event_id % 2 WHEN 0 THEN ',"specialist":{{"name":"s1"}}' ELSE ',"specialist":"s2"' END,
  '}}')"""

SPARK_PAYLOAD = PAYLOAD_SQL.format(seconds="unix_seconds(cast(ts AS timestamp))")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", "parquet")


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as log rows; a user with a large error is a deleted document."""
    is_delete = (F.col("event_type") == "error") & (F.col("value") > 150)
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("document_id"),
        F.when(is_delete, "DELETE").otherwise("UPDATE").alias("operation"),
        F.expr(SPARK_PAYLOAD).alias("data"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_id",
    )


def sheet_export(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers written as the CSV export of a worksheet and read back."""
    nation = F.col("s_nationkey")
    path = new_path(spark, "sheet")
    table(spark, folder, "supplier").select(
        F.format_string("%06d", "s_suppkey").alias("N° CASO PAT-AFA"),
        F.concat(F.lit("state "), nation).alias("ESTADO"),
        F.lit("").alias("INICIO DESARMADO"),
        F.format_string("%02d/%02d/2024", nation + 1, nation % 12 + 1).alias("EMISION"),
        F.concat(F.lit("+"), "s_suppkey").alias("OT MAIN"),
        F.col("s_name").alias("TALLER"),
        F.concat(F.lit("0"), nation, F.lit(".50")).alias("PN FALLA"),
        F.concat(F.lit('"a", '), nation).alias("ANALISTA"),
        F.concat(F.lit("line\nbreak "), nation).alias("Modo de Falla"),
        F.lit("-0").alias("Causa"),
        F.concat(F.lit("-.5"), nation).alias("CARGO TÉCNICO AFA"),
        F.concat(nation, F.lit("_0")).alias("COMPONENTE"),
        F.col("s_suppkey").alias("AGRUPADOR"),
    ).write.options(header=True, escape='"').csv(path)
    return read_register(spark, path)
