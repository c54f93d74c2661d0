import os

from pyspark.sql import functions as F

from cdrmill.operators.mapping import FIXED_CLOCK, map_med
from cdrmill.schema import SOURCE_MED, enriched_schema
from cdrmill.sinks.writers import (append_table, create_partitioned_table, export_csv,
                                   overwrite_table, write_per_file)


def _enriched(spark):
    rows = [("ND1", "ND2", "20240701", "10203000", "00000130", "91", "92", "TG1", "TG2", "MA",
             "MB", None, "1", "F.20240701.cdr", "20240701", "I", "POI1", "OP1", "FR1")]
    cols = ("incoming_node string, outgoing_node string, event_start_date string, "
            "event_start_time string, event_duration string, anum string, bnum string, "
            "incoming_path string, outgoing_path string, incoming_product string, "
            "outgoing_product string, event_direction string, record_sequence_number string, "
            "file_name string, original_date string, leg string, t_poi string, "
            "t_operator string, n_franchise string")
    return spark.createDataFrame(rows, cols)


def test_transit_first_direction_on_unsplit_row(spark):
    df = _enriched(spark)
    assert map_med(df, FIXED_CLOCK).first().EVENT_DIRECTION == "I"
    assert map_med(df, FIXED_CLOCK, transit_first=True).first().EVENT_DIRECTION == "T"
    assert map_med(df, FIXED_CLOCK).schema == map_med(df, FIXED_CLOCK).schema
    types = {f.name: f.dataType for f in enriched_schema(SOURCE_MED).fields}
    got = {f.name: f.dataType for f in map_med(df, FIXED_CLOCK).schema.fields}
    assert all(got[k] == v for k, v in types.items())


def test_partitioned_table_append_and_overwrite(spark, tmp_path):
    out = map_med(_enriched(spark), FIXED_CLOCK).withColumn(
        "processing_date", F.col("processing_date").cast("string"))
    schema = out.schema
    loc = str(tmp_path / "tbl")
    create_partitioned_table(spark, "cdr_enriched_t", schema, ["processing_date"], "parquet", loc)
    append_table(out, "cdr_enriched_t")
    append_table(out, "cdr_enriched_t")
    assert spark.table("cdr_enriched_t").count() == 2
    assert os.path.isdir(os.path.join(loc, "processing_date=2024-07-02"))
    overwrite_table(out, "cdr_enriched_copy")
    assert spark.table("cdr_enriched_copy").count() == 1
    spark.sql("DROP TABLE cdr_enriched_t")
    spark.sql("DROP TABLE cdr_enriched_copy")


def test_per_file_folders_and_plain_csv(spark, tmp_path):
    out = map_med(_enriched(spark), FIXED_CLOCK)
    write_per_file(out, str(tmp_path / "per_file"))
    assert os.path.isdir(tmp_path / "per_file" / "INPUTFILENAME=F.20240701.cdr" /
                         "processing_date=2024-07-02")
    export_csv(out.select("ANUM", "OUTGOING_POI"), str(tmp_path / "plain"), null_token="NA")
    text = spark.read.text(str(tmp_path / "plain")).first().value
    assert text == "91,NA"


def test_csv_time_format_option(spark, tmp_path):
    from cdrmill.sinks.writers import write_enriched
    out = map_med(_enriched(spark), FIXED_CLOCK).select("ANUM", "PROCESSEDTIME", "original_date",
                                                         "processing_date")
    write_enriched(out, str(tmp_path / "e"), "L1", fmt="csv", time_format="dd/MM/yyyy HH:mm")
    rows = spark.read.option("header", True).csv(str(tmp_path / "e")).collect()
    assert rows[0].PROCESSEDTIME == "02/07/2024 10:00"
