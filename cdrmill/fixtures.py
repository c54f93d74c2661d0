"""Stand-in inputs derived from the driver's test tables.

The test data has no call records, so these functions shape rows of
``lineitem``, ``supplier`` and ``nation`` into the inputs the jobs expect:
418-character call record lines with file names, trunk group and network
node masters, a processed-file log, master snapshots and ICT envelope
extracts.  They do none of the jobs' work (no parsing, duplicate check,
split, lookup or mapping); the same rows are written in DuckDB SQL in
``cdrmill.oracle`` so both engines start from identical input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.schema import CDR_FIELDS_AND_WIDTHS, ENRICHED_COLUMNS
from cdrmill.session import parallelism

ROWS_A_TASK = 1_000_000  # of lineitem, at most, where lines are shaped


def _s(c: Column) -> Column:
    return c.cast("string")


def _lp(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """lineitem x supplier, plus a repeated copy (``dup`` = 1) of every row
    with ``l_partkey % 7 = 0`` (one scan, the copy made by ``explode``).  ``spread`` is
    left out where the rows are shuffled before they are shaped."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    sup = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # The test tables are single-row-group files (one scan task); spread the
    # narrow base rows so the stand-in lines are shaped in parallel, as real
    # call-record files would be read, and in tasks that don't grow with the table.
    if spread:
        rows = _table(spark, sf_dir, "lineitem").count()  # from the files' footers
        li = li.repartition(max(parallelism(spark), -(-rows // ROWS_A_TASK)))
    b = li.join(sup, li.l_suppkey == sup.s_suppkey, "inner").drop("s_suppkey")
    copies = F.when(F.col("l_partkey") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return b.withColumn("dup", F.explode(copies))


def _common(c=F.col) -> dict[str, Column]:
    hi = (c("l_linenumber") % 3) != 0
    ho = (c("l_linenumber") % 2) == 0
    node = F.when(c("l_partkey") % 10 == 0, F.lit("ND99")).otherwise(
        F.concat(F.lit("ND"), _lp(c("s_nationkey"), 2)))
    path = F.when(c("l_partkey") % 11 == 0, F.lit("TG999999")).otherwise(
        F.concat(F.lit("TG"), _lp(c("l_suppkey"), 6)))
    blank = F.lit("")
    return {
        "hi": hi, "ho": ho,
        "incoming_node": F.when(hi, node).otherwise(blank),
        "outgoing_node": F.when(ho, node).otherwise(blank),
        "event_start_date": F.date_format(c("l_shipdate"), "yyyyMMdd"),
        "event_start_time": F.concat(_lp(c("l_orderkey") % 24, 2), _lp(c("l_partkey") % 60, 2),
                                     _lp(c("l_suppkey") % 60, 2), F.lit("00")),
        "event_duration": F.concat(F.lit("0000"),
                                   _lp(c("l_quantity").cast("bigint") % 60, 2),
                                   _lp(c("l_orderkey") % 60, 2)),
        "anum": F.concat(F.lit("91"), _lp(c("l_orderkey"), 10)),
        "bnum": F.concat(F.lit("92"), _lp(c("l_partkey"), 10)),
        "incoming_path": F.when(hi, path).otherwise(blank),
        "outgoing_path": F.when(ho, path).otherwise(blank),
        "incoming_product": F.when(hi, F.concat(F.lit("MM"), c("l_returnflag"))).otherwise(blank),
        "outgoing_product": F.when(ho, F.concat(F.lit("MM"), c("l_linestatus"))).otherwise(blank),
        "record_sequence_number": F.concat(_s(c("l_orderkey")), F.lit("-"),
                                           _s(c("l_linenumber")),
                                           F.when(c("dup") == 1, F.lit("-D")).otherwise(blank)),
    }


def cdr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` (418-character line) and ``file_name`` of every call record."""
    f = _common()
    k = F.col("l_orderkey") + F.col("dup")
    file_name = F.concat(F.lit("MED"), _s(k % 4), F.lit(".2024070"), _s(1 + k % 4),
                         F.lit("155048.cdr"))
    parts = [F.rpad(f.get(name, F.lit("")), width, " ") for name, width in CDR_FIELDS_AND_WIDTHS]
    return _base(spark, sf_dir).select(F.concat(*parts).alias("value"),
                                       file_name.alias("file_name"))


def processed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of files loaded before: the names of orders with ``l_orderkey % 4 = 0``."""
    li = _table(spark, sf_dir, "lineitem").where(F.col("l_orderkey") % 4 == 0)
    name = F.concat(F.lit("MED"), _s(F.col("l_orderkey") % 4), F.lit(".2024070"),
                    _s(1 + F.col("l_orderkey") % 4), F.lit("155048.cdr"))
    return li.select(name.alias("filename")).distinct()


def _trunk_rows(sup: DataFrame, poi_suffix: str = "", operator: Column | None = None) -> DataFrame:
    c = F.col
    return sup.select(
        F.concat(F.lit("TG"), _lp(c("s_suppkey"), 6)).alias("ID"),
        c("s_name").alias("NAME"),
        F.concat(F.lit("ND"), _lp(c("s_nationkey"), 2)).alias("FK_NNOD"),
        (operator if operator is not None
         else F.concat(F.lit("OP"), _s(c("s_suppkey") % 5))).alias("OPERATOR"),
        F.concat(F.lit("POI"), _s(c("s_nationkey")), F.lit(poi_suffix)).alias("POI"),
    )


def trunk_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trunk group master; suppliers with ``s_suppkey % 4 = 0`` appear twice
    (same key, another POI)."""
    sup = _table(spark, sf_dir, "supplier")
    return _trunk_rows(sup).unionByName(
        _trunk_rows(sup.where(F.col("s_suppkey") % 4 == 0), poi_suffix="B"))


def node_master(spark: SparkSession, sf_dir: str, with_all: bool = False) -> DataFrame:
    """Network node master; nation 15 is missing unless ``with_all``."""
    n = _table(spark, sf_dir, "nation")
    if not with_all:
        n = n.where(F.col("n_nationkey") != 15)
    return n.select(F.concat(F.lit("ND"), _lp(F.col("n_nationkey"), 2)).alias("ID"),
                    F.col("n_name").alias("NAME"),
                    F.concat(F.lit("FR"), _s(F.col("n_regionkey"))).alias("FK_ORGA_FRAN"))


def corrected_trunk_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trunk master plus rows for the unknown path ``TG999999`` on every
    node and for every path on the unknown node ``ND99``."""
    c = F.col
    n = _table(spark, sf_dir, "nation")
    sup = _table(spark, sf_dir, "supplier")
    unknown_path = n.select(F.lit("TG999999").alias("ID"), F.lit("FIXED").alias("NAME"),
                            F.concat(F.lit("ND"), _lp(c("n_nationkey"), 2)).alias("FK_NNOD"),
                            F.lit("OPFIX").alias("OPERATOR"), F.lit("POIFIX").alias("POI"))
    unknown_node = sup.select(F.concat(F.lit("TG"), _lp(c("s_suppkey"), 6)).alias("ID"),
                              c("s_name").alias("NAME"), F.lit("ND99").alias("FK_NNOD"),
                              F.concat(F.lit("OP"), _s(c("s_suppkey") % 5)).alias("OPERATOR"),
                              F.lit("POI99").alias("POI"))
    both = n.where(c("n_nationkey") == 0).select(
        F.lit("TG999999").alias("ID"), F.lit("FIXED").alias("NAME"), F.lit("ND99").alias("FK_NNOD"),
        F.lit("OPFIX").alias("OPERATOR"), F.lit("POIFIX").alias("POI"))
    return (trunk_master(spark, sf_dir).unionByName(unknown_path)
            .unionByName(unknown_node).unionByName(both))


def corrected_node_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation, plus the unknown node ``ND99``."""
    n = _table(spark, sf_dir, "nation")
    nd99 = n.where(F.col("n_nationkey") == 0).select(
        F.lit("ND99").alias("ID"), F.lit("UNKNOWN").alias("NAME"), F.lit("FR9").alias("FK_ORGA_FRAN"))
    return node_master(spark, sf_dir, with_all=True).unionByName(nd99)


def trunk_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dated snapshots of the trunk master; the older has OPERATOR 'OLD'."""
    sup = _table(spark, sf_dir, "supplier")
    new = _trunk_rows(sup).withColumn("snapshot_name", F.lit("Trunk_Group_20240410.csv"))
    old = _trunk_rows(sup, operator=F.lit("OLD")).withColumn(
        "snapshot_name", F.lit("Trunk_Group_20240401.csv"))
    return new.unionByName(old)


def _ict_source(c=F.col) -> Column:
    k = c("l_orderkey") + c("dup")
    return F.concat(F.lit("ICT"), _s(k % 8), F.lit("_2024070"), _s(1 + k % 8), F.lit(".csv"))


def ict_columns(c=F.col) -> dict[str, Column]:
    """The 42 columns of an extract record, as text, from a row of ``_base``."""
    f = _common()
    hi, ho = f["hi"], f["ho"]
    blank = F.lit("")
    direction = F.when(hi, F.lit("I")).when(ho, F.lit("O")).otherwise(blank)
    op = F.concat(F.lit("OP"), _s(c("l_suppkey") % 5))
    usage = _s(c("l_quantity").cast("bigint") * 60)
    cols = {
        "INCOMING_NODE": f["incoming_node"], "OUTGOING_NODE": f["outgoing_node"],
        "EVENT_START_DATE": f["event_start_date"], "EVENT_START_TIME": f["event_start_time"],
        "EVENT_DURATION": f["event_duration"], "ANUM": f["anum"], "BNUM": f["bnum"],
        "INCOMING_PATH": f["incoming_path"], "OUTGOING_PATH": f["outgoing_path"],
        "INCOMING_PRODUCT": f["incoming_product"], "OUTGOING_PRODUCT": f["outgoing_product"],
        "EVENT_DIRECTION": direction,
        "INCOMING_POI": F.when(hi, F.concat(F.lit("P"), _s(c("s_nationkey")))).otherwise(blank),
        "OUTGOING_POI": F.when(ho, F.concat(F.lit("P"), _s(c("s_nationkey")))).otherwise(blank),
        "INCOMING_OPERATOR": F.when(hi, op).otherwise(blank),
        "OUTGOING_OPERATOR": F.when(ho, op).otherwise(blank),
        "FRANCHISE": F.concat(F.lit("FR"), _s(c("s_nationkey") % 5)),
        "BILLING_OPERATOR": op,
        "BILLED_PRODUCT": F.concat(F.lit("MM"), c("l_returnflag")),
        "CALL_COUNT": F.lit("1"), "RATING_COMPONENT": F.lit("TC"), "TIER": F.lit("INTRA"),
        "CURRENCY": F.lit("INR"), "CASH_FLOW": F.when(hi, F.lit("R")).otherwise(F.lit("E")),
        "ACTUAL_USAGE": usage, "CHARGED_USAGE": usage, "CHARGED_UNITS": F.lit("0"),
        "UNIT_COST_USED": F.lit("0"), "AMOUNT": F.lit("0"), "COMPONENT_DIRECTION": direction,
        "FLAT_RATE_CHARGE": F.lit("0"), "PRODUCT_GROUP": F.lit("TELE"),
        "START_CALL_COUNT": F.lit("1"), "SOURCETYPE": F.lit("ICT"),
    }
    return {n: cols.get(n, blank) for n in ENRICHED_COLUMNS}


def ict_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICT extract records: the 42 columns as text, ``value`` (the CSV
    line) and ``source`` (extract file name)."""
    rows = _base(spark, sf_dir).select(*[v.alias(n) for n, v in ict_columns().items()],
                                       _ict_source().alias("source"))
    return rows.withColumn("value", F.concat_ws(",", *[F.col(n) for n in ENRICHED_COLUMNS]))


ICT_HEADER_LINE = ",".join(ENRICHED_COLUMNS)


def ict_envelope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source, section, value`` lines of the ICT extract files: a metadata
    line (section 0), the header (1), the records (2), two trailer lines
    (3, 4)."""
    rec = ict_records(spark, sf_dir)
    body = rec.select("source", F.lit(2).alias("section"), "value")
    return body.unionByName(_ict_envelopes(rec).select("source", "section", "value"))


def _ict_envelopes(rec: DataFrame) -> DataFrame:
    return rec.select("source").distinct().select(
        "source", F.explode(F.array(
            F.struct(F.lit(0).alias("section"), F.concat(F.lit("HDR,"), F.col("source")).alias("value")),
            F.struct(F.lit(1).alias("section"), F.lit(ICT_HEADER_LINE).alias("value")),
            F.struct(F.lit(3).alias("section"), F.concat(F.lit("TRL,"), F.col("source")).alias("value")),
            F.struct(F.lit(4).alias("section"), F.lit("EOF").alias("value")),
        )).alias("e")).select("source", "e.section", "e.value")


def ict_envelope_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of ``ict_envelope_lines`` before they are shaped: ``source, section``, the
    ``value`` of envelope lines only, and the narrow columns that ``ict_line`` makes the
    records of."""
    rec = _base(spark, sf_dir, spread=False).withColumn("source", _ict_source())
    body = rec.withColumns({"section": F.lit(2), "value": F.lit(None).cast("string")})
    return body.unionByName(_ict_envelopes(rec), allowMissingColumns=True)


def ict_line(c=F.col) -> Column:
    """``value`` of a row of ``ict_envelope_rows``."""
    return F.when(c("section") == 2, F.concat_ws(",", *ict_columns(c).values())).otherwise(c("value"))
