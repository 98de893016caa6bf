"""Vintage CSV ingest (S1-S8): two-line-header monthly files -> long panel.

File layout: line 1 = header (date column, then series ids), line 2 = the
stationarity code per series (by position, whatever its label), then one line
per month with the date written ``M/D/YYYY``. A vintage is one file named
``YYYY-MM-md.csv``; ``panel_id`` = the vintage.

All landed vintages are read in one job, line by line: a file larger than a task
is cut into splits, and its header and code lines, the first two of its first
split, meet its data lines by vintage. Whole files (a row each) are read by the
stream only. Everything after that is columnar Spark SQL.
"""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from macropanel.model import DATE, PANEL, SERIES, VALUE

# Cell texts read as missing, date text format, file name pattern.
NULL_TOKENS = ("", "NaN", ".")
DATE_FORMAT = "M/d/yyyy"
VINTAGE_PATTERN = r"(\d{4}-\d{2})-md\.csv$"
SKIP_TCODE_CELLS = ("", "tcode")


def vintage_name(ref: Column, pin: Column | None = None) -> Column:
    """``YYYY-MM`` of the month before ``ref``; a pinned ``Y-M`` wins, re-padded to 4/2 digits."""
    prev = F.date_format(F.add_months(ref, -1), "yyyy-MM")
    if pin is None:
        return prev
    parts = F.split(pin, "-", 2)
    pinned = F.concat(
        F.lpad(parts[0].cast("int").cast("string"), 4, "0"), F.lit("-"), F.lpad(parts[1].cast("int").cast("string"), 2, "0")
    )
    return F.coalesce(F.when(F.length(F.trim(pin)) > 0, pinned), prev)


def vintage_path(base: str, ref: Column, pin: Column | None = None) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), vintage_name(ref, pin), F.lit("-md.csv"))


def refuse(names: list[str], why: str) -> None:
    """Raise with every name, if there is one."""
    if names:
        raise ValueError(f"{why} ({len(names)}): " + ", ".join(sorted(names)))


def landed_files(spark: SparkSession, path: str, vintages: list[str] | None = None) -> list[str]:
    """Vintage files under ``path``; only ``vintages`` (``YYYY-MM``) if given, by their names, without listing the rest.

    Spark's file sources skip zero-length files, so empty ones are found from
    the file system (names and sizes only) and raise, as do files whose
    name names no vintage and vintages that have no file.
    """
    if vintages is not None:
        base = path.rstrip("/")
        found = {v: listing(spark, f"{base}/{v}-md.csv") for v in vintages}
        refuse([v for v, files in found.items() if not files], "vintage without a file")
        named = [x for files in found.values() for x in files]
    else:
        named = listing(spark, path)
        refuse([f for f, _ in named if not re.search(VINTAGE_PATTERN, f)], "file name without a vintage")
    refuse([f for f, size in named if size == 0], "empty vintage file")
    return [f for f, _ in named]


def read_vintage_files(spark: SparkSession, path: str, vintages: list[str] | None = None) -> DataFrame:
    """``(panel_id, value)``: one row per landed vintage file, whole text; only ``vintages`` if given."""
    named = landed_files(spark, path, vintages)
    if not named:
        return spark.createDataFrame([], f"{PANEL} string, value string")
    files = spark.read.text(named, wholetext=True).select(F.col("_metadata.file_path").alias("_path"), "value")
    return files.select(F.regexp_extract("_path", VINTAGE_PATTERN, 1).alias(PANEL), "value")


def read_vintage_lines(spark: SparkSession, path: str, vintages: list[str] | None = None) -> DataFrame:
    """``(panel_id, ln, line)``: header (0), code line (1) and the data lines (2) of landed vintages, read by splits.

    Line numbers do not exist where a file is cut, so the header and the code line are the first two lines of the split at
    offset 0, in the order in which a task reads them; a data line is any that is neither's text. The two lines must lie
    in that split (``spark.sql.files.maxPartitionBytes``); a file whose second line does not fails by name.
    """
    named = landed_files(spark, path, vintages)
    if not named:
        return spark.createDataFrame([], f"{PANEL} string, ln int, line string")
    lines = spark.read.text(named).select(
        F.regexp_extract("_metadata.file_path", VINTAGE_PATTERN, 1).alias(PANEL), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"), F.rtrim("value", F.lit("\r")).alias("line")
    )
    # a rank limit goes below the exchange: a task hands on two lines of a file
    rank = F.row_number().over(Window.partitionBy(PANEL).orderBy("_n"))
    top = lines.where("_at = 0").withColumn("_r", rank).where("_r <= 2")
    head = top.groupBy(PANEL).agg(F.max(F.when(F.col("_r") == 1, F.col("line"))).alias("_h"), F.max(F.when(F.col("_r") == 2, F.col("line"))).alias("_c"))
    coded = F.when(F.col("_c").isNotNull(), F.col("_c")).otherwise(F.raise_error(F.concat(F.lit("no code line in the first split of vintage "), F.col(PANEL))))
    first = head.select(PANEL, F.posexplode(F.array("_h", coded)).alias("ln", "line"))
    # the two lines become null here, behind the join, so that no parsing of theirs can be moved below it
    line = F.when((F.col("line") != F.col("_h")) & (F.col("line") != F.col("_c")), F.col("line"))
    data = lines.select(PANEL, "line").join(head, PANEL).select(PANEL, F.lit(2).alias("ln"), line.alias("line"))
    return first.unionByName(data.where("line is not null"))


def land_vintages(lines: DataFrame, landing: str) -> list[str]:
    """Write ``(panel_id, ln, line)`` as one file per vintage into ``landing``; the vintages landed.

    Spark's text writer streams each panel's sorted lines into a staging folder; a file appears in the landing folder
    whole, by a rename.
    """
    spark, staging = lines.sparkSession, f"{landing.rstrip('/')}-staging-{uuid.uuid4().hex}"
    rows = lines.repartition(PANEL).sortWithinPartitions(PANEL, "ln").select(PANEL, F.col("line").alias("value"))
    rows.write.partitionBy(PANEL).option("lineSep", "\r\n").text(staging)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(landing))
    landed = []
    for folder in fs.listStatus(path(staging)):
        if folder.isDirectory() and folder.getPath().getName().startswith(f"{PANEL}="):
            vintage = folder.getPath().getName().split("=", 1)[1]
            (part,) = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            fs.rename(part, path(f"{landing.rstrip('/')}/{vintage}-md.csv"))
            landed.append(vintage)
    fs.delete(path(staging), True)
    return sorted(landed)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, size) of the vintage files under ``path`` (Hadoop FileSystem glob)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(conf)
    found = []
    for st in fs.globStatus(jpath) or []:
        for f in fs.listStatus(st.getPath()) if st.isDirectory() else [st]:
            name = f.getPath().toString()
            if f.isFile() and name.endswith(".csv"):
                found.append((name, f.getLen()))
    return found


def split_lines(files: DataFrame) -> DataFrame:
    """``(panel_id, ln, line)``; an empty payload raises; ``\\r`` before ``\\n`` is dropped."""
    checked = files.select(
        PANEL, F.when(F.length("value") > 0, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("empty vintage file: "), F.col(PANEL)))).alias("value")
    )
    return checked.select(PANEL, F.posexplode(F.split("value", "\r?\n")).alias("ln", "line"))


def series_dim(lines: DataFrame) -> DataFrame:
    """``(panel_id, series_id, pos, tcode)`` from the header and code lines.

    Codes parse as ``int(float(text))``; blank cells and the literal ``tcode``
    are skipped; a code line shorter than the header leaves the rest null.
    """
    header = lines.where(F.col("ln") == 0).select(PANEL, F.split("line", ",").alias("hdr"))
    codes = lines.where(F.col("ln") == 1).select(PANEL, F.split("line", ",").alias("tc"))
    names = header.join(codes, PANEL, "left").select(PANEL, "tc", F.posexplode("hdr").alias("p", SERIES)).where(F.col("p") > 0)
    cell = F.try_element_at(F.col("tc"), F.col("p") + 1)
    tcode = F.when(cell.isNotNull() & ~F.trim(cell).isin(*SKIP_TCODE_CELLS), cell.cast("double").cast("int"))
    return names.select(PANEL, SERIES, (F.col("p") - 1).cast("int").alias("pos"), tcode.alias("tcode"))


def parse_lines(lines: DataFrame, date_floor: date = date(1959, 1, 1)) -> tuple[DataFrame, DataFrame]:
    """Lines -> (long panel, series dimension). Rows dated before the floor (or undated) drop."""
    dim = series_dim(lines)
    data = lines.where(F.col("ln") > 1).select(PANEL, "ln", F.split("line", ",").alias("cells"))
    width = lines.where(F.col("ln") == 0).select(PANEL, F.size(F.split("line", ",")).alias("width"))
    date_text = F.col("cells")[0]
    # a cell for every column of the header: a short line's missing cells are null, a long line's extra ones drop
    dated = data.join(width, PANEL).select(
        PANEL,
        F.to_date(F.when(~date_text.isin(*NULL_TOKENS), date_text), DATE_FORMAT).alias(DATE),
        F.posexplode(F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.get("cells", i))).alias("p", "cell"),
    ).where((F.col("p") > 0) & (F.col(DATE) >= F.lit(date_floor)))
    value = F.nanvl(F.when(~F.col("cell").isin(*NULL_TOKENS), F.col("cell")).cast("double"), F.lit(None).cast("double"))
    cells = dated.select(PANEL, (F.col("p") - 1).cast("int").alias("pos"), DATE, value.alias(VALUE))
    panel = cells.join(dim.select(PANEL, "pos", SERIES), [PANEL, "pos"]).select(PANEL, SERIES, DATE, VALUE)
    return panel, dim


def file_faults(files: DataFrame) -> DataFrame:
    """``(panel_id, path, reason)`` of whole files ``(panel_id, path, value)`` that cannot be a vintage; the first reason of each.

    A name without a vintage, a text without a code line, a date, number or code that does not parse, an unknown code,
    a date that stands twice.
    """
    named = files.select(PANEL, "path", F.length("value").alias("size"))
    lines = files.where(F.col(PANEL) != "").select(PANEL, "path", F.posexplode(F.split("value", "\r?\n")).alias("ln", "line")).select("*", F.split("line", ",").alias("cells"))
    told = lambda c: c.isNotNull() & ~c.isin(*NULL_TOKENS)
    day = F.col("cells")[0]
    rest = F.filter(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))), told)
    data, code = F.col("ln") > 1, F.col("ln") == 1
    codes = F.filter(F.transform(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))), lambda c: F.trim(c)), lambda c: ~c.isin(*SKIP_TCODE_CELLS))
    dated = F.when(told(day), F.expr(f"try_to_timestamp(cells[0], '{DATE_FORMAT}')"))
    marks = lines.select(
        PANEL,
        "path",
        code.alias("code"),
        (data & told(day) & dated.isNull()).alias("bad_date"),
        (data & dated.isNotNull() & F.exists(rest, lambda c: c.try_cast("double").isNull())).alias("bad_number"),
        (code & F.exists(codes, lambda c: F.coalesce(c.try_cast("double").cast("int"), F.lit(-1)).isin(*range(1, 8)) == F.lit(False))).alias("bad_code"),
        F.when(data, dated).alias("day"),
    )
    per = marks.groupBy(PANEL, "path").agg(*[F.bool_or(c).alias(c) for c in ("code", "bad_date", "bad_number", "bad_code")], F.count("day").alias("days"), F.count_distinct("day").alias("distinct"))
    reason = (
        F.when(F.col(PANEL) == "", "file name without a vintage")
        .when(F.col("size") == 0, "empty vintage file")
        .when(~F.coalesce("code", F.lit(False)), "no code line")
        .when(F.col("bad_date"), "malformed date")
        .when(F.col("bad_number"), "malformed number")
        .when(F.col("bad_code"), "unknown tcode")
        .when(F.col("distinct") < F.col("days"), "date stands twice")
        .when(F.col("days") == 0, "no dated line")
    )
    return named.join(per, [PANEL, "path"], "left").select(PANEL, "path", reason.alias("reason")).where("reason is not null")


def read_vintages(
    spark: SparkSession, path: str, date_floor: date = date(1959, 1, 1), ref: date | None = None, pin: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Every landed vintage, or the one that ``ref`` resolves to (the month before it; a ``pin`` wins)."""
    one = None
    if ref is not None or pin is not None:
        at = spark.range(1).select(vintage_name(F.lit(ref or date.today()), F.lit(pin) if pin is not None else None))
        one = [at.first()[0]]
    return parse_lines(read_vintage_lines(spark, path, one), date_floor)


def panel_to_lines(panel: DataFrame, series: DataFrame, date_label: str = "sasdate", code_label: str = "Transform:") -> DataFrame:
    """Write a long panel back as vintage CSV lines ``(panel_id, ln, line)``.

    Missing values rotate through the null tokens. Each data line is one group
    of N cells (one panel row); line numbers only need to be unique and > 1.
    """
    hdr = series.groupBy(PANEL).agg(F.array_sort(F.collect_list(F.struct("pos", SERIES, "tcode"))).alias("s"))
    header = hdr.select(PANEL, F.lit(0).alias("ln"), F.concat_ws(",", F.lit(date_label), F.transform("s", lambda x: x[SERIES])).alias("line"))
    codes = hdr.select(
        PANEL, F.lit(1).alias("ln"), F.concat_ws(",", F.lit(code_label), F.transform("s", lambda x: F.coalesce(x["tcode"].cast("string"), F.lit("")))).alias("line")
    )
    cells = panel.join(series.select(PANEL, SERIES, "pos"), [PANEL, SERIES])
    token = F.element_at(F.array(*[F.lit(t) for t in NULL_TOKENS]), ((F.col("pos") + F.dayofyear(DATE)) % len(NULL_TOKENS) + 1).cast("int"))
    text = F.coalesce(F.col(VALUE).cast("string"), token)
    rows = cells.groupBy(PANEL, DATE).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", text.alias("t")))), lambda x: x["t"]).alias("vals"))
    data = rows.select(
        PANEL,
        (F.months_between(DATE, F.lit("1900-01-01")).cast("int") + 2).alias("ln"),
        F.concat_ws(",", F.date_format(DATE, DATE_FORMAT), F.concat_ws(",", "vals")).alias("line"),
    )
    return header.unionByName(codes).unionByName(data)
