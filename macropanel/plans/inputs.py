"""Inputs of the registered queries: panels made from the given tables, with gaps, outliers and codes laid on by rule."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macropanel.model import DATE, PANEL, SERIES, VALUE
from macropanel.session import ensure_checkpoint_dir
from macropanel.sources.panels import day_event_values, facts_to_panel, month_brand_facts, month_nation_orders, read_table


def lay_fixture_rules(cells: DataFrame, series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lay gaps, outliers and tcodes on a dense panel by rule (FIXTURES.md §2).

    ``b`` = series rank in string order within the panel, ``m`` = month index.
    Returns (panel, series dimension); pure projections, no join.
    """
    b = F.col("pos")
    m = F.col("m")
    v = F.col(VALUE)
    value = (
        F.when((b < 4) & (m < 20), F.lit(None))
        .when((m * 7 + b * 13) % 29 == 0, F.lit(None))
        .when((b == 24) & (m % 3 != 0), F.lit(None))
        .when((b == 5) & (m == 40), v * 1000)
        .when((b == 10) & (m == 30), -v)
        .when((b == 6) & (m == 50), F.lit(0.0))
        .otherwise(v)
        .cast("double")
    )
    tcode = F.when(b == 23, F.lit(None).cast("int")).otherwise((F.lit(1) + b % 7).cast("int"))
    return cells.select(PANEL, SERIES, DATE, value.alias(VALUE)), series.select(PANEL, SERIES, "pos", tcode.alias("tcode"))


def brand_fixture_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The month x brand test panel: (panel, series dimension)."""
    facts = month_brand_facts(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))
    return lay_fixture_rules(*facts_to_panel(facts))


def many_fact_panels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Three panels from three fact tables, prepared together.

    Two monthly panels (brand revenue, nation order value) and one daily panel
    (event value by type); the same gap/outlier/tcode rules are laid on each
    panel by series rank.
    """
    monthly = month_brand_facts(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")).unionByName(
        month_nation_orders(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))
    )
    m_cells, m_series = facts_to_panel(monthly)
    d_cells, d_series = facts_to_panel(day_event_values(read_table(spark, sf_dir, "events")), step="1 DAY")
    return lay_fixture_rules(m_cells.unionByName(d_cells), m_series.unionByName(d_series))


def wide_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """About 840 dates x 125 series: shipped revenue by three-day period, brand and size class (the bench's large panel)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("d"), F.col("l_extendedprice").alias("px"))
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("-", "p_brand", (F.col("p_size") % 5).cast("string")).alias(SERIES))
    period = F.date_add(F.lit("1990-01-01").cast("date"), (F.floor(F.datediff("d", F.lit("1990-01-01")) / 3) * 3).cast("int"))
    facts = li.join(part, "l_partkey").groupBy(period.alias(DATE), SERIES).agg(F.sum("px").alias(VALUE))
    return lay_fixture_rules(*facts_to_panel(facts.select(F.lit("wide").alias(PANEL), SERIES, DATE, VALUE), step="3 DAY"))


def wide_part_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Quarters x parts: shipped revenue per part, a row per part of lineitem (see ``panels.cells_of``). No codes are laid on."""
    li = read_table(spark, sf_dir, "lineitem")
    quarter = F.trunc(F.to_date("l_shipdate"), "quarter")
    key = F.col("l_partkey").cast("bigint")  # a name has 12 characters of it
    key = F.when(key.between(-99_999_999_999, 999_999_999_999), key).otherwise(F.substring(key.cast("string"), 1, 12).cast("bigint"))
    facts = li.groupBy(quarter.alias(DATE), key.alias(SERIES)).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias(VALUE))
    facts = facts.select(F.lit("part_revenue").alias(PANEL), SERIES, DATE, VALUE)
    rows, dim = facts_to_panel(facts, "3 MONTH", by_series=True, named=lambda key: F.concat(F.lit("P"), F.lpad(key.cast("string"), 12, "0")))
    return rows, dim.select(PANEL, SERIES, "pos", F.lit(None).cast("int").alias("tcode"))


def spoiled_artifacts(clean: DataFrame, transformed: DataFrame, mask: DataFrame, card: DataFrame, series: DataFrame) -> dict[str, DataFrame]:
    """The artifacts with faults laid on by rule, so that every contract rule has something to count.

    Per artifact of cells: the July rows of series 3 twice, the February dates of series 7 null, the March flags
    of series 8 null. Card: series 4 twice, negative counts, fractions off [0, 1] and nulls by series.
    """
    pos = series.select(PANEL, SERIES, F.col("pos").alias("_p"))
    month = F.month(DATE)

    def cells(df: DataFrame) -> DataFrame:
        d = df.join(pos, [PANEL, SERIES])
        twice = d.where((F.col("_p") == 3) & (month == 7))
        undated = F.when((F.col("_p") == 7) & (month == 2), F.lit(None)).otherwise(F.col(DATE)).cast("date")
        return d.withColumn(DATE, undated).unionByName(twice).drop("_p")

    flags = mask.join(pos, [PANEL, SERIES])
    flags = flags.withColumn("imputed", F.when((F.col("_p") == 8) & (month == 3), F.lit(None)).otherwise(F.col("imputed")).cast("boolean")).drop("_p")
    c = card.join(pos, [PANEL, SERIES])
    c = c.unionByName(c.where("_p = 4"))
    for k, name in enumerate(("n_obs", "n_missing_leading", "n_missing_internal")):
        c = c.withColumn(name, F.when(F.col("_p") == 9 + k, -1 - F.col(name)).when(F.col("_p") == 12 + k, F.lit(None)).otherwise(F.col(name)).cast("long"))
    for k, name in enumerate(("frac_missing", "frac_missing_leading", "frac_missing_internal")):
        c = c.withColumn(name, F.when(F.col("_p") == 15 + k, F.col(name) + 1.5).when(F.col("_p") == 18 + k, F.lit(None)).otherwise(F.col(name)).cast("double"))
    c = c.withColumn("kept", F.when(F.col("_p") == 21, F.lit(None)).otherwise(F.col("kept")).cast("boolean")).drop("_p")
    return {"raw": cells(clean), "transformed": cells(transformed), "mask": cells(flags), "data_card": c}


def with_infinities(panel: DataFrame, series: DataFrame) -> DataFrame:
    """The June values of every ninth series as infinities of either sign."""
    pos = series.select(PANEL, SERIES, F.col("pos").alias("_p"))
    infinite = F.when(F.col("_p") > 9, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    odd = F.when((F.col("_p") % 9 == 2) & (F.month(DATE) == 6), infinite).otherwise(F.col(VALUE))
    return panel.join(pos, [PANEL, SERIES]).withColumn(VALUE, odd).drop("_p")


#: Cells that a short line still has, its date among them.
SHORT_LINE = 10


def published_lines(lines: DataFrame) -> DataFrame:
    """Vintage lines ``(panel_id, ln, line)`` with the oddities of published files: November's end early, and those dated 50 years before are there too."""
    dated = F.to_date(F.when(F.col("ln") > 1, F.split("line", ",")[0]), "M/d/yyyy")
    short = F.array_join(F.slice(F.split("line", ","), 1, SHORT_LINE), ",")
    cut = lines.select(PANEL, "ln", F.when(F.month(dated) == 11, short).otherwise(F.col("line")).alias("line"), dated.alias("d"))
    early = F.concat(F.date_format(F.add_months("d", -600), "M/d/yyyy"), F.lit(","), F.regexp_replace("line", "^[^,]*,", ""))
    old = cut.where("d is not null").select(PANEL, (F.col("ln") + 100_000).alias("ln"), early.alias("line"))
    return cut.select(PANEL, "ln", "line").unionByName(old)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the checkpoint folder, for files that a query writes and reads back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stream_lines(lines: DataFrame, good: list[str], odd: dict[str, str]) -> DataFrame:
    """The lines as several vintages: ``good`` ones as they are, ``odd`` ones (vintage -> fault) with a fault laid on.

    ``number``: the first data lines hold a word for a number; ``code``: the code line is an unknown one; ``twice``: the
    dates of a year stand twice.
    """
    cells, year = F.split("line", ","), F.year(F.to_date(F.when(F.col("ln") > 1, F.split("line", ",")[0]), "M/d/yyyy"))
    word = F.concat_ws(",", cells[0], F.lit("n/a"), F.slice(cells, 3, F.greatest(F.size(cells) - 2, F.lit(0))))
    parts = [lines.withColumn(PANEL, F.explode(F.array(*map(F.lit, good))))]
    for vintage, fault in odd.items():
        one = lines.withColumn(PANEL, F.lit(vintage))
        if fault == "number":
            one = one.withColumn("line", F.when((F.col("ln") > 1) & (year == 1996), word).otherwise(F.col("line")))
        elif fault == "code":
            one = one.withColumn("line", F.when(F.col("ln") == 1, F.lit("Transform:,17")).otherwise(F.col("line")))
        elif fault == "twice":
            one = one.unionByName(one.where((F.col("ln") > 1) & (year == 1997)))
        parts.append(one)
    return reduce(DataFrame.unionByName, parts)
