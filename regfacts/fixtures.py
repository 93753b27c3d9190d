"""Views of the driver tables in the shapes of disclosure files.

The tables stand in for bronze files, dictionaries, responses and logs, so that
every operator can run over whole tables. All views are native expressions over
the full tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.session import settle, spread, spread_join, tune, work_folder

# orders per chunk of a file: a chunk holds the lines of so many orders
ORDERS_PER_CHUNK = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: The facts of an order line: (column code, column name, column of lineitem).
MEASURES = (
    ("10", "Quantity", "l_quantity"), ("20.0", "Price", "l_extendedprice"),
    ("0030", "Discount", "l_discount"), ("40", "Tax", "l_tax"),
)


def _template() -> Column:
    size = F.col("p_size")
    return F.concat(
        F.lit("K_"),
        F.when(size <= 3, (size + 100).cast("string")).otherwise(
            F.lpad(size.cast("string"), 2, "0")
        ),
        F.lit(".00"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their supplier, nation and part."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return (
        spread_join(lines, part, "l_partkey", "p_partkey")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )


def point_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four facts per order line: quantity, price, discount and tax."""
    measures = F.array(
        *[
            F.struct(
                F.lit(n).alias("n"), F.lit(col).alias("col"), F.lit(label).alias("label"),
                F.col(c).alias("val"),
            )
            for n, (col, label, c) in enumerate(MEASURES)
        ]
    )
    facts = order_lines(spark, sf_dir).select("*", F.inline(measures))
    cents = F.round(F.col("val") * 100).cast("bigint")
    number = F.col("l_linenumber")
    value = (
        F.when(number == 7, F.lit("not reported"))
        .when(
            (number == 3) & (cents >= 1000),
            F.concat(
                F.floor(cents / 1000).cast("string"), F.lit(","),
                F.lpad((cents % 1000).cast("string"), 3, "0"),
            ),
        )
        .otherwise(cents.cast("string"))
    )
    return facts.select(
        F.concat(F.lit("LEI0"), F.lpad(F.col("l_suppkey").cast("string"), 16, "0")).alias("lei"),
        F.col("s_name").alias("bank"),
        F.col("n_name").alias("country"),
        F.col("p_type").alias("module"),
        _template().alias("template"),
        F.when(
            F.col("l_returnflag") == "R",
            F.concat(F.lit("brand = "), "p_brand", F.lit(" | type = "), "p_type"),
        )
        .when(number == 2, F.lit("20.0"))
        .when(number == 4, F.lit(" 40 "))
        .otherwise((number * 10).cast("string"))
        .alias("row"),
        F.col("p_brand").alias("row_name"),
        "n",
        F.col("col").alias("column"),
        F.col("label").alias("column_name"),
        value.alias("value"),
        cents.alias("cents"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
    )


def _line() -> Column:
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "n")
    return F.struct(*[F.col(k).cast("bigint").alias(k) for k in keys])


def _lined(rows: DataFrame, *columns) -> DataFrame:
    return rows.select(
        *columns,
        F.concat("template", F.lit("_data_points.csv")).alias("source_file"),
        F.concat(F.lit("/raw/20251231/"), "template", F.lit("_data_points.csv")).alias(
            "source_path"
        ),
        _line().alias("line"),
        F.floor(F.col("l_orderkey") / ORDERS_PER_CHUNK).alias("chunk"),
    )


def bronze_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the LEI layout, every column given."""
    rows = point_rows(spark, sf_dir)
    return _lined(
        rows,
        F.col("lei").alias("Entity"),
        F.col("bank").alias("Country"),
        F.col("country").alias("Module"),
        F.col("module").alias("Cell"),
        F.col("row").alias("Row"),
        F.col("row_name").alias("RowName"),
        F.col("column").alias("Column"),
        F.col("column_name").alias("ColumnName"),
        F.col("value").alias("FactValue"),
    )


def gappy_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEI points with gaps: names only on some lines, to be filled in order."""
    rows = point_rows(spark, sf_dir)
    number = F.col("l_linenumber")
    return _lined(
        rows,
        F.col("lei").alias("Entity"),
        F.when(number == 1, F.col("bank")).alias("Country"),
        F.when(number == 2, F.col("country")).alias("Module"),
        F.when(number == 3, F.col("module")).alias("Cell"),
        F.col("row").alias("Row"),
        F.when(number % 2 == 0, F.col("row_name")).alias("RowName"),
        F.col("column").alias("Column"),
        F.when(number <= 2, F.col("column_name")).alias("ColumnName"),
        F.col("value").alias("FactValue"),
    )


def legacy_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the legacy layout, with gaps; codes partly only in the cell."""
    rows = point_rows(spark, sf_dir)
    number = F.col("l_linenumber")
    cell = F.concat(
        F.lit("{"), "template", F.lit(", r"),
        F.lpad((number * 10).cast("string"), 4, "0"), F.lit(", c"),
        F.lpad(F.substring_index("column", ".", 1), 4, "0"), F.lit("}"),
    )
    return _lined(
        rows,
        F.when(number <= 2, F.col("bank")).alias("Entity"),
        F.when(number == 2, F.col("country")).alias("Country"),
        F.when(number == 3, F.col("module")).alias("Module"),
        F.when(number <= 5, cell).alias("Cell"),
        F.when(number == 1, F.lit(" ")).when(number >= 3, (number * 10).cast("string")).alias(
            "Row"
        ),
        F.when(number % 2 == 0, F.col("row_name")).alias("RowName"),
        F.when(number != 5, F.col("column")).alias("Column"),
        F.when(number == 1, F.col("column_name")).alias("ColumnName"),
        F.col("value").alias("FactValue"),
    )


def cell_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that occur in the points, with gaps, open rows and unused templates.

    No cells for line 5 (their facts do not map) and none for size 10 (a template
    the dictionary does not know); sizes from 40 on are open-row templates. Written
    once, as it stands for a dictionary file. Every line has all measures, so lines are made
    distinct before their measures are listed.
    """
    lines = order_lines(spark, sf_dir).select(_template().alias("template"), "l_linenumber").distinct()
    rows = lines.select("*", F.inline(F.array(*[
        F.struct(F.lit(code).alias("column"), F.lit(name).alias("column_name")) for code, name, _ in MEASURES])))
    size = F.regexp_extract("template", r"^K_(\d+)", 1).cast("int")
    cells = rows.filter((F.col("l_linenumber") != 5) & (size != 10)).select(
        F.col("template").alias("template_code"),
        F.when(size.between(40, 99), F.lit("OPEN_0007"))
        .otherwise((F.col("l_linenumber") * 10).cast("string"))
        .alias("row_code"),
        F.col("column").alias("col_code"),
        F.col("column_name").alias("col_name"),
    ).distinct()
    unused = table(spark, sf_dir, "region").select(
        F.concat(F.lit("K_6"), F.col("r_regionkey").cast("string"), F.lit(".00")).alias(
            "template_code"
        ),
        F.lit("10").alias("row_code"), F.lit("10").alias("col_code"),
        F.col("r_name").alias("col_name"),
    )
    both = cells.unionByName(unused)
    dictionary = both.select(
        "template_code",
        F.concat("template_code", F.lit(" - Table")).alias("template_name"),
        F.lit("Common disclosures").alias("module_name"),
        "row_code",
        F.concat(F.lit("Row "), "row_code").alias("row_name"),
        "col_code",
        "col_name",
        F.when(F.col("col_code") == "40", F.lit("PCT")).otherwise(F.lit("EUR")).alias("unit"),
        F.concat("template_code", "row_code").alias("dpm_point_id"),
        F.lit("(m) Amount").alias("main_property"),
        F.lit("").alias("dimensions"),
        F.struct("template_code", "row_code", "col_code").alias("line"),
    )
    return settle(dictionary)


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as canonical rows; the day and the user's kind of event are the key."""
    return event_facts_of(table(spark, sf_dir, "events"))


def event_facts_of(events: DataFrame) -> DataFrame:
    absent = F.lit(None).cast("string")
    return events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("entity_name"),
        absent.alias("country"),
        absent.alias("module_name"),
        absent.alias("cell"),
        absent.alias("open_key"),
        F.col("event_type").alias("template"),
        F.lit("0010").alias("row"),
        absent.alias("row_name"),
        F.when(F.col("event_type") != "signup", F.lit("0020")).alias("column"),
        absent.alias("column_name"),
        absent.alias("sheet"),
        F.to_date("ts").alias("reference_date"),
        F.col("value").alias("fact_value"),
        "event_id",
    )


def event_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(new, stored) events; the new ones start some days before the stored end."""
    facts = event_facts(spark, sf_dir)
    return (
        facts.filter(F.col("reference_date") >= F.lit("2024-01-14").cast("date")),
        facts.filter(F.col("reference_date") < F.lit("2024-01-17").cast("date")),
    )


def _cell(c: int, value: Column) -> Column:
    return F.struct(F.lit(c).alias("c"), value.alias("value"))


def export_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide export: one row per customer, one column per quarter of orders."""
    orders = table(spark, sf_dir, "orders")
    quarter = F.date_trunc("quarter", "o_orderdate").cast("date")
    row = (F.col("custkey") + 2).cast("int")
    totals = (
        orders.groupBy(F.col("o_custkey").alias("custkey"), quarter.alias("quarter"))
        .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
        .select(
            row.alias("r"),
            (11 + (F.year("quarter") - 1995) * 4 + F.quarter("quarter") - 1).cast("int").alias("c"),
            F.col("cents").cast("string").alias("value"),
            "quarter",
        )
    )
    dates = totals.select(
        F.lit(0).alias("r"), "c",
        F.concat(F.col("quarter").cast("string"), F.lit(" 00:00:00")).alias("value"),
    ).distinct()
    names = ("Entity Name", "Country", "Module Name", "Cell", "Open Key", "Template", "Row",
             "Row Name", "Column", "Column Name", "Sheet")
    header = spark.range(1).select(
        F.lit(1).alias("r"),
        F.posexplode(F.array(*[F.lit(n) for n in names])).alias("c", "value"),
    )
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")
    ids = customers.select(
        row.alias("r"),
        F.inline(
            F.array(
                _cell(0, F.col("c_name")),
                _cell(2, F.col("c_mktsegment")),
                _cell(5, F.lit("K_01.00")),
                _cell(6, F.lit("0010")),
                _cell(8, F.lit("0020")),
            )
        ).alias("c", "value"),
    )
    grid = totals.drop("quarter").unionByName(dates).unionByName(header).unionByName(ids)
    return grid.select(
        F.lit("20251231_common_disclosures.xlsx").alias("workbook"),
        F.lit(0).alias("sheet_no"),
        F.lit("Export").alias("sheet"),
        "r", "c", "value",
    )


def nation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metadata sheet: a title row, a header row, one row per nation."""
    cells = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 2).cast("int").alias("r"),
        F.inline(
            F.array(
                _cell(0, F.col("n_name")),
                _cell(1, F.col("n_regionkey").cast("string")),
            )
        ).alias("c", "value"),
    )
    head = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), F.lit(v).alias("value"))
                    for r, c, v in ((0, 0, "Title"), (1, 0, "Name"), (1, 1, "Region"))
                ]
            )
        ).alias("r", "c", "value")
    )
    return head.unionByName(cells).select(
        F.lit("TR_Metadata.xlsx").alias("workbook"), F.lit(0).alias("sheet_no"),
        F.lit("List of Institutions").alias("sheet"), "r", "c", "value",
    )


def layout_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout workbooks: a sheet per part size, a row per part, two coded columns.

    Parts of brand 1 are section headers: a label, no code and no data.
    """
    part = spread(table(spark, sf_dir, "part"))
    sheet = F.concat(F.lit("K_"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit(".00.a"))
    point = F.col("p_partkey").cast("string")
    is_head = F.col("p_brand") == "Brand#1"

    body = part.select(
        sheet.alias("sheet"),
        (F.col("p_partkey") + 10).cast("int").alias("r"),
        F.inline(
            F.when(
                is_head, F.array(_cell(1, F.concat(F.lit("0005 Section "), "p_name")))
            ).otherwise(
                F.array(
                    _cell(1, F.concat(F.col("p_name"), F.lit("\n"), F.col("p_type"))),
                    _cell(2, F.concat(point, F.lit(".0"))),
                    _cell(3, F.concat(point, F.lit("_x000D_\n€£$"))),
                    _cell(4, F.concat(point, F.lit("_x000D_\n%"))),
                    _cell(8, F.concat(F.lit("(q) "), F.col("p_type"))),
                    _cell(9, F.col("p_brand")),
                    _cell(10, F.concat(F.lit("size "), F.col("p_size").cast("string"))),
                )
            )
        ).alias("c", "value"),
    )
    head = part.select(sheet.alias("sheet")).distinct().select(
        "sheet",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), v.alias("value"))
                    for r, c, v in (
                        (0, 0, F.concat(F.lit("Table "), "sheet")),
                        (4, 3, F.lit("Amount")), (4, 4, F.lit("(q) Share")),
                        (5, 3, F.lit("0010")), (5, 4, F.lit("0020")),
                        (6, 8, F.lit("(q)")), (7, 1, F.lit("Rows")),
                    )
                ]
            )
        ).alias("r", "c", "value"),
    )
    return head.unionByName(body).select(
        F.lit("x_CODISPILLAR3_y.xlsx").alias("workbook"), F.lit(0).alias("sheet_no"), "sheet",
        "r", "c", "value",
    )


def deep_layout_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """layout_grid with other tops: sheets of odd sizes have theirs nine rows further down, size 8 has no codes."""
    size = F.substring("sheet", 3, 2).cast("int")
    grid = layout_grid(spark, sf_dir).filter((size != 8) | (F.col("r") != 5) | (F.col("c") < 3))
    down = (size % 2 == 1) & (F.col("r") >= 4)
    return grid.withColumn("r", F.when(down, F.col("r") + 9).otherwise(F.col("r")))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed response per order: shape by status (F standard, O richer, P tables)."""
    orders = spread(table(spark, sf_dir, "orders"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    entity, status = F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    head = '{"results":[{"result":{"data":{'
    standard = F.concat(
        F.lit(head + '"dsr":{"DS":[{"ValueDicts":{"D0":["GR","ES"],"D1":["IRRBB"],"D7":'
              '["0010","0020"]},"RT":'),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit('[["x"]]')).otherwise(F.lit("[]")),
        F.lit(',"PH":[{"DM0":[{"G0":"C'), entity,
        F.lit('","M":[{"DM1":[{"G1":1,"G2":0,"M":[{"DM2":[{"G3":"{K}","G5":"0030","M":[{"DM3":['
              '{"G7":0,"X":[{"M0":"'), cents,
        F.lit('D"}]},{"G7":9,"X":[{"M0":"n.a."}]}]}]}]}]}]}]}]}]}]}}}}]}'),
    )
    richer = F.concat(
        F.lit(head + '"descriptor":{"Select":[{"Value":"G0","Name":"d.ENT_NAM"},{"Value":"G1",'
              '"NativeReferenceName":"CellCode"},{"Value":"G2","Name":"d.Template"},{"Value":"G3",'
              '"Name":"d.ReferenceDate"}]},"dsr":{"DS":[{"ValueDicts":{"D0":["C'), entity,
        F.lit('"],"D1":["K_01.00","K_02.00"]},"SH":[{"DM0":[{"S":[{"N":"G2","DN":"D1"}],"G2":1}]}'
              '],"PH":[{"DM1":[{"S":[{"N":"G0","DN":"D0"}],"G0":0,"G3":1767139200000,"M":[{"DM2":['
              '{"G1":"{c1}","X":[{"M0":"'), cents,
        F.lit('D"}]},{"G1":" ","X":[{"M0":"1"}]}]}]}]}]}]}}}}]}'),
    )
    tables = F.concat(
        F.lit(head + '"dsr":{"DataShapes":[{"Tables":[{"Columns":[{"DisplayName":"Entity"},'
              '{"Name":"FactValue"},{}],"Rows":[["C'), entity, F.lit('","'), cents,
        F.lit('",true],["C'), entity, F.lit('"]]}]}]}}}}]}'),
    )
    text = F.when(status == "F", standard).when(status == "O", richer).otherwise(tables)
    return orders.select(
        F.col("o_orderkey").alias("response_id"),
        F.col("o_orderpriority").alias("priority"),
        F.try_parse_json(text).alias("response"),
    )


def points_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of CSV files from `orders`, written for one query: three shapes by status and a fourth to reject.

    Row names and cells hold quoted line breaks, quotes and commas.
    """
    orders = spread(table(spark, sf_dir, "orders"))
    text = lambda c: F.col(c).cast("string")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    values = {
        "Entity": text("o_custkey"), "Country": F.lit("GR"), "Module": F.concat(text("o_orderpriority"), F.lit('\n"m", x')),
        "Cell": text("o_orderkey"), "Row": F.lit("10"), "RowName": F.concat(F.lit('a\n\n"b"\n'), text("o_orderkey")),
        "Column": F.lit("20"), "ColumnName": F.lit(","), "FactValue": cents, "Sheet": text("o_orderpriority")}
    standard = list(fixed.BRONZE_COLUMNS)
    shapes = {"F": standard, "O": [*reversed(standard)], "P": ["Sheet", *standard]}
    root = f"{work_folder(spark)}/points-{uuid.uuid4().hex}"
    for status, names in shapes.items():
        rows = orders.filter(F.col("o_orderstatus") == status).select(*[values[c].alias(c) for c in names])
        rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(f"{root}/{status}")
    orders.groupBy("o_orderpriority").count().coalesce(1).write.option("header", True).csv(f"{root}/other")
    return root


#: Bytes of customers a task, as each of them becomes a deep response.
SPREAD_RESPONSES = 64 << 10

#: Nested groups of the second data set of `deep_responses`.
DEEP_LEVELS = 40


def deep_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response per customer with two data sets, of which the second is nested 40 levels deep.

    Buildings come in the richer shape, all others in the standard one. The data
    sets have dictionaries of their own, so one index means two things.
    """
    # a response is thousands of times the row it comes from
    customers = spread(table(spark, sf_dir, "customer"), SPREAD_RESPONSES)
    entity = F.col("c_custkey").cast("string")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    down = F.repeat(F.lit('{"M":[{"DM2":['), DEEP_LEVELS - 1)
    up = F.repeat(F.lit("]}]}"), DEEP_LEVELS - 1)
    leaf = lambda more: F.concat(F.lit("{" + more + '"X":[{"M0":"'), cents, F.lit('D"}]}'))
    head = '{"results":[{"result":{"data":{'
    standard = F.concat(
        F.lit(head + '"dsr":{"DS":[{"ValueDicts":{"D0":["GR","ES"]},"PH":[{"DM0":[{"G0":"C'), entity,
        F.lit('","M":[{"DM1":[{"G1":1,"G3":"{first}","X":[{"M0":"1"}]}]}]}]}]},'
              '{"ValueDicts":{"D0":["IT","FR"]},"PH":[{"DM0":[{"G0":"C'), entity,
        F.lit('","M":[{"DM1":[{"G1":1,"G3":"{second}","X":[{"M0":"2"}],"M":[{"DM2":['), down, leaf('"G5":"deep",'), up,
        F.lit("]}]}]}]}]}]}]}}}}]}"),
    )
    richer = F.concat(
        F.lit(head + '"descriptor":{"Select":[{"Value":"G0","Name":"d.ENT_NAM"},{"Value":"G1",'
              '"NativeReferenceName":"CellCode"},{"Value":"G2","Name":"d.Template"}]},"dsr":{"DS":['
              '{"ValueDicts":{"D0":["K_01.00","K_02.00"]},"SH":[{"DM0":[{"S":[{"N":"G2","DN":"D0"}],"G2":1}]}],'
              '"PH":[{"DM1":[{"G0":"C'), entity,
        F.lit('","G1":"{first}","X":[{"M0":"1"}]}]}]},'
              '{"ValueDicts":{"D7":["K_07.00","K_08.00"]},"SH":[{"DM0":[{"G2":1}]}],"PH":[{"DM1":[{"G0":"C'), entity,
        F.lit('","G1":"{second}","M":[{"DM2":['), down,
        # the registration at the bottom holds for the whole data set
        leaf('"S":[{"N":"G2","DN":"D7"}],'), up, F.lit("]}]}]}]}]}}}}]}"),
    )
    return customers.select(
        F.col("c_custkey").alias("response_id"),
        F.try_parse_json(F.when(F.col("c_mktsegment") == "BUILDING", richer).otherwise(standard)).alias("response"),
    )
