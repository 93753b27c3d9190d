"""One query per operator over the driver tables, each with its SQL counterpart.

Every query reads whole tables. The SQL is an independent statement of the same
result, run by the driver in another engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts import fixtures as fx
from regfacts import functions as fn
from regfacts.operators import aggregates as agg
from regfacts.operators import joins, merge, project, responses, windows
from regfacts.plans import dictionary as layouts
from regfacts.plans import enrich, normalize, silver, validate
from regfacts.session import settle, work_folder
from regfacts.sources import writers
from regfacts.sources.bucketed import publish_buckets
from regfacts.sources.keyed_table import KeyedTable
from regfacts.sources.readers import expected_files, read_points, scan_directory, scan_grid
from regfacts.streaming import stream_append, stream_append_keyed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DATE, RUN = "2025-12-31", "p3dh_20251231"


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return register


# --- SQL building blocks -----------------------------------------------------
MEASURES = " union all ".join(
    f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, {n} as n, "
    f"'{col}' as col, '{label}' as label, {c} as val from lineitem"
    for n, (col, label, c) in enumerate(
        [("10", "Quantity", "l_quantity"), ("20.0", "Price", "l_extendedprice"),
         ("0030", "Discount", "l_discount"), ("40", "Tax", "l_tax")]
    )
)
POINTS = f"""
pts0 as (
  select concat('LEI0', lpad(cast(l_suppkey as varchar), 16, '0')) as lei, s_name as bank,
    n_name as country, p_type as module, p_size,
    concat('K_', case when p_size <= 3 then cast(p_size + 100 as varchar)
                      else lpad(cast(p_size as varchar), 2, '0') end, '.00') as tpl,
    case when l_returnflag = 'R' then concat('brand = ', p_brand, ' | type = ', p_type)
         when l_linenumber = 2 then '20.0' when l_linenumber = 4 then ' 40 '
         else cast(l_linenumber * 10 as varchar) end as rowraw,
    p_brand as row_name, n, col, label, cast(round(val * 100) as bigint) as cents,
    l_orderkey as o, l_partkey as p, l_suppkey as s, l_linenumber as ln
  from ({MEASURES}) l join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join part on l_partkey = p_partkey
),
pts as (
  select *, concat(tpl, '_data_points.csv') as file,
    concat('00', case when col = '10' then '10' when col = '20.0' then '20'
                      when col = '40' then '40' else '30' end) as ccode,
    case when ln = 7 then 'not reported'
         when ln = 3 and cents >= 1000 then
           concat(cast(cents // 1000 as varchar), ',', lpad(cast(cents % 1000 as varchar), 3, '0'))
         else cast(cents as varchar) end as val,
    try_cast(case when ln = 7 or (ln = 3 and cents >= 1000) then null
                  else cents end as double) as plain
  from pts0
)"""
SILVER = (
    POINTS
    + """,
sv0 as (
  select *, trim(rowraw) as row_raw,
    case when rowraw like '% = %' then trim(rowraw) end as open_key,
    case when rowraw like '% = %' then null
         else lpad(cast(ln * 10 as varchar), 4, '0') end as row_code,
    case when ln = 7 then null else cast(cents as double) end as num
  from pts
),
sv1 as (
  select *, concat('{', tpl, ', r', row_code, ', c', ccode, '}') as cell0 from sv0
),
sv as (
  select *, case when row_code is not null then cell0 end as cell,
    sha256(concat_ws(chr(31), '2025-12-31', tpl, lei, module,
      coalesce(case when row_code is not null then cell0 end, ''), coalesce(row_code, ''),
      row_name, row_raw, coalesce(open_key, ''), ccode, label, val)) as fact_id
  from sv1
)"""
)
DICTIONARY = """
dict as (
  select distinct tpl as template_code,
    case when p_size between 40 and 99 then 'OPEN_0007' else cast(ln * 10 as varchar) end as row_code,
    col as col_code, label as col_name
  from pts where ln <> 5 and p_size <> 10
  union all
  select concat('K_6', cast(r_regionkey as varchar), '.00'), '10', '10', r_name from region
),
cells as (
  select distinct template_code, lpad(row_code, 4, '0') as row_code,
    case when col_code = '20.0' then '0020' else lpad(col_code, 4, '0') end as column_code
  from dict where row_code not like 'OPEN%'
)"""
GAPPY = """
gap as (
  select file, tpl, lei, case when ln = 1 then bank end as bank,
    case when ln = 2 then country end as country, case when ln = 3 then module end as module,
    rowraw, case when ln % 2 = 0 then row_name end as row_name, ccode,
    case when ln <= 2 then label end as label, plain, o, p, s, ln, n
  from pts
)"""
FILE_ORDER = "order by o, p, s, ln, n"


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_facts(fx.bronze_points(spark, sf), DATE, RUN)


# --- silver and star ---------------------------------------------------------
@query(f"""with {SILVER}
select tpl as template_code, count(*) as facts, count(distinct fact_id) as distinct_facts,
  min(fact_id) as first_id, max(fact_id) as last_id, sum(num) as total,
  count(open_key) as open_facts, max(cell) as last_cell, max(row_code) as last_row
from sv group by tpl""")
def silver_facts(spark, sf):
    # an id is a hash over the other keys too, so they make no more groups; ids travel as bytes
    per_id = _silver(spark, sf).groupBy(
        "template_code", "cell", "row_code", fn.packed_id("fact_id").alias("id")
    ).agg(
        F.count("*").alias("n"), F.sum("fact_value_num").alias("total"),
        F.count("open_key").alias("open"),
    )
    return per_id.groupBy("template_code").agg(
        F.sum("n").alias("facts"),
        F.count("*").alias("distinct_facts"),
        fn.plain_id(F.min("id")).alias("first_id"),
        fn.plain_id(F.max("id")).alias("last_id"),
        F.sum("total").alias("total"),
        F.sum("open").alias("open_facts"),
        F.max("cell").alias("last_cell"),
        F.max("row_code").alias("last_row"),
    )


@query(f"""with {SILVER}
select distinct fact_id, tpl as template_code, lei, row_code, ccode as column_code, open_key,
  num as fact_value_num, file as source_file from sv""")
def distinct_facts(spark, sf):
    columns = ["fact_id", "template_code", "lei", "row_code", "column_code", "open_key",
               "fact_value_num", "source_file"]
    return silver.distinct_facts(settle(_silver(spark, sf).select(*columns, "line"))).select(*columns)


@query(f"""with {POINTS}, {GAPPY},
per_file as (
  select lei, file, bank, country, row_number() over (
    partition by lei, file order by o desc, p desc, s desc, ln desc, n desc) as k from gap
),
firsts as (
  select lei, bank, country, row_number() over (partition by lei order by file) as k
  from per_file where k = 1
)
select lei, bank as entity_name, country from firsts where k = 1""")
def institutions(spark, sf):
    return agg.institutions(silver.silver_facts(fx.gappy_points(spark, sf), DATE, RUN))


@query(f"""with {SILVER},
u as (select distinct fact_id, open_key from sv where open_key is not null),
d as (
  select fact_id, unnest(string_split(open_key, ' | ')) as pair from u
)
select split_part(pair, ' = ', 1) as dimension_name, split_part(pair, ' = ', 2) as dimension_value,
  count(*) as facts, min(fact_id) as first_id
from d group by 1, 2""")
def open_dimensions(spark, sf):
    # the open key is part of the id: facts of one id all have it or all lack it
    opened = _silver(spark, sf).filter(F.col("open_key").isNotNull())
    unique = silver.distinct_facts(settle(opened.select("fact_id", "open_key", "source_file", "line")))
    return merge.explode_dimensions(unique).groupBy("dimension_name", "dimension_value").agg(
        F.count("*").alias("facts"), F.min("fact_id").alias("first_id")
    )


@query(f"""with {SILVER}, {DICTIONARY}
select count(*) as facts, count(distinct fact_id) as distinct_facts,
  count(distinct lei) as institutions,
  (select count(distinct template_code) from dict) as templates_in_manifest,
  (select count(distinct template_code) from dict where template_code not like 'K_6_.00')
    + (select count(distinct template_code) from dict where template_code in
       ('K_60.00', 'K_61.00')) as completed_templates,
  (select count(distinct template_code) from dict where template_code in
    ('K_62.00', 'K_63.00', 'K_64.00')) as skipped_templates,
  2 * count(distinct case when open_key is not null then fact_id end) as open_dimensions
from sv""")
def star_summary(spark, sf):
    # what is counted below, and no more, is written; the facts' ids once
    facts = settle(_silver(spark, sf).select(
        "fact_id", "lei", "entity_name", "country", "open_key", "source_file", "line"))
    unique = settle(silver.distinct_facts(facts).select("open_key"))
    codes = fx.cell_dictionary(spark, sf).select("template_code").distinct()
    skipped = F.col("template_code").isin("K_62.00", "K_63.00", "K_64.00")
    manifest = codes.withColumn(
        "status", F.when(skipped, F.lit("skipped")).otherwise(F.lit("complete"))
    )
    return agg.star_summary(
        facts, unique, agg.institutions(facts), manifest, merge.explode_dimensions(unique)
    )


@query(f"""with {SILVER} select lei, row_code, ccode as column_code, num as fact_value_num, fact_id
from sv where tpl = 'K_25.00'""")
def facts_for_template(spark, sf):
    facts = project.facts_for_template(_silver(spark, sf), "K_25.00")
    return facts.select("lei", "row_code", "column_code", "fact_value_num", "fact_id")


@query(f"""with {SILVER}
select country, tpl as template_code, count(*) as facts, sum(num) as total from sv
group by country, tpl""")
def attach_entity(spark, sf):
    facts = _silver(spark, sf)
    named = agg.institutions(facts).select("lei", F.col("country").alias("home"))
    return (
        joins.attach_entity(facts, named)
        .groupBy(F.col("home").alias("country"), "template_code")
        .agg(F.count("*").alias("facts"), F.sum("fact_value_num").alias("total"))
    )


def _bucketed_star(spark, sf):
    """Facts, open dimensions and institutions of the points, stored in buckets."""
    facts = settle(_silver(spark, sf))
    tag = uuid.uuid4().hex
    named = agg.institutions(facts).select("lei", F.col("country").alias("home"))
    return publish_buckets(silver.distinct_facts(facts), merge.explode_dimensions, named,
                           f"{work_folder(spark)}/buckets-{tag}", f"star_{tag}", buckets=16)


@query(f"""with {SILVER}, one as (select distinct fact_id, country, tpl, num from sv)
select country, tpl as template_code, count(*) as facts, sum(num) as total from one group by country, tpl""")
def bucketed_entities(spark, sf):
    """Facts with their institutions over the stored star, joined bucket by bucket."""
    return _bucketed_star(spark, sf).facts_with_entity().groupBy(
        F.col("home").alias("country"), "template_code"
    ).agg(F.count("*").alias("facts"), F.sum("fact_value_num").alias("total"))


@query(f"""with {SILVER}, one as (select distinct fact_id, tpl, open_key from sv),
d as (select fact_id, unnest(string_split(open_key, ' | ')) as pair from one where open_key is not null)
select tpl as template_code, split_part(pair, ' = ', 1) as dimension_name, count(*) as facts,
  count(distinct pair) as dimension_values
from one left join d using (fact_id) group by 1, 2""")
def bucketed_dimensions(spark, sf):
    """Facts with their open dimensions over the stored star; facts without any count too."""
    return _bucketed_star(spark, sf).facts_with_dimensions().groupBy("template_code", "dimension_name").agg(
        F.count("*").alias("facts"), F.count_distinct("dimension_value").alias("dimension_values"))


# --- normalize ---------------------------------------------------------------
LEI_FILLED = f"""{POINTS}, {GAPPY},
f1 as (
  select *, last_value(bank ignore nulls) over (partition by file {FILE_ORDER}) as bank1,
    last_value(country ignore nulls) over (partition by file, lei {FILE_ORDER}) as country1,
    last_value(module ignore nulls) over (partition by file, lei {FILE_ORDER}) as module1,
    last_value(row_name ignore nulls) over (partition by file, lei {FILE_ORDER}) as row_name1,
    last_value(label ignore nulls) over (partition by file, lei {FILE_ORDER}) as label1
  from gap
),
f2 as (
  select *, first_value(country1 ignore nulls) over (
      partition by file {FILE_ORDER} rows between current row and unbounded following) as country2,
    first_value(module1 ignore nulls) over (
      partition by file {FILE_ORDER} rows between current row and unbounded following) as module2
  from f1
)"""


@query(f"""with {LEI_FILLED}
select tpl as template, bank1 as entity_name,
  country2 as country, module2 as module_name, row_name1 as row_name, label1 as column_name,
  count(*) as facts, sum(plain) as total, min(cast(date '2025-12-31' as date)) as reference_date,
  max(case when true then concat('{{', tpl, ', r',
    case when rowraw like '% = %' then rowraw else lpad(cast(ln * 10 as varchar), 4, '0') end,
    ', c', ccode, '}}') end) as last_cell
from f2 where plain is not null group by 1, 2, 3, 4, 5, 6""")
def normalize_lei(spark, sf):
    rows = normalize.normalize_lei(fx.gappy_points(spark, sf))
    return rows.groupBy(
        "template", "entity_name", "country", "module_name", "row_name", "column_name"
    ).agg(
        F.count("*").alias("facts"),
        F.sum("fact_value").alias("total"),
        F.min("reference_date").alias("reference_date"),
        F.max("cell").alias("last_cell"),
    )


BACK = f"{FILE_ORDER} rows between current row and unbounded following"


@query(f"""with {POINTS},
leg as (
  select file, case when ln <= 2 then bank end as e, case when ln = 2 then country end as country,
    case when ln = 3 then module end as module,
    case when ln <= 5 then tpl end as t,
    lpad(cast(ln * 10 as varchar), 4, '0') as rcode, ccode,
    case when ln <> 2 then cast(ln * 10 as varchar) else '0020' end as rkey,
    case when ln <> 5 then col else ccode end as ckey,
    case when ln % 2 = 0 then row_name end as row_name, case when ln = 1 then label end as label,
    plain, o, p, s, ln, n
  from pts
),
a as (select *, last_value(e ignore nulls) over (partition by file {FILE_ORDER}) as e1 from leg),
b as (
  select *, last_value(country ignore nulls) over (partition by file, e1 {FILE_ORDER}) as country1,
    last_value(module ignore nulls) over (partition by file, e1 {FILE_ORDER}) as module1,
    last_value(t ignore nulls) over (partition by file, e1 {FILE_ORDER}) as t1 from a
),
c as (
  select *, first_value(country1 ignore nulls) over (partition by file {BACK}) as country2,
    first_value(module1 ignore nulls) over (partition by file {BACK}) as module2,
    first_value(t1 ignore nulls) over (partition by file {BACK}) as t2 from b
),
d as (
  select *, case when ln = 1 then '0010' else rkey end as rk from c
),
f as (
  select *,
    last_value(row_name ignore nulls) over (partition by file, e1, t2, rk {FILE_ORDER}) as rn1,
    last_value(label ignore nulls) over (partition by file, e1, t2, ckey {FILE_ORDER}) as la1
  from d
),
g as (
  select *, first_value(rn1 ignore nulls) over (partition by file {BACK}) as rn2,
    first_value(la1 ignore nulls) over (partition by file {BACK}) as la2 from f
)
select t2 as template, e1 as entity_name, country2 as country, module2 as module_name,
  rcode as "row", ccode as "column", rn2 as row_name, la2 as column_name, count(*) as facts,
  sum(plain) as total
from g where plain is not null group by 1, 2, 3, 4, 5, 6, 7, 8""")
def normalize_legacy(spark, sf):
    rows = normalize.normalize_legacy(fx.legacy_points(spark, sf))
    return rows.groupBy(
        "template", "entity_name", "country", "module_name", "row", "column", "row_name",
        "column_name",
    ).agg(F.count("*").alias("facts"), F.sum("fact_value").alias("total"))


@query(f"""with {POINTS}
select file as source_file, 'lei' as layout, count(*) as facts from pts group by file
union all
select concat('old_', file), 'legacy', count(*) from pts group by file""")
def detect_layout(spark, sf):
    old = fx.legacy_points(spark, sf).withColumns(
        {c: F.concat(F.lit("old_"), c) for c in ("source_file", "source_path")}
    )
    both = fx.bronze_points(spark, sf).unionByName(old)
    return project.detect_layout(both).groupBy("source_file", "layout").agg(
        F.count("*").alias("facts")
    )


@query("""with e as (
  select concat(c_mktsegment, '_', cast(c_nationkey as varchar)) as source_file,
    case when c_acctbal > 4500 then 1 else 0 end as fits, row_number() over (
      partition by c_mktsegment, c_nationkey order by c_custkey) as k from customer
)
select source_file, count(*) as entities, case when avg(fits) >= 0.5 then 'lei' else 'legacy' end as layout,
  case when avg(fits) filter (where k <= 10) >= 0.5 then 'lei' else 'legacy' end as layout_of_ten
from e group by source_file""")
def detect_layout_of_mixed_files(spark, sf):
    """Files in which banks stand by LEI and by name: the share over all entities, and over the first ten."""
    lei = F.concat(F.lit("LEI"), F.lpad(F.col("c_custkey").cast("string"), 17, "0"))
    rows = fx.table(spark, sf, "customer").select(
        F.concat("c_mktsegment", F.lit("_"), F.col("c_nationkey").cast("string")).alias("source_file"),
        F.col("c_custkey").alias("line"),
        F.when(F.col("c_acctbal") > 4500, lei).otherwise(F.concat(F.lit("Bank "), "c_name")).alias("Entity"))
    of_ten = project.detect_layout(rows, first=10).withColumnRenamed("layout", "layout_of_ten")
    return project.detect_layout(of_ten).groupBy("source_file").agg(
        F.count("*").alias("entities"), F.min("layout").alias("layout"), F.min("layout_of_ten").alias("layout_of_ten"))


@query("""with q as (
  select o_custkey, cast(date_trunc('quarter', o_orderdate) as date) as q,
    sum(cast(round(o_totalprice * 100) as bigint)) as cents from orders group by 1, 2
)
select c_name as entity_name, c_mktsegment as module_name, 'K_01.00' as template, '0010' as "row",
  '0020' as "column", q as reference_date, cast(cents as double) as fact_value,
  '2025-12-31' as file_reference_date
from q join customer on o_custkey = c_custkey""")
def normalize_export(spark, sf):
    return normalize.normalize_export(fx.export_grid(spark, sf)).select(
        "entity_name", "module_name", "template", "row", "column", "reference_date", "fact_value",
        "file_reference_date",
    )


@query("""select conv_id, turn, last_value(case when role = 'user' then text end ignore nulls)
  over (partition by conv_id order by turn) as last_user_text from conversations""")
def ffill(spark, sf):
    talks = fx.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("last_user_text"),
        F.floor(F.col("turn") / 1000).alias("chunk"),
    )
    filled = windows.ffill(talks, "last_user_text", ["conv_id"], order="turn")
    return filled.select("conv_id", "turn", "last_user_text")


@query(f"""with {POINTS}, {GAPPY},
a as (select *, last_value(country ignore nulls) over (partition by file, lei {FILE_ORDER}) as c1
      from gap),
b as (select *, first_value(c1 ignore nulls) over (partition by file {BACK}) as c2 from a)
select file as source_file, lei, c2 as country, count(*) as facts from b group by 1, 2, 3""")
def ffill_then_bfill(spark, sf):
    points = fx.gappy_points(spark, sf).select(
        "source_file", "line", "chunk", F.col("Entity").alias("lei"),
        F.col("Module").alias("country"),
    )
    filled = windows.ffill_then_bfill(points, ["country"], ["source_file"], ["lei"])
    return filled.groupBy("source_file", "lei", "country").agg(F.count("*").alias("facts"))


@query(f"""with {POINTS}, {GAPPY}
select * from (select file as source_file, row_number() over (partition by file {FILE_ORDER}) as k,
  lei, ccode as code from gap) where k <= 3""")
def first_n(spark, sf):
    points = fx.gappy_points(spark, sf)
    top = windows.first_n(points, 3, ["source_file"], ["line"])
    place = F.row_number().over(windows.Window.partitionBy("source_file").orderBy("line"))
    return top.select(
        "source_file", place.alias("k"), F.col("Entity").alias("lei"),
        fn.normalize_code("Column").alias("code"),
    )


@query("""select doc_id, lang, source, text from (
  select *, row_number() over (partition by text order by doc_id) as k from documents) where k = 1""")
def keep_first(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return windows.keep_first(docs, ["text"], ["doc_id"])


@query("""select doc_id, lang, source, text from (
  select *, row_number() over (partition by text order by doc_id desc) as k from documents)
  where k = 1""")
def keep_last(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return windows.keep_last(docs, ["text"], ["doc_id"])


# --- validation --------------------------------------------------------------
RECORDS = f"""{POINTS}, {DICTIONARY},
known as (select distinct template_code from dict),
opened as (select distinct template_code from dict where row_code like 'OPEN%'),
marked as (
  select tpl, case when rowraw like '% = %' then rowraw
                   else lpad(cast(ln * 10 as varchar), 4, '0') end as r, ccode as c,
    lei, country, module, rowraw, col, val from pts
),
counts as (
  select tpl, count(*) as n,
    count(*) - count(distinct concat_ws('~', lei, country, module, rowraw, col, val)) as dup,
    count(*) filter (where cells.template_code is not null) as mapped
  from marked left join cells on tpl = template_code and r = row_code and c = column_code
  group by tpl
),
rec as (
  select tpl as template_code, n as "rows", known.template_code is not null as kn,
    opened.template_code is not null as op, dup, mapped
  from counts left join known on tpl = known.template_code
  left join opened on tpl = opened.template_code
),
records as (
  select template_code, "rows", kn as template_in_dictionary,
    case when kn then "rows" else 0 end as facts_checked,
    case when not kn then 0 when op then "rows" else mapped end as facts_mapped,
    case when kn and not op then "rows" - mapped else 0 end as unmapped_facts,
    0 as malformed_facts, case when kn then dup else 0 end as duplicate_fact_keys,
    op as is_open_template,
    case when not kn then 'error' when not op and "rows" > mapped then 'error'
         when dup > 0 then 'warning' else 'ok' end as severity,
    case when not kn then 'template not in dictionary'
         else concat_ws('; ', case when dup > 0 and (op or "rows" = mapped)
                                   then 'duplicate fact rows' end,
           case when op then 'open-row template: skipped fixed row/column cell match' end)
    end as notes
  from rec
)"""


def _records(spark, sf):
    return validate.validate(fx.bronze_points(spark, sf), fx.cell_dictionary(spark, sf))


@query(f"with {RECORDS} select * from records")
def validate_records(spark, sf):
    return _records(spark, sf).withColumn("notes", F.array_join("notes", "; "))


@query(f"""with {RECORDS}
select row_number() over (order by template_code) - 1 as pos, template_code, "rows", unmapped_facts, severity, notes,
  (select count(*) from records) as files, (select sum("rows") from records) as total_rows
from records""")
def validation_document(spark, sf):
    """Summary and records written as one nested document, read back and unnested."""
    points, known = fx.bronze_points(spark, sf), fx.cell_dictionary(spark, sf)
    records, summary = validate.validation_report(points, known)
    report = writers.assemble_report(summary, records, ["template_code"])
    path = f"{work_folder(spark)}/report-{uuid.uuid4().hex}"
    writers.write_report(report, path)
    read = spark.read.schema(report.schema).json(path)
    return read.select("summary", F.posexplode("records").alias("pos", "record")).select(
        F.col("pos").cast("bigint").alias("pos"), "record.template_code", "record.rows", "record.unmapped_facts",
        "record.severity", F.array_join("record.notes", "; ").alias("notes"), "summary.files", "summary.total_rows")


@query(f"""with {RECORDS}
select count(*) as files, (select count(*) from known) as dictionary_templates,
  count(*) as downloaded_templates,
  (select string_agg(k.template_code, ',' order by k.template_code) from known k
   where k.template_code not in (select tpl from pts)) as missing_downloads,
  (select string_agg(template_code, ',' order by template_code) from records
   where not template_in_dictionary) as extra_downloads,
  count(*) filter (where severity = 'error') as errors,
  count(*) filter (where severity = 'warning') as warnings,
  cast(sum("rows") as bigint) as total_rows,
  cast(sum(unmapped_facts) as bigint) as total_unmapped_facts,
  cast(sum(malformed_facts) as bigint) as total_malformed_facts,
  cast(sum(duplicate_fact_keys) as bigint) as total_duplicate_fact_keys
from records""")
def validation_summary(spark, sf):
    known = fx.cell_dictionary(spark, sf)
    summary = agg.validation_summary(validate.validate(fx.bronze_points(spark, sf), known), known)
    lists = ("missing_downloads", "extra_downloads")
    return summary.withColumns({c: F.array_join(c, ",") for c in lists})


@query(f"""with {POINTS}, {DICTIONARY},
m as (select tpl, case when rowraw like '% = %' then rowraw
        else lpad(cast(ln * 10 as varchar), 4, '0') end as r, ccode as c from pts)
select tpl as template_code, cells.template_code is not null as mapped, count(*) as facts
from m left join cells on tpl = template_code and r = row_code and c = column_code group by 1, 2""")
def map_to_dictionary(spark, sf):
    points = fx.bronze_points(spark, sf).select(
        fn.template_from_file("source_file").alias("template_code"),
        fn.normalize_code("Row").alias("row_code"),
        fn.normalize_code("Column").alias("column_code"),
    )
    cells = joins.dictionary_cells(fx.cell_dictionary(spark, sf))
    return joins.map_to_dictionary(points, cells).groupBy("template_code", "mapped").agg(
        F.count("*").alias("facts")
    )


@query("""select lang, cast(count(*) - count(distinct text) as bigint) as duplicate_fact_keys
from documents group by lang""")
def duplicate_count(spark, sf):
    return agg.duplicate_count(fx.table(spark, sf, "documents"), ["lang"], ["text"])


@query(f"""with {POINTS}, {DICTIONARY}
select template_code, concat(template_code, ' - Table') as template_name,
  'Common disclosures' as module_name, count(*) as cells, count(distinct row_code) as "rows",
  count(distinct col_code) as "columns", count(distinct concat(template_code, row_code)) as dpm_points
from dict group by template_code""")
def template_summary(spark, sf):
    return agg.template_summary(fx.cell_dictionary(spark, sf))


@query(f"""with {POINTS}, {DICTIONARY}
select template_code, bool_or(row_code like 'OPEN%') as is_open_row from dict group by 1""")
def open_templates(spark, sf):
    return agg.open_templates(fx.cell_dictionary(spark, sf))


@query(f"""with {POINTS}, {DICTIONARY},
d as (select *, case when row_code like 'OPEN%' then row_code else lpad(row_code, 4, '0') end as r,
  case when col_code = '20.0' then '0020' else lpad(col_code, 4, '0') end as c from dict)
select template_code, r as row_code, c as col_code, concat('Row ', row_code) as row_name, col_name,
  case when col_code = '40' then 'PCT' else 'EUR' end as unit,
  concat(template_code, row_code) as dpm_point_id from d""")
def dim_cells(spark, sf):
    return agg.dim_cells(fx.cell_dictionary(spark, sf), "line").select(
        "template_code", "row_code", "col_code", "row_name", "col_name", "unit", "dpm_point_id"
    )


@query(f"""with {POINTS}, {DICTIONARY},
e as (select distinct tpl, lei from pts),
x as (select tpl as template_code, lei as entity, row_code from e
      join (select distinct template_code, row_code from cells) c on tpl = template_code),
a as (select distinct tpl, lei, lpad(cast(ln * 10 as varchar), 4, '0') as r from pts
      where rowraw not like '% = %')
select x.* from x left join a on template_code = tpl and entity = lei and row_code = r
where tpl is null""")
def coverage_gaps(spark, sf):
    points = fx.bronze_points(spark, sf).select(
        fn.template_from_file("source_file").alias("template_code"),
        F.col("Entity").alias("entity"),
        fn.normalize_code("Row").alias("row_code"),
    )
    cells = joins.dictionary_cells(fx.cell_dictionary(spark, sf))
    entities = points.select("template_code", "entity").distinct()
    return joins.coverage_gaps(entities, cells.select("template_code", "row_code"), points)


@query(f"""with {POINTS}, n as (select distinct tpl from pts where p_size <> 12
  union all select concat('K_7', cast(r_regionkey as varchar), '.09') from region),
f as (select distinct tpl from pts where p_size <> 30)
select coalesce(n.tpl, f.tpl) as code, case when n.tpl is null then f.tpl
  else concat(n.tpl, ' - Table') end as full_name,
  case when f.tpl is null then 'missing' when n.tpl is null then 'extra' else 'both' end as side
from n full outer join f on n.tpl = f.tpl""")
def compare_inventories(spark, sf):
    return joins.compare_inventories(*_inventories(spark, sf))


def _inventories(spark, sf):
    names = fx.point_rows(spark, sf).select("template").distinct()
    files = names.filter("template <> 'K_30.00'").select(
        F.concat("template", F.lit("_data_points.csv")).alias("source_file")
    )
    more = fx.table(spark, sf, "region").select(
        F.concat(F.lit("K_7"), F.col("r_regionkey").cast("string"), F.lit(".09")).alias("template")
    )
    listed = names.filter("template <> 'K_12.00'").unionByName(more)
    return listed.select(F.concat("template", F.lit(" - Table")).alias("template")), files


@query(f"""with {POINTS}, n as (select distinct tpl from pts where p_size <> 12
  union all select concat('K_7', cast(r_regionkey as varchar), '.09') from region),
f as (select distinct tpl from pts where p_size <> 30)
select (select count(*) from n) as listed, (select count(*) from f) as downloaded,
  (select string_agg(tpl, ',' order by tpl) from n where tpl not in (select tpl from f)) as missing_codes,
  (select string_agg(tpl, ',' order by tpl) from f where tpl not in (select tpl from n)) as extra_codes""")
def completeness(spark, sf):
    report = validate.completeness(*_inventories(spark, sf))
    return report.select(
        "listed", "downloaded", F.array_join("missing_codes", ",").alias("missing_codes"),
        F.array_join("extra_codes", ",").alias("extra_codes"),
    )


# --- merge -------------------------------------------------------------------
EVENTS = """
ev as (
  select concat('U', cast(user_id as varchar)) as entity_name, event_type as template,
    case when event_type <> 'signup' then '0020' end as col, cast(ts as date) as d, value, event_id,
    concat_ws('|', concat('U', cast(user_id as varchar)), event_type, '0010',
      case when event_type <> 'signup' then '0020' else '<NA>' end, '<NA>',
      cast(cast(ts as date) as varchar)) as fact_key
  from events
),
fresh as (select * from ev where d >= date '2024-01-14'),
held as (select * from ev where d < date '2024-01-17')"""


def _keyed(df: DataFrame) -> DataFrame:
    return df.select(fn.natural_key(df).alias("fact_key"), "event_id", "fact_value")


@query(f"""with {EVENTS} select fact_key, event_id,
  fact_key in (select fact_key from held) as known from fresh""")
def split_incremental(spark, sf):
    append, skipped = joins.split_incremental(*fx.event_batches(spark, sf))
    both = append.withColumn("known", F.lit(False)).unionByName(
        skipped.withColumn("known", F.lit(True))
    )
    return both.select(fn.natural_key(both).alias("fact_key"), "event_id", "known")


@query(f"""with {EVENTS} select event_id, value as fact_value from held union all
select event_id, value from fresh where fact_key not in (select fact_key from held)""")
def append_incremental(spark, sf):
    combined, _, _ = merge.append_incremental(*fx.event_batches(spark, sf))
    return combined.select("event_id", "fact_value")


@query(f"""with {EVENTS} select distinct fact_key from fresh
where fact_key in (select fact_key from held)""")
def skipped_keys(spark, sf):
    keys, _ = merge.skipped_keys(*fx.event_batches(spark, sf))
    return keys


NEW_FIRST = f"""{EVENTS},
ranked as (select *, row_number() over (partition by fact_key order by event_id) as k,
  row_number() over (partition by fact_key order by event_id desc) as kd from fresh)"""


@query(f"""with {NEW_FIRST} select fact_key, event_id, value as fact_value from held union all
select fact_key, event_id, value from ranked where k = 1
  and fact_key not in (select fact_key from held)""")
def upsert_ignore(spark, sf):
    new, held = (_keyed(x) for x in fx.event_batches(spark, sf))
    return merge.upsert_ignore(new, held, ["fact_key"], ["event_id"])[0]


@query(f"""with {NEW_FIRST},
i as (select count(*) as n from ranked where k = 1 and fact_key not in (select fact_key from held))
select n as inserted, (select count(*) from fresh) - n as skipped from i""")
def upsert_ignore_counts(spark, sf):
    new, held = (_keyed(x) for x in fx.event_batches(spark, sf))
    return merge.upsert_ignore(new, held, ["fact_key"], ["event_id"])[1]


@query(f"""with {NEW_FIRST} select fact_key, event_id, value as fact_value from held
  where fact_key not in (select fact_key from fresh) union all
select fact_key, event_id, value from ranked where kd = 1""")
def upsert_replace(spark, sf):
    new, held = (_keyed(x) for x in fx.event_batches(spark, sf))
    return merge.upsert_replace(new, held, ["fact_key"], ["event_id"])


@query("""select p_partkey, coalesce(l.n, 0) as sold, case when l.n is not null then 'sold'
  else p_brand end as mark, p_type as kind
from part left join (select l_partkey, count(*) as n from lineitem group by 1) l
on p_partkey = l_partkey""")
def upsert_columns(spark, sf):
    stored = fx.table(spark, sf, "part").select(
        "p_partkey", F.lit(0).cast("bigint").alias("sold"), F.col("p_brand").alias("mark"),
        F.col("p_type").alias("kind"),
    )
    new = fx.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count("*").alias("sold"), F.lit("sold").alias("mark")
    )
    return merge.upsert_columns(new, stored, ["p_partkey"], ["sold", "mark"])


@query(f"""with {EVENTS},
r as (select *, row_number() over (partition by fact_key order by event_id) as k from ev)
select fact_key, event_id, value as fact_value, d as reference_date from r where k = 1""")
def stream_append_events(spark, sf):
    base = f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = (
        spark.readStream.schema(fx.table(spark, sf, "events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(sf)
    )

    def prepare(batch: DataFrame) -> DataFrame:
        return fx.event_facts_of(batch)

    stream_append(source, f"{base}/out", f"{base}/state", prepare, ["event_id"]).awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "fact_key", "event_id", "fact_value", "reference_date"
    )


@query(f"""with {EVENTS},
r as (select *, row_number() over (partition by fact_key order by d >= date '2024-01-10', event_id) as k from ev)
select fact_key, event_id, value as fact_value, d as reference_date from r where k = 1""")
def stream_append_keyed_events(spark, sf):
    """Two files of events in two runs of one stream; the keys are held in the state store."""
    base = f"{work_folder(spark)}/keyed-{uuid.uuid4().hex}"
    events = fx.table(spark, sf, "events")
    later = F.to_date("ts") >= F.lit("2024-01-10").cast("date")

    def run() -> None:
        source = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
        stream_append_keyed(source, f"{base}/out", f"{base}/state", fx.event_facts_of, ["event_id"]).awaitTermination()

    # the second run starts the stream again from its checkpoint
    for n, part in enumerate((~later, later)):
        events.filter(part).write.parquet(f"{base}/in/{n}")
        run()
    return spark.read.parquet(f"{base}/out").select("fact_key", "event_id", "fact_value", "reference_date")


# --- metadata ----------------------------------------------------------------
def _enriched(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "source", "lang")
    labels = fx.table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("Category")
    )
    return enrich.exposure_enrich({"docs": docs}, labels, ["doc_id"])["docs"]


@query("""select source, count(*) as "rows", count(quality) as matched,
  avg(case when quality is null then 0 else 1 end) as match_rate
from documents left join labels using (doc_id) group by source""")
def metadata_coverage(spark, sf):
    return agg.metadata_coverage(_enriched(spark, sf), ["source"])


@query("""select case when lang = 'en' then 'en.csv' else 'other.csv' end as source_file, doc_id
from documents where doc_id not in (select doc_id from labels)""")
def exposure_unmatched(spark, sf):
    docs = _enriched(spark, sf)
    parts = {"en.csv": docs.filter("lang = 'en'"), "other.csv": docs.filter("lang <> 'en'")}
    return enrich.exposure_unmatched(parts).select("source_file", "doc_id")


@query(f"""with {POINTS} select file as source_file, 'csv' as name, count(*) as "rows",
  9 as "columns" from pts group by file""")
def summarize_sources(spark, sf):
    points = fx.bronze_points(spark, sf)
    return agg.summarize_sources(points, points.columns[:9])


@query("""select '20251231_common_disclosures.xlsx' as source_file, 'Export' as name,
  max(c_custkey) + 2 as "rows",
  12 + max((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) - 1) as "columns"
from orders, (select max(c_custkey) as c_custkey from customer)""")
def summarize_grids(spark, sf):
    return agg.summarize_grids(fx.export_grid(spark, sf))


@query("""select n_name as "Name", cast(n_regionkey as varchar) as "Region" from nation""")
def institution_list(spark, sf):
    return enrich.institution_list(fx.nation_grid(spark, sf))


@query("""with b as (
  select *, p_partkey + 10 as r, concat('K_', lpad(cast(p_size as varchar), 2, '0'), '.00') as t,
    case when p_brand = 'Brand#1' then concat('Section ', p_name) end as head from part
),
s as (select *, coalesce(last_value(head ignore nulls) over (partition by t order by r), '') as section
      from b),
d as (select * from s where head is null)
select t as template_code, concat('Table ', t, '.a') as template_name,
  'Common disclosures' as module_name, section,
  lpad(cast(p_partkey as varchar), cast(greatest(4, length(cast(p_partkey as varchar))) as integer), '0') as row_code,
  concat(p_name, ' ', p_type) as row_name, c as col_code,
  case when c = '0010' then 'Amount' else '0020' end as col_name,
  case when c = '0010' then 'EUR' else 'PCT' end as unit, cast(p_partkey as varchar) as dpm_point_id,
  concat('(q) ', p_type) as main_property,
  concat(p_brand, ' | size ', cast(p_size as varchar)) as dimensions
from d cross join (values ('0010'), ('0020')) v(c)""")
def build_dictionary(spark, sf):
    return layouts.build_dictionary(fx.layout_grid(spark, sf))


# --- bookkeeping -------------------------------------------------------------
@query(f"""with {POINTS} select distinct rowraw as code from pts where rowraw like '% = %'
  or rowraw like '% | %'""")
def distinct_open_keys(spark, sf):
    return agg.distinct_codes(fx.bronze_points(spark, sf), "open_key")


@query("""select concat('U', cast(user_id as varchar)) as template_code, count(*) as attempts,
  count(*) filter (where event_type = 'error') as failures,
  count(*) filter (where event_type = 'view') as restart_tokens,
  cast(coalesce(sum(case when event_type = 'purchase' then cast(floor(value) as bigint) end), 0)
    as bigint) as "rows",
  case when coalesce(sum(case when event_type = 'purchase' then cast(floor(value) as bigint) end), 0) = 0
         then 'failed'
       when count(*) filter (where event_type in ('error', 'view')) > 0 then 'partial'
       else 'complete' end as status,
  count(*) filter (where event_type = 'error') / count(*) > 0.25 as refresh_advised
from events group by 1""")
def run_status(spark, sf):
    kind = F.col("event_type")
    attempts = fx.table(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("template_code"),
        F.when(kind == "error", F.lit("timeout")).alias("error"),
        (kind == "view").alias("restart_token"),
        F.when(kind == "purchase", F.floor("value").cast("bigint")).otherwise(0).alias("rows"),
    )
    return agg.run_status(attempts)


@query("""select count(*) filter (where r > 0) as success, count(*) filter (where r = 0) as empty,
  count(*) filter (where r = -1) as skipped, count(*) filter (where r < -1) as failed,
  cast(sum(case when r > 0 then r else 0 end) as bigint) as total_rows
from (select case when c_acctbal < -500 then -2 when c_acctbal < 0 then -1
  when c_acctbal < 500 then 0 else c_custkey end as r from customer)""")
def outcome_counts(spark, sf):
    balance = F.col("c_acctbal")
    results = fx.table(spark, sf, "customer").select(
        F.when(balance < -500, -2).when(balance < 0, -1).when(balance < 500, 0)
        .otherwise(F.col("c_custkey")).alias("rows")
    )
    return agg.outcome_counts(results)


@query("select strftime(max(o_orderdate), '%d/%m/%Y') as latest from orders")
def latest_date(spark, sf):
    dates = fx.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date")
    )
    return agg.latest_date(dates)


@query("""with p as (select distinct strftime(cast(date_trunc('quarter', o_orderdate) as date)
  + interval 3 month - interval 1 day, '%Y%m%d') as period from orders)
select period, c as category, concat(period, '_', c, '.xlsx') as file_name, k as priority
from p cross join (values ('common_disclosures', 1), ('financial_disclosures', 2),
  ('irrbb_disclosures', 3), ('mrel_disclosures', 4), ('esg_disclosures', 5),
  ('renumeration_disclosures', 6)) v(c, k)""")
def expected_inventory(spark, sf):
    end = F.last_day(F.add_months(F.date_trunc("quarter", "o_orderdate"), 2))
    periods = fx.table(spark, sf, "orders").select(
        F.date_format(end, "yyyyMMdd").alias("period")
    ).distinct()
    return expected_files(spark, periods).drop("prefix")


@query(f"""with {POINTS}, t as (select distinct tpl, p_size from pts)
select concat(tpl, ' - Table') as template from t
where p_size not between 11 and 20 and (p_size between 21 and 30)""")
def runnable_templates(spark, sf):
    names = fx.point_rows(spark, sf).select("template").distinct()
    size = F.regexp_extract("template", r"^K_(\d+)", 1).cast("int")
    manifest = names.filter(size.between(11, 30)).select(
        F.col("template").alias("template_code"),
        F.when(size <= 20, F.lit("complete")).otherwise(F.lit("partial")).alias("status"),
    )
    full = names.select(F.concat("template", F.lit(" - Table")).alias("template"))
    todo = project.runnable_templates(manifest, full, resume=True, failed_only=True)
    return todo.select("template")


@query(f"""with {POINTS} select file as source_file, lei as "Entity", rowraw as "Row",
  col as "Column", val as "FactValue" from pts
where lei in ('LEI00000000000000001', 'LEI00000000000000002', 'LEI00000000000000007')
  and rowraw in ('10', '30') and col in ('10', '40')""")
def slice_facts(spark, sf):
    leis = [f"LEI{n:017d}" for n in (1, 2, 7)]
    cut = project.slice_facts(
        fx.bronze_points(spark, sf), entity=leis, row=["10", "30"], column=["10", "40"]
    )
    return cut.select("source_file", "Entity", "Row", "Column", "FactValue")


@query(f"""with {POINTS} select distinct concat(tpl, ' - Table') as template from pts
where concat(tpl, ' - Table') like '%3.00%'""")
def templates_matching(spark, sf):
    names = fx.point_rows(spark, sf).select(
        F.concat("template", F.lit(" - Table")).alias("template")
    ).distinct()
    return project.templates_matching(names, "3.00")


@query("select distinct lang, source, text from documents")
def distinct_rows(spark, sf):
    return joins.distinct_rows(fx.table(spark, sf, "documents").select("lang", "source", "text"))


@query("""select p_partkey as key from part where p_partkey not in (0, 3)
  and p_partkey not in (select l_partkey from lineitem where l_discount > 0.09)""")
def missing(spark, sf):
    parts = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("key"))
    reduced = fx.table(spark, sf, "lineitem").filter("l_discount > 0.09").select(
        F.col("l_partkey").alias("key")
    )
    return joins.missing(parts, reduced, [0, 3])


@query("""select distinct l_partkey as key from lineitem
where l_partkey not in (select p_partkey from part where p_size < 25)""")
def extra(spark, sf):
    small = fx.table(spark, sf, "part").filter("p_size < 25").select(
        F.col("p_partkey").alias("key")
    )
    sold = fx.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("key"))
    return joins.extra(small, sold)


@query("""select p_type, string_agg(distinct p_brand, ',' order by p_brand) as names from part
group by p_type""")
def sorted_names(spark, sf):
    names = agg.sorted_names(fx.table(spark, sf, "part"), "p_brand", ["p_type"])
    return names.withColumn("names", F.array_join("names", ","))


@query("select c_name from customer order by c_name limit 20")
def preview(spark, sf):
    return agg.preview(fx.table(spark, sf, "customer").select("c_name"), ["c_name"], 20)[0]


@query("""select user_id, count(*) as "rows", count(*) >= 60 as capped from events group by 1""")
def capped(spark, sf):
    return agg.capped(fx.table(spark, sf, "events"), ["user_id"], 60)


@query("""select distinct p_brand as code from part""")
def distinct_column_codes(spark, sf):
    return agg.distinct_codes(
        fx.table(spark, sf, "part").select(F.col("p_brand").alias("Column")), "column"
    )


@query(f"""with {POINTS}, {DICTIONARY}
select distinct row_code as code from dict where row_code not like 'OPEN%'""")
def distinct_row_codes(spark, sf):
    return agg.distinct_codes(fx.cell_dictionary(spark, sf), "row")


@query("""select '2025-12-31' as reference_date, concat('K_', cast(c_custkey as varchar)) as
  template_code, c_mktsegment as status, c_nationkey as "rows", c_acctbal < 0 as
  template_restart_token, 0 as entity_restart_token_count, '[]' as failed_entities_json
from customer""")
def manifest_rows(spark, sf):
    absent = F.lit(None).cast("string")
    records = fx.table(spark, sf, "customer").select(
        F.concat(F.lit("K_"), F.col("c_custkey").cast("string")).alias("template_code"),
        F.col("c_mktsegment").alias("status"),
        F.col("c_nationkey").cast("string").alias("rows"),
        (F.col("c_acctbal") < 0).cast("string").alias("template_restart_token"),
        F.lit("3.0").alias("entity_restart_token_count"),
        absent.alias("row_partition_restart_token_count"),
        absent.alias("failed_entities"), absent.alias("reason"), absent.alias("updated_at"),
    )
    return agg.manifest_rows(records, DATE).select(
        "reference_date", "template_code", "status", "rows", "template_restart_token",
        "entity_restart_token_count", "failed_entities_json",
    )


@query("""select p_partkey, case when p_size < 20 then 'EUR' when p_size < 40 then 'PCT'
  else 'TEXT' end as unit, case when p_size < 40 then cast(p_partkey as varchar) end as point,
  concat(p_name, ' ', p_type) as label, p_name as section, replace(p_name, ' ', '_') as safe,
  concat('K_', lpad(cast(p_size as varchar), 2, '0'), '.00') as sheet
from part""")
def label_functions(spark, sf):
    point = F.col("p_partkey").cast("string")
    cell = (
        F.when(F.col("p_size") < 20, F.concat(point, F.lit("_x000D_\n€£$")))
        .when(F.col("p_size") < 40, F.concat(point, F.lit("_x000D_\n%")))
        .otherwise(point)
    )
    code = F.concat(F.lit("K_"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit(".00"))
    return fx.table(spark, sf, "part").select(
        "p_partkey",
        fn.infer_unit(cell).alias("unit"),
        fn.dpm_id(cell).alias("point"),
        fn.clean_label(F.concat(F.lit("\xa0"), "p_name", F.lit("\n"), "p_type")).alias("label"),
        fn.clean_section(F.concat(F.lit("0005  "), "p_name", F.lit("\n"))).alias("section"),
        fn.safe_name("p_name").alias("safe"),
        fn.strip_sheet_variant(F.concat(code, F.lit(".a(0010)"))).alias("sheet"),
    )


def _star(spark, sf):
    dictionary = fx.cell_dictionary(spark, sf)
    manifest = dictionary.select(
        "template_code", F.lit("complete").alias("status"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("rows", "template_restart_token", "entity_restart_token_count",
                      "row_partition_restart_token_count", "failed_entities", "reason",
                      "updated_at")
        ],
    ).distinct()
    return silver.make_star(fx.bronze_points(spark, sf), dictionary, manifest, DATE, RUN)[0]


@query(f"""with {SILVER}
select tpl as template_code, '2025-12-31' as reference_date, count(distinct fact_id) as facts,
  count(distinct case when open_key is not null then fact_id end) as open_facts
from sv group by tpl""")
def write_star(spark, sf):
    root = f"{work_folder(spark)}/star-{uuid.uuid4().hex}"
    writers.write_star(_star(spark, sf), root)
    return writers.stored(spark, root, "fact").groupBy(
        "template_code", F.col("reference_date").cast("string").alias("reference_date")
    ).agg(F.count("*").alias("facts"), F.count("open_key").alias("open_facts"))


def _second_load(facts):
    """Facts of one template again by a later run, those of another as new facts besides."""
    again = facts.filter(F.col("template_code") == "K_25.00")
    more = facts.filter(F.col("template_code") == "K_26.00").withColumn(
        "fact_id", F.concat("fact_id", F.lit("-2")))
    return again.unionByName(more).withColumn("run_id", F.lit("later"))


TWO_LOADS = f"""with {SILVER}, one as (
  select tpl, fact_id, min(open_key) as open_key from sv group by tpl, fact_id
), loads as (
  select tpl, fact_id, open_key, case when tpl = 'K_25.00' then 'later' else '{RUN}' end as run_id from one
  union all
  select tpl, concat(fact_id, '-2'), open_key, 'later' from one where tpl = 'K_26.00'
)"""


@query(f"""{TWO_LOADS}
select tpl as template_code, run_id, count(*) as facts, 2 * count(open_key) as dimensions
from loads group by tpl, run_id""")
def write_star_twice(spark, sf):
    root = f"{work_folder(spark)}/star-{uuid.uuid4().hex}"
    star = _star(spark, sf)
    writers.write_star(star, root)
    later = settle(_second_load(star.fact))
    writers.write_star(replace(star, fact=later, fact_dimension=merge.explode_dimensions(later)), root)
    # ids travel as bytes
    id = fn.packed_id("fact_id").alias("id")
    facts = writers.stored(spark, root, "fact").select(id, "template_code", "run_id")
    bridge = writers.stored(spark, root, "fact_dimension").groupBy(id).agg(F.count("*").alias("n"))
    return facts.join(bridge, "id", "left").groupBy("template_code", "run_id").agg(
        F.count("*").alias("facts"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("dimensions"))


@query(f"""{TWO_LOADS}
select tpl as template_code, run_id, count(*) as facts, min(fact_id) as first_id, max(fact_id) as last_id
from loads group by tpl, run_id""")
def keyed_merge(spark, sf):
    stored = KeyedTable(spark, f"{work_folder(spark)}/keyed-{uuid.uuid4().hex}", "fact_id",
                        writers.FACT_PARTITIONS)
    facts = silver.distinct_facts(settle(_silver(spark, sf)))
    stored.merge(facts)
    stored.merge(_second_load(facts))
    return stored.read().groupBy("template_code", "run_id").agg(
        F.count("*").alias("facts"), F.min("fact_id").alias("first_id"), F.max("fact_id").alias("last_id"))


# --- sheets --------------------------------------------------------------------
SHEETS = """with s as (
  select p_size as size, concat('K_', lpad(cast(p_size as varchar), 2, '0'), '.00.a') as sheet,
    case when p_size % 2 = 1 then 9 else 0 end as down, max(p_partkey) + 11 as n_rows
  from part group by p_size
)"""


@query(f"""{SHEETS} select sheet, concat('Table ', sheet) as template_name, n_rows + down as n_rows,
  5 + down as codes_row, 8 + down as data_start, 8 as prop_col from s where size <> 8""")
def locate_header(spark, sf):
    return windows.locate_header(fx.deep_layout_grid(spark, sf)).select(
        "sheet", "template_name", F.col("n_rows").cast("bigint").alias("n_rows"), "codes_row",
        "data_start", "prop_col")


@query(f"{SHEETS} select sheet, n_rows + down as n_rows, 'no header row' as reason from s where size = 8")
def rejected_sheets(spark, sf):
    return windows.rejected_sheets(fx.deep_layout_grid(spark, sf)).select(
        "sheet", F.col("n_rows").cast("bigint").alias("n_rows"), "reason")


@query("""select case when p_size = 8 then 'no workbook' when p_size = 9 then 'no sheet'
    when p_size in (10, 11, 12) then 'no place' else 'kept' end as reason,
  p_brand as value, count(*) as cells, sum(case when p_size between 8 and 12 then 0 else p_partkey end) as places
from part group by 1, 2""")
def scan_grid_files(spark, sf):
    """Worksheet cells in CSV files: those with a place, and those set aside with a reason."""
    key = F.col("p_partkey").cast("string")
    path = f"{work_folder(spark)}/grid-{uuid.uuid4().hex}"
    size = F.col("p_size")
    fx.table(spark, sf, "part").select(
        F.when(size != 8, F.lit("book")).alias("workbook"), F.lit(0).alias("sheet_no"),
        F.when(size != 9, F.col("p_type")).alias("sheet"),
        F.when(size == 10, F.concat(key, F.lit("th"))).when(size != 11, key).alias("r"),
        F.when(size == 12, F.lit("-1")).otherwise(F.lit("2")).alias("c"), F.col("p_brand").alias("value"),
    ).write.option("header", True).csv(path)
    scan = scan_grid(spark, path, "csv")
    kept = scan.cells.groupBy(F.lit("kept").alias("reason"), "value").agg(
        F.count("*").alias("cells"), F.sum("r").alias("places"))
    aside = scan.rejected.groupBy("reason", "value").agg(
        F.count("*").alias("cells"), F.lit(0).cast("bigint").alias("places"))
    return kept.unionByName(aside)


# --- responses ---------------------------------------------------------------
CENTS = "cast(cast(cast(round(o_totalprice * 100) as bigint) as double) as varchar)"


@query(f"""select o_orderkey as response_id, concat('C', cast(o_custkey as varchar)) as "Entity",
  'ES' as "Country", 'IRRBB' as "Module", '{{K}}' as "Cell", '0030' as "Row", '' as "RowName",
  c as "Column", '' as "ColumnName", case when c = '0010' then {CENTS} else 'n.a.' end as "FactValue"
from orders cross join (values ('0010'), ('9')) v(c) where o_orderstatus = 'F'""")
def flatten_responses(spark, sf):
    return responses.flatten_responses(fx.responses(spark, sf)).drop("pos")


@query(f"""select o_orderkey as response_id, concat('C', cast(o_custkey as varchar)) as "Entity",
  '{{c1}}' as "Cell", 'K_02.00' as "Template", '2025-12-31' as "ReferenceDate",
  {CENTS} as "FactValue" from orders where o_orderstatus = 'O'""")
def flatten_partitioned(spark, sf):
    return responses.flatten_partitioned(fx.responses(spark, sf)).select(
        "response_id", "Entity", "Cell", "Template", "ReferenceDate", "FactValue"
    )


@query("""select o_orderkey as response_id, concat('C', cast(o_custkey as varchar)) as "Entity",
  case when k = 0 then cast(cast(round(o_totalprice * 100) as bigint) as varchar) end as "FactValue",
  case when k = 0 then 'true' end as col2
from orders cross join (values (0), (1)) v(k) where o_orderstatus = 'P'""")
def flatten_tables(spark, sf):
    rows = responses.flatten_tables(fx.responses(spark, sf))
    return rows.select(
        "response_id",
        *[F.try_element_at("fields", F.lit(c)).alias(c) for c in ("Entity", "FactValue", "col2")],
    )


@query(f"""select o_orderkey as response_id, o_orderstatus as status,
  concat('C', cast(o_custkey as varchar)) as "Entity", k as pos,
  case when o_orderstatus = 'P' and k = 0 then cast(cast(round(o_totalprice * 100) as bigint) as varchar)
       when o_orderstatus = 'P' then null when k = 0 then {CENTS} else 'n.a.' end as "FactValue"
from orders cross join (values (0), (1)) v(k) where o_orderstatus <> 'O' or k = 0""")
def flatten_any(spark, sf):
    rows = responses.flatten_any(fx.responses(spark, sf))
    status = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("response_id"), F.col("o_orderstatus").alias("status")
    )
    # both sides grow with the orders; by the planner's estimate of the nested rows one would be broadcast
    return rows.hint("merge").join(status, "response_id").select(
        "response_id", "status", "Entity", "pos", "FactValue"
    )


ACCOUNT = "cast(cast(cast(round(c_acctbal * 100) as bigint) as double) as varchar)"


@query(f"""select c_custkey as response_id, pos, concat('C', cast(c_custkey as varchar)) as "Entity", "Country", "Cell",
  "Row", case when pos = 2 then {ACCOUNT} else v end as "FactValue"
from customer cross join (values (0, 'ES', '{{first}}', '', '1.0'), (1, 'FR', '{{second}}', '', '2.0'),
  (2, 'FR', '{{second}}', 'deep', null)) f(pos, "Country", "Cell", "Row", v) where c_mktsegment <> 'BUILDING'""")
def flatten_responses_data_sets(spark, sf):
    """All data sets of a response, 40 levels deep."""
    return responses.flatten_responses(fx.deep_responses(spark, sf)).select(
        "response_id", "pos", "Entity", "Country", "Cell", "Row", "FactValue")


@query(f"""select c_custkey as response_id, pos, concat('C', cast(c_custkey as varchar)) as "Entity", "Cell", "Template",
  case when pos = 1 then {ACCOUNT} else '1.0' end as "FactValue"
from customer cross join (values (0, '{{first}}', 'K_02.00'), (1, '{{second}}', 'K_08.00')) f(pos, "Cell", "Template")
where c_mktsegment = 'BUILDING'""")
def flatten_partitioned_data_sets(spark, sf):
    return responses.flatten_partitioned(fx.deep_responses(spark, sf)).select(
        "response_id", "pos", "Entity", "Cell", "Template", "FactValue")


@query(f"""select c_custkey as response_id, pos, concat('C', cast(c_custkey as varchar)) as "Entity",
  case when pos = (case when c_mktsegment = 'BUILDING' then 1 else 2 end) then {ACCOUNT}
       when pos = 0 then '1.0' else '2.0' end as "FactValue"
from customer cross join (values (0), (1), (2)) f(pos) where c_mktsegment <> 'BUILDING' or pos < 2""")
def flatten_any_data_sets(spark, sf):
    return responses.flatten_any(fx.deep_responses(spark, sf)).select("response_id", "pos", "Entity", "FactValue")


@query("""select o_orderpriority as priority, count(*) as responses,
  count(*) filter (where o_orderstatus = 'F' and o_orderpriority = '1-URGENT') as restart_tokens
from orders group by 1""")
def restart_token_counts(spark, sf):
    return agg.restart_token_counts(fx.responses(spark, sf), ["priority"])


# --- scalar functions --------------------------------------------------------
@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  cast(l_extendedprice * 1000 as varchar) as large_text, cast(l_discount / 1000 as varchar) as small_text,
  l_extendedprice as parsed
from lineitem""")
def float_texts(spark, sf):
    text = fn.float_text(F.col("l_extendedprice"))
    return fx.spread(fx.table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.float_text(F.col("l_extendedprice") * 1000).alias("large_text"),
        fn.float_text(F.col("l_discount") / 1000).alias("small_text"),
        fn.to_number_coerce(text).alias("parsed"),
    )


@query("""select o_orderkey, strftime(o_orderdate, '%Y%m%d') as folder,
  strftime(o_orderdate, '%Y-%m-%d') as from_name, strftime(o_orderdate, '%Y-%m-%d') as from_path,
  cast(o_orderdate as date) as from_ms,
  case when o_orderstatus = 'F' then cast(o_orderdate as date) end as coerced
from orders""")
def date_functions(spark, sf):
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    folder = fn.date_to_folder(day)
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        folder.alias("folder"),
        fn.ref_date_from_name(F.concat(folder, F.lit("_x.xlsx"))).alias("from_name"),
        fn.ref_date_from_path(F.concat(F.lit("/raw/19990101/"), folder, F.lit("/K.csv"))).alias(
            "from_path"
        ),
        fn.epoch_ms_to_date(F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("from_ms"),
        fn.to_date_coerce(
            F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.lit("no date"))
        ).alias("coerced"),
    )


@query("""with t as (select p_partkey, cast(p_partkey as varchar) as k, p_size from part)
select p_partkey, lpad(k, cast(greatest(4, length(k)) as integer), '0') as silver,
  case when p_size < 25 then lpad(k, cast(greatest(4, length(k)) as integer), '0') else concat(k, '.00') end as norm,
  lpad(k, cast(greatest(4, length(k)) as integer), '0') as dictionary,
  case when p_size between 10 and 99 then concat('K_', cast(p_size as varchar), '.00') end as template,
  lpad(cast(p_size as varchar), 4, '0') as row_part
from t""")
def code_functions(spark, sf):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    cell = F.concat(F.lit("{ K_"), size, F.lit(".00, r"), F.lpad(size, 4, "0"), F.lit(", c0010}"))
    raw = F.when(F.col("p_size") < 25, F.concat(key, F.lit(".0"))).otherwise(
        F.concat(key, F.lit(".00"))
    )
    return fx.table(spark, sf, "part").select(
        "p_partkey",
        fn.normalize_code(raw).alias("silver"),
        fn.normalize_code(raw, "norm").alias("norm"),
        fn.normalize_code(raw, "dictionary").alias("dictionary"),
        fn.cell_template(cell).alias("template"),
        fn.cell_row(cell).alias("row_part"),
    )


# --- files -------------------------------------------------------------------
PRICE = "cast(cast(round(o_totalprice * 100) as bigint) as varchar)"


@query(f"""select cast(o_custkey as varchar) as "Entity", cast(o_orderkey as varchar) as "Cell",
  concat(o_orderpriority, chr(10), '"m", x') as "Module",
  concat('a', chr(10), chr(10), '"b"', chr(10), cast(o_orderkey as varchar)) as "RowName", ',' as "ColumnName",
  case when o_orderstatus = 'P' then o_orderpriority end as "Sheet", {PRICE} as "FactValue", 0 as split
from orders""")
def scan_quoted_files(spark, sf):
    """CSV files of three shapes with quoted line breaks, written from orders and scanned."""
    scan = scan_directory(spark, fx.points_folder(spark, sf), pattern="*.csv")
    return scan.points.select(
        "Entity", "Cell", "Module", "RowName", "ColumnName", "Sheet", "FactValue",
        # a chunk is the split of its file in which the record starts
        F.when(F.col("chunk") == F.col("line.block"), 0).otherwise(1).alias("split"))


@query("""select distinct 'missing columns: [''Cell'', ''Column'', ''ColumnName'', ''Country'', ''Entity'', ''FactValue'', ''Module'', ''Row'', ''RowName'']'
  as reason, 'o_orderpriority,count' as header, count(*) over () > 0 as has_orders from orders""")
def scan_rejected_files(spark, sf):
    """Files that are set aside, with their reason and header."""
    scan = scan_directory(spark, fx.points_folder(spark, sf), pattern="*.csv")
    return scan.rejected.join(scan.files, "source_path").select(
        "reason", F.array_join("columns", ",").alias("header"), F.lit(True).alias("has_orders")).distinct()


@query(f"""select cast(o_custkey as varchar) as entity, count(*) as facts, sum(cast({PRICE} as bigint)) as total
from orders where o_orderstatus = 'F' group by 1""")
def read_points_by_entity(spark, sf):
    """Files of one shape read by their splits, then aggregated."""
    rows = read_points(spark, fx.points_folder(spark, sf) + "/F")
    return rows.groupBy(F.col("Entity").alias("entity")).agg(
        F.count("*").alias("facts"), F.sum(F.col("FactValue").cast("bigint")).alias("total"))
