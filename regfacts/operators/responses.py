"""Flattening of landed query responses (nested JSON) into bronze rows.

A response is a tree of groups: each level adds group values (`G0`, `G1`, …),
child groups hang below `M[].DM*[]`, and facts are `X[].M0`. The trees of all data
sets are walked level by level inside their own row with array expressions: no
shuffle, no recursion, one document per row. A round walks LEVELS levels and is
written; responses that go deeper carry their frontier into the next round, until
none is left, so no depth is too great. Rows leave in document order.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions import (
    canonical_field, decimal_suffix, decode_index, epoch_ms_to_date, float_text, is_number,
    nonblank, to_number_coerce,
)
from regfacts.functions.responses import DATA, data_sets
from regfacts.operators.windows import first_n
from regfacts.session import settle

#: Levels of the first round, and of a later one at most: each round walks twice as
#: many as the one before. More make a longer plan, fewer make more rounds.
LEVELS, LEVELS_AT_MOST = 6, 24

TEXTS = "map<string,string>"
VARIANTS = "array<variant>"
OBJECT = "map<string,variant>"
PAIRS = "array<struct<key:string,value:string>>"
#: Of a group that was walked only its values, measures and registrations go on: its own
#: item holds all groups below it once more.
NODES = f"array<struct<path:array<int>,groups:{OBJECT},values:{VARIANTS},names:{PAIRS}>>"
SELECTS = "array<struct<Value:string,NativeReferenceName:string,Name:string>>"
GROUP_NAME = r"^G\d+$"


def _list(v: Column, path: str = "$") -> Column:
    """A list inside a variant; empty if there is none."""
    return F.coalesce(F.try_variant_get(v, path, VARIANTS), F.array().cast(VARIANTS))


def _fields(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", OBJECT), F.create_map().cast(OBJECT))


def _members(v: Column, prefix: str) -> Column:
    """Items of all lists below the keys of an object that start with `prefix`."""
    held = F.map_filter(_fields(v), lambda k, _: k.startswith(prefix))
    return F.flatten(F.transform(F.map_values(held), lambda x: _list(x)))


def _groups(v: Column) -> Column:
    return F.map_filter(_fields(v), lambda k, _: k.rlike(GROUP_NAME))


def _overlay(below: Column, above: Column) -> Column:
    """Both maps as one; `above` wins."""
    return F.map_zip_with(below, above, lambda _, b, a: F.coalesce(a, b))


def _node(path: Column, groups: Column, item: Column) -> Column:
    return F.struct(path.alias("path"), groups.alias("groups"), item.alias("item"))


def _children(node: Column) -> Column:
    """Child groups of a node, with its group values passed down."""
    per_list = F.transform(
        _list(node["item"], "$.M"),
        lambda m, i: F.transform(
            _members(m, "DM"),
            lambda d, j: _node(
                F.concat(node["path"], F.array(i, j)), _overlay(node["groups"], _groups(d)), d
            ),
        ),
    )
    return F.flatten(per_list)


def _walk(start: DataFrame, roots: Column, keep: list[str], finish: Callable[[DataFrame], DataFrame],
          made: list[str]) -> DataFrame:
    """`keep` and the columns `made` by `finish` from `nodes`: the groups of all levels, in document order.

    A round's responses that have no further level are finished and written; the
    others are written with all they hold and go on.
    """
    state = start.withColumns({"_level": roots, "nodes": F.array().cast(NODES)})
    carried = [c for c in state.columns if c not in keep]
    below = F.flatten(F.transform("_level", _children)).alias("_level")
    seen = F.concat("nodes", F.filter(
        F.transform("_level", _walked), lambda n: (F.size(n["values"]) > 0) | (F.size(n["names"]) > 0))).alias("nodes")
    others = [c for c in state.columns if c not in ("_level", "nodes")]
    finished, levels = [], LEVELS
    while True:
        for _ in range(levels):
            # both columns read the level, so Spark keeps the steps apart
            state = state.select(*others, below, seen)
        # by path, so that a group comes before its children and after earlier siblings
        ordered = state.withColumn("nodes", F.array_sort("nodes", _by_path))
        deeper = F.size("_level") > 0
        rows = finish(ordered.withColumn("_deeper", deeper))
        round_ = settle(rows.select(
            *keep, "_deeper", *[F.when(~F.col("_deeper"), F.col(c)).alias(c) for c in made],
            *[F.when(F.col("_deeper"), F.col(c)).alias(f"_state_{c}") for c in carried]))
        finished.append(round_.filter(~F.col("_deeper")).select(*keep, *made))
        rest = round_.filter("_deeper")
        if rest.isEmpty():
            return functools.reduce(DataFrame.unionByName, finished)
        levels = min(2 * levels, LEVELS_AT_MOST)
        state = rest.select(*keep, *[F.col(f"_state_{c}").alias(c) for c in carried])


def _walked(node: Column) -> Column:
    """What is kept of a group: path, group values, measures in order, registrations."""
    measured = F.filter(_list(node["item"], "$.X"), lambda x: F.map_contains_key(_fields(x), F.lit("M0")))
    return F.struct(
        node["path"].alias("path"), node["groups"].alias("groups"),
        F.transform(measured, lambda x: F.try_variant_get(x, "$.M0", "variant")).alias("values"),
        F.filter(_registrations(node["item"]), _is_group_pair).alias("names"))


def _by_path(a: Column, b: Column) -> Column:
    return F.when(a["path"] < b["path"], -1).when(a["path"] > b["path"], 1).otherwise(0)


def _facts(nodes: Column) -> Column:
    """(data set, groups, value) of every item that has a measure, in order."""
    return F.flatten(
        F.transform(
            nodes,
            lambda n: F.transform(
                n["values"],
                lambda v: F.struct(n["path"][0].alias("set"), n["groups"].alias("groups"), v.alias("value")),
            ),
        )
    )


def _value_text(v: Column) -> Column:
    """A measure as bronze text: numbers written as such, other text as it is."""
    text = F.try_variant_get(v, "$", "string")
    trimmed = decimal_suffix(text)
    number = F.when(is_number(v), F.try_variant_get(v, "$", "double")).otherwise(
        to_number_coerce(trimmed)
    )
    return F.coalesce(float_text(number), trimmed)


def _dictionaries(data_set: Column) -> Column:
    return F.try_variant_get(data_set, "$.ValueDicts", "map<string,array<string>>")


def _dictionary(data_set: Column, name: Column) -> Column:
    return F.try_element_at(F.get("dictionaries", data_set), name)


def _last_wins(pairs: Column) -> Column:
    """array<struct<key,value>> as a map; of equal keys the last one counts."""
    return F.aggregate(
        pairs,
        F.create_map().cast(TEXTS),
        lambda acc, p: F.map_concat(
            F.map_filter(acc, lambda k, _: k != p["key"]), F.create_map(p["key"], p["value"])
        ),
    )


def _bronze_row(values: dict[str, Column], fields: Column | None = None) -> Column:
    """One row of the wide bronze shape; columns the response shape lacks are null."""
    absent = F.lit(None).cast("string")
    return F.struct(
        *[values.get(c, absent).alias(c) for c in fixed.BRONZE_WIDE_COLUMNS],
        (F.lit(None).cast(TEXTS) if fields is None else fields).alias("fields"),
    )


def _sets(response: str) -> Column:
    return F.coalesce(data_sets(response), F.array().cast(VARIANTS))


def _standard(df: DataFrame, keep: list[str], finish: Callable[[DataFrame], DataFrame], made: list[str],
              carry: tuple[str, ...] = ()) -> DataFrame:
    """`keep` and what `finish` makes of `standard` (rows of the standard shape) and `carry`.

    All data sets are read, with all their parts; the top level gives the entity
    and no facts.
    """

    def tops(data_set: Column, n: Column) -> Column:
        return F.flatten(F.transform(
            _list(data_set, "$.PH"),
            lambda p, i: F.transform(
                _list(p, "$.DM0"),
                lambda d, j: _node(F.array(n, i, j), F.map_filter(_groups(d), lambda k, _: k == "G0"), d))))

    start = df.withColumn("_sets", _sets("response")).select(
        *keep, *carry, F.transform("_sets", _dictionaries).alias("dictionaries"),
        F.flatten(F.transform("_sets", tops)).alias("_tops"))

    def row(fact: Column) -> Column:
        values = {}
        for index, column in fixed.GROUP_COLUMNS.items():
            value = F.try_element_at(fact["groups"], F.lit(f"G{index}"))
            if index in fixed.GROUP_DICTIONARIES:
                text = decode_index(_dictionary(fact["set"], F.lit(fixed.GROUP_DICTIONARIES[index])), value)
            else:
                text = F.try_variant_get(value, "$", "string")
            values[column] = F.coalesce(text, F.lit(""))
        values["FactValue"] = _value_text(fact["value"])
        return _bronze_row(values)

    def rows(walked: DataFrame) -> DataFrame:
        return finish(walked.withColumn("_facts", _facts(F.col("nodes"))).withColumn("standard", F.transform("_facts", row)))

    return _walk(start, F.flatten(F.transform("_tops", _children)), keep, rows, made)


def _richer(df: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and `richer`: rows of the shape that describes its own groups.

    All data sets are read. Group names come from the descriptor; a data set has its
    own base values from its `SH` part and its own dictionary names from all its `S`
    registrations, of which the last one of a group counts. If several groups carry
    the same field, the one with the highest number counts. Rows with a blank cell
    are left out; the reference date comes as epoch milliseconds.
    """
    described = F.transform(
        F.coalesce(
            F.try_variant_get("response", f"{DATA}.descriptor.Select", SELECTS),
            F.array().cast(SELECTS),
        ),
        lambda s: F.struct(
            F.substring(s["Value"], 2, 9).try_cast("int").alias("n"),
            s["Value"].alias("group"),
            canonical_field(
                F.coalesce(
                    F.nullif(s["NativeReferenceName"], F.lit("")),
                    F.substring_index(s["Name"], ".", -1),
                )
            ).alias("field"),
        ),
    )

    def head_items(data_set: Column) -> Column:
        return F.flatten(F.transform(_list(data_set, "$.SH"), lambda s: _members(s, "DM")))

    start = df.withColumn("_sets", _sets("response")).select(
        *keep,
        F.transform("_sets", _dictionaries).alias("dictionaries"),
        # groups that carry a field, highest number first
        F.sort_array(F.filter(described, lambda g: g["group"].rlike(GROUP_NAME)), asc=False).alias("_described"),
        F.transform("_sets", lambda s: F.aggregate(
            head_items(s), F.create_map().cast(OBJECT), lambda acc, d: _overlay(acc, _groups(d)))).alias("_base"),
        F.transform("_sets", lambda s: F.concat(_list(s, "$.SH"), head_items(s), _list(s, "$.PH"))).alias("_outer"),
        F.transform("_sets", lambda s: _list(s, "$.PH")).alias("_parts"),
    )
    roots = F.flatten(F.transform("_parts", lambda parts, n: F.flatten(F.transform(
        parts, lambda p, i: F.transform(
            _members(p, "DM"), lambda d, j: _node(F.array(n, i, j), _groups(d), d))))))

    def row(fact: Column) -> Column:
        base, names = F.get("_base", fact["set"]), F.get("_names", fact["set"])

        def text_of(column: str) -> Column:
            # values of the tree go before those of the head
            groups = F.filter("_described", lambda g: g["field"] == column)["group"]
            own = F.get(F.filter(groups, lambda g: F.map_contains_key(fact["groups"], g)), 0)
            head = F.get(F.filter(groups, lambda g: F.map_contains_key(base, g)), 0)
            text = decode_index(
                _dictionary(fact["set"], F.try_element_at(names, F.coalesce(own, head))),
                F.coalesce(F.try_element_at(fact["groups"], own), F.try_element_at(base, head)),
            )
            return F.coalesce(text, F.lit(""))

        values = {c: text_of(c) for c in fixed.BRONZE_WIDE_COLUMNS if c != "FactValue"}
        values["ReferenceDate"] = F.date_format(
            epoch_ms_to_date(values["ReferenceDate"]), "yyyy-MM-dd"
        )
        values["FactValue"] = _value_text(fact["value"])
        return _bronze_row(values)

    def rows(walked: DataFrame) -> DataFrame:
        def names(outer: Column, n: Column) -> Column:
            above = F.filter(F.flatten(F.transform(outer, _registrations)), _is_group_pair)
            own = F.flatten(F.transform(F.filter("nodes", lambda x: x["path"][0] == n), lambda x: x["names"]))
            return _last_wins(F.concat(above, own))

        walked = walked.withColumns({"_names": F.transform("_outer", names), "_facts": _facts(F.col("nodes"))})
        return walked.withColumn("richer", F.filter(F.transform("_facts", row), lambda r: nonblank(r["Cell"])))

    return _walk(start, roots, keep, rows, ["richer"])


def _registrations(item: Column) -> Column:
    """Group names and their dictionaries, as an item of the response lists them."""
    named = F.try_variant_get(item, "$.S", "array<struct<N:string,DN:string>>")
    return F.coalesce(named.cast(PAIRS), F.array().cast(PAIRS))


def _is_group_pair(p: Column) -> Column:
    return p["key"].rlike(GROUP_NAME) & p["value"].isNotNull()


def _add_tables(df: DataFrame, response: str) -> DataFrame:
    """Add `tables`: rows of the table shape, read only if there are no data sets.

    A row shorter than the list of columns has only the first ones.
    """

    def table_rows(table: Column) -> Column:
        names = F.transform(
            _list(table, "$.Columns"),
            lambda c, i: F.coalesce(
                F.try_variant_get(c, "$.DisplayName", "string"),
                F.try_variant_get(c, "$.Name", "string"),
                F.concat(F.lit("col"), i.cast("string")),
            ),
        )
        rows = F.filter(
            F.transform(_list(table, "$.Rows"), lambda r: F.try_variant_get(r, "$", VARIANTS)),
            lambda r: r.isNotNull(),
        )
        return F.transform(
            rows,
            lambda cells: _last_wins(
                F.transform(
                    F.slice(names, 1, F.least(F.size(names), F.size(cells))),
                    lambda name, i: F.struct(
                        name.alias("key"),
                        F.try_variant_get(F.get(cells, i), "$", "string").alias("value"),
                    ),
                )
            ),
        )

    no_sets = F.try_variant_get(response, f"{DATA}.dsr.DS", "variant").isNull()
    shapes = F.when(no_sets, _list(F.col(response), f"{DATA}.dsr.DataShapes")).otherwise(
        F.array().cast(VARIANTS)
    )
    rows = F.flatten(
        F.transform(
            F.flatten(F.transform(shapes, lambda s: _list(s, "$.Tables"))), table_rows
        )
    )
    values = lambda f: {
        c: F.try_element_at(f, F.lit(c)) for c in fixed.BRONZE_WIDE_COLUMNS
    }
    return df.withColumn("_fields", rows).select(
        *df.columns, F.transform("_fields", lambda f: _bronze_row(values(f), f)).alias("tables")
    )


def _unnest(df: DataFrame, rows: str | Column, *columns: str) -> DataFrame:
    # outer, then filtered: a plain explode makes Spark compute the list twice,
    # once more to filter on its size
    found = df.select("response_id", F.posexplode_outer(rows).alias("pos", "row"))
    return found.filter(F.col("pos").isNotNull()).select(
        "response_id", "pos", *[F.col(f"row.{c}").alias(c) for c in columns]
    )


def flatten_responses(df: DataFrame) -> DataFrame:
    """Standard shape -> 9 bronze columns. `df`: `response_id`, variant `response`."""
    rows = _standard(df, ["response_id"], lambda walked: walked, ["standard"])
    return _unnest(rows, "standard", *fixed.BRONZE_COLUMNS)


def flatten_partitioned(df: DataFrame) -> DataFrame:
    """Richer shape -> 13 bronze columns."""
    return _unnest(_richer(df, ["response_id"]), "richer", *fixed.BRONZE_WIDE_COLUMNS)


def flatten_tables(df: DataFrame) -> DataFrame:
    """Table shape -> a map from column name to text per table row."""
    return _unnest(_add_tables(df, "response"), "tables", "fields")


def flatten_any(df: DataFrame) -> DataFrame:
    """Bronze rows of each response by the first shape that gives any.

    Tried in order: standard, tables (only without data sets), richer. The table
    shape keeps its own columns in `fields`. A response stays one row until its
    shape is known, and a later shape is only walked where the earlier ones gave
    nothing.
    """

    def first_found(walked: DataFrame) -> DataFrame:
        rows = F.when(F.size("standard") > 0, F.col("standard")).otherwise(F.col("tables"))
        return walked.withColumn("found", rows).withColumn("rest", F.when(F.size("found") == 0, F.col("response")))

    keep = ["response_id"]
    # the response itself is written only where nothing was found
    tabled = _add_tables(df.select("response_id", "response"), "response")
    walked = _standard(tabled, keep, first_found, ["found", "rest"], carry=("tables", "response"))
    found = walked.filter(F.size("found") > 0).select(*keep, "found")
    rest = _richer(walked.filter("rest is not null").select(*keep, F.col("rest").alias("response")), keep)
    best = found.unionByName(rest.withColumnRenamed("richer", "found"))
    return _unnest(best, "found", *fixed.BRONZE_WIDE_COLUMNS, "fields")


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """First n rows of each response, in document order."""
    return first_n(df, n, ["response_id"], ["pos"])
