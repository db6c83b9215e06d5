"""The registered queries over the test tables, and the same in DuckDB's SQL.

Every float is rounded to six decimals on both sides, counts are BIGINT, and every "first" has a total order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortloom.functions.codesets import in_codes
from cohortloom.operators import features, shape, stats, transforms
from cohortloom.operators.neighbours import nearest
from cohortloom.plans import audit, autoencoder, mixture, pipeline, privacy, stages, synthesis, tree
from cohortloom.scores.maggic import maggic
from cohortloom.scores.stumps import INPUTS, RANGES, stump_score
from cohortloom.sources import tables
from cohortloom.streaming.convert import convert_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- sources and sinks: a table is written by the library and read again -----------------------------

ORDERS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
ORDERS_SQL = "select o_orderkey, o_custkey, round(o_totalprice, 6) as o_totalprice, o_orderpriority from orders"


def _orders_file(spark: SparkSession, sf_dir: str, ending: str) -> str:
    """The orders as a folder of CSV files."""
    path = f"{tables.scratch(spark, 'orders')}{ending}"
    rows = load(spark, sf_dir, "orders").select(*ORDERS)
    if ending == ".csv.gz":
        rows.write.option("header", True).option("compression", "gzip").csv(path)
    else:
        tables.write_csv(rows, path)
    return path


@query(ORDERS_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = tables.read(spark, _orders_file(spark, sf_dir, ".csv"))
    return rounded(read.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_totalprice", "o_orderpriority"))


@query(ORDERS_SQL)
def gzip_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tables.read(spark, _orders_file(spark, sf_dir, ".csv.gz"), "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"))


@query("select cast(o_orderkey as varchar) as o_orderkey, o_custkey, round(o_totalprice, 6) as o_totalprice, o_orderpriority from orders")
def converted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large CSV is converted once; the loader finds the Parquet by the conversion map."""
    source, folder = _orders_file(spark, sf_dir, ".csv"), tables.scratch(spark, "converted")
    tables.convert_large(spark, {"orders": source}, folder, 0)
    read = tables.read(spark, tables.converted(spark, source, folder))
    return rounded(read.select(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("long"), "o_totalprice", "o_orderpriority"))


@query(ORDERS_SQL)
def streamed_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are new are converted, once each."""
    source, target, state = _orders_file(spark, sf_dir, ".csv"), tables.scratch(spark, "streamed"), tables.scratch(spark, "state")
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"
    for _ in range(2):  # the second run finds nothing new
        convert_new_files(spark, source, target, schema, state)
    return rounded(spark.read.schema(schema).parquet(target))


# --- frames that several queries share -------------------------------------------------------------

CODES = {"purchase": "purchase", "view": "view", "click": "click", "error": "error"}
REFS_SQL = "refs as (select user_id, min(ts) as ref from events where event_type = 'signup' group by 1)"


def _refs(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("ref"))


@query(f"""
    with {REFS_SQL},
    e as (select e.user_id, e.event_type, e.value, e.ts, r.ref from events e left join refs r using (user_id)),
    w as (select user_id,
        arg_min(value, ts) filter (event_type = 'purchase' and (ref is null or ts >= ref)) as purchase_first_after,
        arg_min(value, ts) filter (event_type = 'view' and (ref is null or ts < ref)) as view_any_before,
        count(*) filter (event_type = 'purchase') as n_purchase
      from e group by 1)
    select c.c_custkey, c.c_mktsegment, round(w.purchase_first_after, 6) as purchase_first_after,
      round(w.view_any_before, 6) as view_any_before, cast(coalesce(w.n_purchase, 0) as bigint) as n_purchase
    from customer c left join w on c.c_custkey = w.user_id""")
def flagship_patient_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: as-of values around the first signup, straight from the long table, merged by key."""
    events = load(spark, sf_dir, "events")
    made = shape.as_of_fused(events, _refs(events), "user_id", "event_type", "value", "ts", "ref", {"purchase": "purchase_first_after"}, {"view": "view_any_before"}, {"purchase": "n_purchase"})
    frame = shape.merge([load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), made.withColumnRenamed("user_id", "c_custkey")], "c_custkey")
    return rounded(frame.withColumn("n_purchase", F.coalesce("n_purchase", F.lit(0)).cast("long")))


ASOF_SQL = f"""
    with {REFS_SQL},
    e as (select e.*, r.ref from events e left join refs r using (user_id))
    select user_id,
      round(arg_min(value, ts) filter (event_type = 'purchase' and (ref is null or ts >= ref)), 6) as purchase_first_after,
      round(arg_min(value, ts) filter (event_type = 'view' and (ref is null or ts < ref)), 6) as view_any_before
    from e where event_type in ('purchase', 'view') group by 1"""


@query(ASOF_SQL)
def first_after_any_before_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    wide = shape.expand(events, "user_id", "event_type", "value", {"purchase": "purchase", "view": "view"}, ["ts"]).join(_refs(events), "user_id", "left")
    wide = shape.as_of(shape.as_of(wide, ["purchase"], "ref", "after", "ts"), ["view"], "ref", "anybefore", "ts")
    return rounded(wide.select("user_id", "purchase_first_after", "view_any_before"))


@query(ASOF_SQL)
def first_after_any_before_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return rounded(shape.as_of_fused(events, _refs(events), "user_id", "event_type", "value", "ts", "ref", {"purchase": "purchase_first_after"}, {"view": "view_any_before"}))


@query(f"""
    with {REFS_SQL}, e as (select e.*, r.ref from events e left join refs r using (user_id) where event_type in ('purchase', 'view'))
    select user_id, max(case when event_type = 'purchase' and props is not null and (ref is null or ts >= ref) then 1.0 end) as purchase_first_after,
      max(case when event_type = 'view' and props is not null and (ref is null or ts < ref) then 1.0 end) as view_any_before
    from e group by 1""")
def text_measurements_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measurement that is text counts as 1.0, being there."""
    events = load(spark, sf_dir, "events")
    wide = shape.expand(events, "user_id", "event_type", "props", {"purchase": "purchase", "view": "view"}, ["ts"]).join(_refs(events), "user_id", "left")
    wide = shape.as_of(shape.as_of(wide, ["purchase"], "ref", "after", "ts"), ["view"], "ref", "anybefore", "ts")
    return wide.select("user_id", "purchase_first_after", "view_any_before")


@query(ASOF_SQL)
def stored_list_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from lists that were stored as text."""
    events = load(spark, sf_dir, "events")
    wide = shape.expand(events, "user_id", "event_type", "value", {"purchase": "purchase", "view": "view"}, ["ts"])
    entry = lambda e: F.concat(F.lit("("), F.coalesce(e["value"].cast("string"), F.lit("nan")), F.lit(", '"), e["ts"].cast("string"), F.lit("')"))
    wide = wide.withColumns({c: F.concat(F.lit("["), F.array_join(F.transform(c, entry), ", "), F.lit("]")) for c in ("purchase", "view")}).join(_refs(events), "user_id", "left")
    wide = shape.as_of(shape.as_of(wide, ["purchase"], "ref", "after", "ts"), ["view"], "ref", "anybefore", "ts")
    return rounded(wide.select("user_id", "purchase_first_after", "view_any_before"))


@query("""
    with e as (select * from events where event_type in ('purchase', 'view', 'click', 'error'))
    select user_id,
      cast(count(*) filter (event_type = 'purchase') as bigint) as n_purchase,
      round(arg_min(value, ts) filter (event_type = 'purchase'), 6) as first_purchase,
      round(arg_max(value, ts) filter (event_type = 'view'), 6) as last_view
    from e group by 1""")
def expand_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = shape.expand(load(spark, sf_dir, "events"), "user_id", "event_type", "value", CODES, ["ts"])
    n = F.coalesce(F.size("purchase"), F.lit(0))
    return rounded(wide.select("user_id", F.greatest(n, F.lit(0)).cast("long").alias("n_purchase"), F.get("purchase", F.lit(0))["value"].alias("first_purchase"), F.try_element_at("view", F.lit(-1))["value"].alias("last_view")))


@query("select c_custkey, c_acctbal, c_mktsegment from customer")
def return_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.subset(load(spark, sf_dir, "customer"), "c_custkey", ["c_acctbal", "c_mktsegment"])


@query("select o_orderkey, o_totalprice from orders")
def available_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortloom.sources.tables import existing

    orders = load(spark, sf_dir, "orders")
    return orders.select(*existing(orders, ["o_orderkey", "o_absent", "o_totalprice"]))


@query("select event_id, user_id, event_type from events where event_type in ('purchase', 'view')")
def isin_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return events.where(shape.literals_like(events, "event_type", ["purchase", "view"])).select("event_id", "user_id", "event_type")


@query("select l_orderkey, l_partkey, l_linenumber from lineitem where l_linenumber in (1, 3)")
def isin_filter_integer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text codes against an integer column still reach the scan as integers."""
    lines = load(spark, sf_dir, "lineitem")
    return lines.where(shape.literals_like(lines, "l_linenumber", ["1", "3"])).select("l_orderkey", "l_partkey", "l_linenumber")


@query("select p_partkey, p_retailprice from part where p_retailprice < 1200")
def plausibility_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.plausible(load(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "retailprice", 1200)


def _orders_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P"))).select("o_orderkey", "status")


@query("select o_orderkey, nullif(o_orderstatus, 'P') as status from orders where o_orderstatus <> 'P'")
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.apply(_orders_with_nulls(spark, sf_dir), "dropna", subset=["status"])


@query("select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'missing') as status from orders")
def fillna_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.apply(_orders_with_nulls(spark, sf_dir), "fillna", values={"status": "missing"})


@query("select l_returnflag as flag, cast(count(*) as bigint) as n from (select case when l_returnflag = 'A' then null else l_returnflag end as l_returnflag from lineitem) group by 1")
def mask_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = load(spark, sf_dir, "lineitem").select(F.when(F.col("l_returnflag") == "A", "__").otherwise(F.col("l_returnflag")).alias("flag"))
    return transforms.mask_tokens(coded).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


KEEPFIRST_SQL = "select o_custkey, o_orderkey, {date} as o_orderdate, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey, o_totalprice) = 1"


@query(KEEPFIRST_SQL.format(date="o_orderdate"))
def keepfirst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.apply(load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), "keepfirst", sort_col="o_orderdate", drop_col="o_custkey")


@query(KEEPFIRST_SQL.format(date="o_orderdate"))
def datetime_keepfirst(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_totalprice")
    return transforms.apply(orders, "datetime_keepfirst", col_to_date="o_orderdate", sort_col="o_orderdate", drop_col="o_custkey")


@query("""select o_orderkey, case when o_orderkey % 5 = 0 then null else cast(cast(o_orderdate as date) as timestamp) end as day from orders""")
def datetime_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 5 == 0, "no date").when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return transforms.apply(load(spark, sf_dir, "orders").select("o_orderkey", text.alias("day")), "datetime", col_to_date="day", formats=["yyyy-MM-dd", "dd/MM/yyyy"])


@query("""select cast(floor(epoch_us(l_shipdate - o_orderdate) / 86400000000.0) as bigint) as days, cast(count(*) as bigint) as n
    from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def diff_interval_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy(transforms.whole_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("days")).agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderkey, cast(year(o_orderdate) - (1980 + o_custkey % 20) as bigint) as years from orders")
def diff_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumn("born", 1980 + F.col("o_custkey") % 20)
    return transforms.apply(orders, "diff", start="born", end="o_orderdate", out_col="years", level="year").select("o_orderkey", "years")


@query("select o_orderkey, coalesce(case o_orderstatus when 'F' then 0 when 'O' then 1 end, -1) as code from orders")
def map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transforms.apply(load(spark, sf_dir, "orders").withColumn("code", F.col("o_orderstatus")), "map", map={"F": 0, "O": 1}, out_col="code")
    return made.select("o_orderkey", F.coalesce("code", F.lit(-1)).alias("code"))


@query("select l_linestatus = 'O' as open, cast(count(*) as bigint) as n from lineitem group by 1")
def binary_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = features.encode(load(spark, sf_dir, "lineitem").select("l_linestatus"), {"l_linestatus": ["F", "O"]})
    return coded.groupBy((F.col("l_linestatus") == 1).alias("open")).agg(F.count(F.lit(1)).alias("n"))


@query("select smoking, cast(count(*) as bigint) as n from (select coalesce(case o_orderstatus when 'F' then 0 when 'O' then 1 when 'P' then 0 end, -1) as smoking from orders) group by 1")
def smoker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = load(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", "Nee").when(F.col("o_orderstatus") == "O", "Ja").alias("smoking"))
    return transforms.apply(coded, "smokerprocess", smoking="smoking").groupBy(F.coalesce("smoking", F.lit(-1)).alias("smoking")).agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderkey, coalesce(cast(nullif(o_totalprice > 100000, o_orderstatus = 'P') as int), 0) as large from orders")
def bool_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = load(spark, sf_dir, "orders").withColumn("large", F.nullif(F.col("o_totalprice") > 100000, F.col("o_orderstatus") == "P"))
    return transforms.apply(flagged, "bool_to_int", columns=["large"], fill_na=True).select("o_orderkey", "large")


@query("""select event_id, coalesce(try_cast(case when event_id % 7 = 0 then 'junk' else json_extract_string(props, '$.k') end as double), -1) as k from events""")
def to_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 7 == 0, "junk").otherwise(F.get_json_object("props", "$.k"))
    made = transforms.apply(load(spark, sf_dir, "events").select("event_id", text.alias("k")), "to_numeric", columns=["k"])
    return made.select("event_id", F.coalesce("k", F.lit(-1.0)).alias("k"))


@query("select source, cast(max(cast(contains(lower(coalesce(text, '0')), 'license') as int)) as int) as license from documents where source is not null group by 1")
def diagnose_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.apply(load(spark, sf_dir, "documents"), "diagnoseprocess_simple", disease="license", search_col="text", id_col="source")


PATTERNS = {"licensed": "licen[cs]e", "tion": "tion\\b"}


@query("""select source, max(cast(regexp_matches(coalesce(text, ''), 'licen[cs]e', 'i') as int)) as licensed,
      max(cast(regexp_matches(coalesce(text, ''), 'tion\\b', 'i') as int)) as tion, arg_min(lang, doc_id) as lang, min(doc_id) as doc_id
    from documents where source is not null group by 1""")
def pattern_match_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("source", "text", "doc_id", "lang")
    return transforms.apply(docs, "pattern_match", search_col="text", pattern_dict=PATTERNS, id_col="source", order_col="doc_id")


@query("""select doc_id, cast(regexp_matches(coalesce(text, ''), 'licen[cs]e', 'i') as int) as licensed from documents""")
def pattern_match_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return transforms.apply(docs, "pattern_match", search_col="text", pattern_dict={"licensed": PATTERNS["licensed"]}, id_col="doc_id", group_by_id=False).select("doc_id", "licensed")


@query("select p_brand, max(cast(p_size in (1, 5, 9) as int)) as flag from part where p_brand is not null group by 1")
def code_flag_group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape of the ace and beta transforms."""
    return transforms.apply(load(spark, sf_dir, "part"), "code_flag", input_col="p_size", codes=["1", "5", "9"], out_col="flag", id_col="p_brand")


@query("""with d as (select o_custkey, case o_orderkey % 4 when 0 then 'C09AA05' when 1 then 'C09CA01' when 2 then 'C07AB02' else 'X' end as atc from orders)
    select o_custkey, max(cast(atc = 'C09AA05' as int)) as ace from d group by 1""")
def ace_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.apply(_medications(spark, sf_dir), "ace", meds="atc", out_col="ace", id_col="o_custkey")


@query("""with d as (select o_custkey, case o_orderkey % 4 when 0 then 'C09AA05' when 1 then 'C09CA01' when 2 then 'C07AB02' else 'X' end as atc from orders)
    select o_custkey, max(cast(atc = 'C07AB02' as int)) as beta from d group by 1""")
def beta_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.apply(_medications(spark, sf_dir), "beta", meds="atc", out_col="beta", id_col="o_custkey")


def _medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    return load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(k == 0, "C09AA05").when(k == 1, "C09CA01").when(k == 2, "C07AB02").otherwise("X").alias("atc"))


@query("""select drug, cast(count(*) as bigint) as n from (select case o_orderkey % 4 when 0 then 'ace' when 1 then 'arb' when 2 then 'beta' else 'Other' end as drug from orders) group by 1""")
def classify_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transforms.apply(_medications(spark, sf_dir), "classify", classification_map=["ace", "arb", "beta", "beta_all"], input_col="atc", out_col="drug")
    return made.groupBy("drug").agg(F.count(F.lit(1)).alias("n"))


@query("""select drug, cast(count(*) as bigint) as n from (select case when o_orderkey % 4 in (0, 1) then 'ras' when o_orderkey % 4 = 2 then 'beta_all' else 'Other' end as drug from orders) group by 1""")
def classify_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transforms.apply(_medications(spark, sf_dir), "classify", classification_map=["ras", "beta_all", "beta"], input_col="atc", out_col="drug", match="prefix")
    return made.groupBy("drug").agg(F.count(F.lit(1)).alias("n"))


@query("""with a as (select user_id, max(cast(event_type = 'purchase' as int)) as bought from events where event_type <> 'view' group by 1),
    b as (select user_id, max(cast(event_type = 'error' as int)) as failed from events group by 1)
    select user_id, coalesce(bought, -1) as bought, coalesce(failed, -1) as failed from a full join b using (user_id)""")
def chain_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [{"input_col": "event_type", "codes": [c], "out_col": o, "id_col": "user_id"} for c, o in (("purchase", "bought"), ("error", "failed"))]
    made = transforms.apply(load(spark, sf_dir, "events"), "chain", funcs=["code_flag", "code_flag"], kwargs=flags, merge_id="user_id")
    return made.select("user_id", F.coalesce("bought", F.lit(-1)).alias("bought"), F.coalesce("failed", F.lit(-1)).alias("failed"))


@query("""with o as (select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1),
    e as (select user_id, count(*) as n_events from events group by 1)
    select c_custkey, coalesce(o_orderkey, -1) as first_order, cast(coalesce(n_events, 0) as bigint) as n_events
    from customer left join o on c_custkey = o_custkey left join e on c_custkey = user_id""")
def left_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = transforms.keepfirst(load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), "o_orderdate", "o_custkey")
    counts = load(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    merged = shape.merge([load(spark, sf_dir, "customer").select("c_custkey"), first.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), counts.withColumnRenamed("user_id", "c_custkey")], "c_custkey")
    return merged.select("c_custkey", F.coalesce("o_orderkey", F.lit(-1)).alias("first_order"), F.coalesce("n_events", F.lit(0)).alias("n_events"))


@query("""select 'status' as "column", cast(count(*) filter (o_orderstatus = 'P') as bigint) as n_null, round(100.0 * count(*) filter (o_orderstatus = 'P') / count(*), 6) as pct_null from orders
    union all select 'o_orderkey', 0, 0.0 from (select 1)""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.null_profile(_orders_with_nulls(spark, sf_dir)))


def _describe_sql(table: str, columns: list[str]) -> str:
    return " union all ".join(f"""select '{c}' as "column", cast(count({c}) as bigint) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, round(cast(min({c}) as double), 6) as min,
      round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75, round(cast(max({c}) as double), 6) as max from {table}""" for c in columns)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(_describe_sql("lineitem", LINE_NUMBERS))
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.describe(load(spark, sf_dir, "lineitem"), LINE_NUMBERS))


@query("select user_id as value, cast(count(*) as bigint) as n from events group by 1 order by n desc, value limit 10")
def value_counts_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.value_counts(load(spark, sf_dir, "events"), "user_id")


def _corr_sql(where: str = "true") -> str:
    return " union all ".join(f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as r from lineitem where {where}" for i, a in enumerate(LINE_NUMBERS) for b in LINE_NUMBERS[i + 1 :])


@query(f"select a, b, round(r, 6) as r from ({_corr_sql()})")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.correlations(load(spark, sf_dir, "lineitem"), LINE_NUMBERS))


@query(f"""select a, b, round(y.r - x.r, 6) as difference from ({_corr_sql("l_returnflag = 'R'")}) x join ({_corr_sql("l_returnflag = 'A'")}) y using (a, b)""")
def corr_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    real, synthetic = _flags(spark, sf_dir)
    return rounded(audit.correlation_difference(real, synthetic, LINE_NUMBERS))


def _flags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = load(spark, sf_dir, "lineitem")
    return lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'")


@query("select c_custkey, round((c_acctbal - avg(c_acctbal) over ()) / stddev_samp(c_acctbal) over (), 6) as c_acctbal from customer")
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(features.scale(customers, features.fit(customers, ["c_acctbal"])))


@query("select c_custkey, round(coalesce(b, (select quantile_cont(b, 0.5) from (select nullif(c_acctbal, case when c_custkey % 10 = 0 then c_acctbal end) as b from customer))), 6) as balance from (select c_custkey, case when c_custkey % 10 <> 0 then c_acctbal end as b from customer)")
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("balance"))
    return rounded(features.impute_median(customers, ["balance"]))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]


@query("select c_custkey, " + ", ".join(f"cast(c_mktsegment = '{s}' as int) as c_mktsegment_{s}" for s in SEGMENTS) + " from customer")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.encode(load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), {"c_mktsegment": SEGMENTS})


@query("""with a as (select c_custkey, case when c_custkey % 10 <> 0 then c_acctbal end as b, c_mktsegment as m from customer),
    s as (select c_custkey, (b - avg(b) over ()) / stddev_samp(b) over () as b, case m when 'BUILDING' then 0.0 when 'MACHINERY' then 1.0 end as m from a)
    select c_custkey, round(coalesce(b, (select quantile_cont(b, 0.5) from s)), 6) as balance, round(coalesce(m, (select quantile_cont(m, 0.5) from s)), 6) as segment from s""")
def impute_scale_categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = load(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("balance"), F.col("c_mktsegment").alias("segment"))
    return rounded(features.impute_scale_categorize(frame, "c_custkey", {"segment": ["BUILDING", "MACHINERY"]}))


def _histogram_sql(bins: int) -> str:
    return f"""with s as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem)
    select cast(least({bins - 1}, floor((l_extendedprice - lo) / ((hi - lo) / {bins}))) as bigint) as bin, cast(count(*) as bigint) as n from lineitem, s group by 1"""


@query(_histogram_sql(30))
def histogram_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(load(spark, sf_dir, "lineitem"), "l_extendedprice", 30)


@query(_histogram_sql(50))
def histogram_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(load(spark, sf_dir, "lineitem"), "l_extendedprice", 50)


@query("select c_custkey, (c_custkey * 7919 + 42) % 100 < 20 as is_test from customer")
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.split(load(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")


@query("select c_custkey from customer order by ((c_custkey % 2147483647) * 48271 + 42) % 2147483647, c_custkey limit 100")
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.sample_n(load(spark, sf_dir, "customer").select("c_custkey"), 100, key="c_custkey")


CDF_SQL = """with b as (select l_extendedprice as x, 1 as u, 0 as v from lineitem where l_returnflag = 'R' union all select l_extendedprice, 0, 1 from lineitem where l_returnflag = 'A'),
    c as (select x, sum(u) as u, sum(v) as v from b group by 1),
    k as (select x, sum(u) over (order by x) / sum(u) over () as f, sum(v) over (order by x) / sum(v) over () as g, lead(x) over (order by x) as nx from c)"""


@query(CDF_SQL + " select round(max(abs(f - g)), 6) as ks from k")
def ks_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.ks_statistic(*_flags(spark, sf_dir), "l_extendedprice"))


@query(CDF_SQL + """, s as (select (select max(abs(f - g)) from k) * sqrt(n * m / (n + m)) as t from (select cast(sum(u) as double) as n, cast(sum(v) as double) as m from b))
    select round(case when t < 0.2 then 1.0 else greatest(0.0, least(1.0, (select 2 * sum((case when j % 2 = 1 then 1 else -1 end) * exp(-2.0 * j * j * t * t)) from range(1, 101) r(j)))) end, 6) as p_value from s""")
def ks_p_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _flags(spark, sf_dir)
    made = stats.ks_statistic(a, b, "l_extendedprice")
    return rounded(made.select(stats.ks_p_value(F.col("ks"), F.lit(float(a.count())), F.lit(float(b.count()))).alias("p_value")))


@query(CDF_SQL + " select round(sum(abs(f - g) * (nx - x)), 4) as w1 from k")
def wasserstein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.wasserstein(*_flags(spark, sf_dir), "l_extendedprice").select(F.round("w1", 4).alias("w1"))


def _halves(spark: SparkSession, sf_dir: str, table: str, key: str) -> tuple[DataFrame, DataFrame]:
    rows = load(spark, sf_dir, table)
    return rows.where(F.col(key) % 2 == 0), rows.where(F.col(key) % 2 == 1)


def _tv_sql(c: str) -> str:
    return f"""(select 1 - sum(abs(coalesce(u, 0) / (select count(*) from orders where o_orderkey % 2 = 0) - coalesce(v, 0) / (select count(*) from orders where o_orderkey % 2 = 1))) / 2
      from (select {c} as k, count(*) as u from orders where o_orderkey % 2 = 0 group by 1) full join (select {c} as k, count(*) as v from orders where o_orderkey % 2 = 1 group by 1) using (k))"""


@query(f"select round({_tv_sql('o_orderpriority')}, 6) as tv_complement")
def tv_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.tv_complement(*_halves(spark, sf_dir, "orders", "o_orderkey"), "o_orderpriority"))


def _ks_sql(c: str) -> str:
    return f"""(select 1 - max(abs(f - g)) from (select sum(u) over (order by x) / sum(u) over () as f, sum(v) over (order by x) / sum(v) over () as g
      from (select {c} as x, sum((o_orderkey % 2 = 0)::int) as u, sum((o_orderkey % 2 = 1)::int) as v from orders group by 1)))"""


def _contingency_sql(number: str, category: str) -> str:
    at = f"case when x < lo then -1 when x > hi then 10 else least(9, floor((x - lo) / ((hi - lo) / 10))) end"
    return f"""(select 1 - sum(abs(u / nu - v / nv)) / 2 from (select u, v, sum(u) over () as nu, sum(v) over () as nv from
      (select {at} as a, y, count(*) filter (even) as u, count(*) filter (not even) as v from (select cast({number} as double) as x, {category} as y, o_orderkey % 2 = 0 as even from orders),
        (select cast(min({number}) as double) as lo, cast(max({number}) as double) as hi from orders where o_orderkey % 2 = 0) group by 1, 2)))"""


@query(f"select round({_contingency_sql('o_totalprice', 'o_orderpriority')}, 6) as score")
def contingency_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    real, synthetic = _halves(spark, sf_dir, "orders", "o_orderkey")
    return rounded(audit.pair_trends(real, synthetic, ["o_totalprice", "o_orderpriority"]).select("score"))


@query(f"""with s as (select ({_ks_sql('o_totalprice')} + {_ks_sql('o_custkey')} + {_tv_sql('o_orderpriority')}) / 3 as shape,
      (1 - abs((select corr(o_totalprice, o_custkey) from orders where o_orderkey % 2 = 0) - (select corr(o_totalprice, o_custkey) from orders where o_orderkey % 2 = 1)) / 2
        + {_contingency_sql('o_totalprice', 'o_orderpriority')} + {_contingency_sql('o_custkey', 'o_orderpriority')}) / 3 as trend)
    select 'shape' as property, round(shape, 6) as score from s union all select 'trend', round(trend, 6) from s union all select 'overall', round((shape + trend) / 2, 6) from s""")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    real, synthetic = _halves(spark, sf_dir, "orders", "o_orderkey")
    return rounded(audit.quality(real, synthetic, ["o_totalprice", "o_custkey", "o_orderpriority"]))


@query("""select cast(count(*) as bigint) as n, cast(count(*) filter (not hit) as bigint) as n_new, round(count(*) filter (not hit) / count(*), 6) as share
    from (select exists (select 1 from part r where r.p_partkey % 2 = 0 and r.p_brand = s.p_brand and r.p_size = s.p_size and r.p_type = s.p_type) as hit from part s where s.p_partkey % 2 = 1)""")
def new_row_synthesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.new_row_share(*_halves(spark, sf_dir, "part", "p_partkey"), ["p_brand", "p_size", "p_type"]))


@query("""select cast(count(*) as bigint) as n, cast(count(*) filter (not hit) as bigint) as n_new, round(count(*) filter (not hit) / count(*), 6) as share
    from (select exists (select 1 from part r where r.p_partkey % 2 = 0 and r.p_brand = s.p_brand and abs(r.p_size - s.p_size) <= 0.01 * abs(s.p_size) and abs(r.p_retailprice - s.p_retailprice) <= 0.01 * abs(s.p_retailprice)) as hit from part s where s.p_partkey % 2 = 1)""")
def new_row_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose numbers differ by a hundredth at most are equal."""
    return rounded(privacy.new_row_share(*_halves(spark, sf_dir, "part", "p_partkey"), ["p_brand", "p_size", "p_retailprice"], 0.01))


NN_COLUMNS = ["c_acctbal", "c_nationkey"]
NN_SQL = """r as (select c_custkey as real_id, (c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over () as a, (c_nationkey - avg(c_nationkey) over ()) / stddev_pop(c_nationkey) over () as b from customer where c_custkey % 2 = 0),
    p as (select avg(c_acctbal) as ma, stddev_pop(c_acctbal) as sa, avg(c_nationkey) as mb, stddev_pop(c_nationkey) as sb from customer where c_custkey % 2 = 0),
    s as (select c_custkey as synthetic_id, (c_acctbal - ma) / sa as a, (c_nationkey - mb) / sb as b from customer, p where c_custkey % 2 = 1),
    d as (select synthetic_id, min(sqrt((r.a - s.a) ** 2 + (r.b - s.b) ** 2)) as distance from s, r group by 1)"""


def _customer_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tuple(h.select("c_custkey", *NN_COLUMNS) for h in _halves(spark, sf_dir, "customer", "c_custkey"))


@query(f"with {NN_SQL} select synthetic_id, round(distance, 6) as distance from d")
def nn_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.closest_records(*_customer_halves(spark, sf_dir), "c_custkey", NN_COLUMNS).select("synthetic_id", "distance"))


@query(f"with {NN_SQL} select round(avg(distance), 6) as mean, round(quantile_cont(distance, 0.5), 6) as median, round(min(distance), 6) as min, round(max(distance), 6) as max, round(stddev_pop(distance), 6) as std from d")
def disco_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    real, synthetic = _customer_halves(spark, sf_dir)
    return rounded(privacy.distance_stats(privacy.closest_records(real, synthetic, "c_custkey", NN_COLUMNS), synthetic.count()))


@query(f"with {NN_SQL}, t as (select quantile_cont(distance, 0.1) as threshold from d) select round(threshold, 6) as threshold, cast(count(*) filter (distance < threshold) as bigint) as n_below, round(count(*) filter (distance < threshold) / count(*), 6) as rate from d, t group by threshold")
def membership_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.membership_inference(privacy.closest_records(*_customer_halves(spark, sf_dir), "c_custkey", NN_COLUMNS)))


@query("""with p as (select avg(c_acctbal) as m, stddev_pop(c_acctbal) as sd from customer where c_custkey % 2 = 0),
    r as (select c_custkey as rid, (c_acctbal - m) / sd as a, c_nationkey as t from customer, p where c_custkey % 2 = 0),
    s as (select c_custkey as sid, (c_acctbal - m) / sd as a, c_nationkey as g from customer, p where c_custkey % 2 = 1),
    n as (select rid, t, arg_min(g, (abs(r.a - s.a), sid)) as g from r, s group by 1, 2)
    select 'c_nationkey' as "column", round(avg(abs(t - g)), 6) as mae, round(avg(abs(t - g)) / (max(t) - min(t)), 6) as relative_mae, round(greatest(0, 1 - avg(abs(t - g)) / (max(t) - min(t))), 6) as risk, cast(count(*) as bigint) as n_used from n""")
def attribute_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.attribute_disclosure(*_customer_halves(spark, sf_dir), "c_custkey", ["c_acctbal"], ["c_nationkey"]))


@query("""with s as (select o_orderpriority as k, o_orderstatus as v, count(*) as c from orders where o_orderkey % 2 = 1 group by 1, 2),
    t as (select k, sum(c) as total from s group by 1),
    r as (select o_orderpriority as k, o_orderstatus as v from orders where o_orderkey % 2 = 0)
    select cast(count(*) as bigint) as n, cast(count(total) as bigint) as n_covered, round(1 - sum(coalesce(c, 0) / total) / count(total), 6) as protection from r left join t using (k) left join s using (k, v)""")
def categorical_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.categorical_cap(*_halves(spark, sf_dir, "orders", "o_orderkey"), ["o_orderpriority"], "o_orderstatus"))


@query("""with f as (select regr_slope(o_totalprice, o_custkey) as slope, regr_intercept(o_totalprice, o_custkey) as intercept from orders where o_orderkey % 2 = 1)
    select round(slope, 4) as slope, round(intercept, 4) as intercept, round(avg(abs(o_totalprice - (slope * o_custkey + intercept))) / (max(o_totalprice) - min(o_totalprice)), 6) as relative_error from orders, f where o_orderkey % 2 = 0 group by f.slope, f.intercept""")
def numerical_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = privacy.numerical_lr(*_halves(spark, sf_dir, "orders", "o_orderkey"), "o_custkey", "o_totalprice")
    return made.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), r6("relative_error").alias("relative_error"))


@query(f"""with {NN_SQL},
    x as (select real_id, synthetic_id from r, s where real_id % 20 = 0 qualify row_number() over (partition by real_id order by abs(r.a - s.a), synthetic_id) <= 10),
    y as (select real_id, synthetic_id from r, s where real_id % 20 = 0 qualify row_number() over (partition by real_id order by abs(r.b - s.b), synthetic_id) <= 10),
    h as (select distinct real_id from x join y using (real_id, synthetic_id)),
    m as (select 1 - product((n - 10 - i) / (n - i)) as baseline from (select count(*) as n from s), range(10) t(i)),
    o as (select count(*) as n, count(h.real_id) as k from (select real_id from r where real_id % 20 = 0) left join h using (real_id))
    select cast(n as bigint) as n_attacks, cast(k as bigint) as n_linked, round(k / n, 6) as rate, round(baseline, 6) as baseline, round(k / n - baseline, 6) as risk from o, m""")
def linkability_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.linkability(*_customer_halves(spark, sf_dir), "c_custkey", ["c_acctbal"], ["c_nationkey"], F.col("c_custkey") % 20 == 0))


SINGLE_COLUMNS = ["c_acctbal", "c_nationkey", "c_mktsegment"]


@query(" union all ".join(f"""select '{c}' as "column", cast(count(*) filter (v = 1) as bigint) as n_attacks, cast(count(*) filter (u = 1 and v = 1) as bigint) as n_singled,
      round(count(*) filter (u = 1 and v = 1) / nullif(count(*) filter (v = 1), 0), 6) as rate, round(count(*) filter (u = 1) / count(*), 6) as baseline,
      round(count(*) filter (u = 1 and v = 1) / nullif(count(*) filter (v = 1), 0) - count(*) filter (u = 1) / count(*), 6) as risk
    from (select count(*) filter (c_custkey % 2 = 0) as u, count(*) filter (c_custkey % 2 = 1) as v from customer where {c} is not null group by {c})""" for c in SINGLE_COLUMNS))
def singling_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.singling_out(*_halves(spark, sf_dir, "customer", "c_custkey"), SINGLE_COLUMNS))


@query(f"""with {NN_SQL}, g as (select real_id, synthetic_id from r, s where real_id % 20 = 0 qualify row_number() over (partition by real_id order by abs(r.b - s.b), synthetic_id) = 1),
    c as (select c_custkey as id, c_acctbal as x from customer), m as (select quantile_cont(c_acctbal, 0.5) as blind from customer where c_custkey % 2 = 1),
    o as (select count(*) as n, count(*) filter (abs(t.x - y.x) <= 0.25 * abs(t.x)) as k, avg((abs(blind - t.x) <= 0.25 * abs(t.x))::int) as baseline from g join c t on t.id = real_id join c y on y.id = synthetic_id, m)
    select cast(n as bigint) as n_attacks, cast(k as bigint) as n_right, round(k / n, 6) as rate, round(baseline, 6) as baseline, round(k / n - baseline, 6) as risk from o""")
def inference_attack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(privacy.inference(*_customer_halves(spark, sf_dir), "c_custkey", ["c_nationkey"], "c_acctbal", F.col("c_custkey") % 20 == 0, 0.25))


def _bounds_sql(k: str, n: str, low: str, high: str) -> str:
    p, z = f"({k} / {n})", privacy.Z95
    middle, width = f"({p} + {z * z / 2} / {n})", f"{z} * sqrt({p} * (1 - {p}) / {n} + {z * z / 4} / {n} / {n})"
    return f"round(greatest(0, ({middle} - {width}) / (1 + {z * z} / {n})), 6) as {low}, round(least(1, ({middle} + {width}) / (1 + {z * z} / {n})), 6) as {high}"


@query(f"""with c as (select c_custkey as id, c_custkey % 3 as side, c_acctbal as a, c_nationkey as b from customer),
    q as (select id, side, a, b from c where side != 1 and id % 20 = 0), s as (select id as sid, a as sa, b as sb from c where side = 1),
    x as (select id, side, sid from q, s qualify row_number() over (partition by id order by abs(a - sa), sid) <= 10),
    y as (select id, sid from q, s qualify row_number() over (partition by id order by abs(b - sb), sid) <= 10),
    h as (select distinct x.id, side from x join y using (id, sid)),
    o as (select (select count(*) from q where side = 0) as n, (select count(*) from h where side = 0) as k, (select count(*) from q where side = 2) as m, (select count(*) from h where side = 2) as j)
    select cast(n as bigint) as n_attacks, cast(k as bigint) as n_linked, round(k / n, 6) as rate, {_bounds_sql("k", "n", "rate_low", "rate_high")}, cast(m as bigint) as n_control, round(j / m, 6) as control_rate,
      {_bounds_sql("j", "m", "control_low", "control_high")}, round(greatest(0, (k / n - j / m) / nullif(1 - j / m, 0)), 6) as excess from o""")
def linkability_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linkability of real rows against that of rows the synthetic table was not made from, with the bounds of both rates."""
    thirds = [load(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 == k).select("c_custkey", *NN_COLUMNS) for k in range(3)]
    attack = lambda rows: privacy.linkability(rows, thirds[1], "c_custkey", ["c_acctbal"], ["c_nationkey"], F.col("c_custkey") % 20 == 0)
    return rounded(privacy.with_control(attack(thirds[0]), attack(thirds[2]), "n_linked").drop("baseline", "risk"))


@query(f"""with v as (select c_custkey % 3 as side, c_acctbal as x, count(*) as n from customer where c_acctbal is not null group by 1, 2),
    w as (select x, coalesce(max(n) filter (side = 0), 0) as u, coalesce(max(n) filter (side = 1), 0) as v, coalesce(max(n) filter (side = 2), 0) as c from v group by 1),
    o as (select count(*) filter (v = 1) as n, count(*) filter (v = 1 and u = 1) as k, count(*) filter (v = 1 and c = 1) as j from w)
    select 'c_acctbal' as "column", cast(n as bigint) as n_attacks, cast(k as bigint) as n_singled, round(k / n, 6) as rate, {_bounds_sql("k", "n", "rate_low", "rate_high")},
      cast(n as bigint) as n_control, round(j / n, 6) as control_rate, {_bounds_sql("j", "n", "control_low", "control_high")}, round(greatest(0, (k / n - j / n) / nullif(1 - j / n, 0)), 6) as excess from o""")
def singling_out_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    thirds = [load(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 == k) for k in range(3)]
    attack = lambda rows: privacy.singling_out(rows, thirds[1], ["c_acctbal"])
    return rounded(privacy.with_control(attack(thirds[0]), attack(thirds[2]), "n_singled").drop("baseline", "risk"))


#: In each nation the suppliers with even and odd keys; the share of orders that stay below a distance is followed step by step.
EXACT_SQL = """with recursive s as (select s_nationkey as k, s_acctbal as x, s_suppkey % 2 as side from supplier where s_acctbal is not null),
    z as (select k, count(*) filter (side = 0) as n, count(*) filter (side = 1) as m from s group by 1 having n > 0 and m > 0),
    d as (select k, max(abs(f - g)) as ks from (select s.k, s.x, (select count(*) from s t where t.k = s.k and t.side = 0 and t.x <= s.x) / z.n as f, (select count(*) from s t where t.k = s.k and t.side = 1 and t.x <= s.x) / z.m as g from s join z on s.k = z.k) group by 1),
    p as (select z.k, n, m, round(ks * n * m) - 0.5 as reach, 0 as t, [1.0::double] || list_transform(range(0, n), lambda i: 0.0::double) as inside from z join d using (k)
      union all select k, n, m, reach, t + 1, list_transform(range(0, n + 1), lambda i: case when t + 1 - i < 0 or t + 1 - i > m or abs(i * m - (t + 1 - i) * n) > reach then 0.0
        else (i * (case when i > 0 then inside[i] else 0 end) + (t + 1 - i) * inside[i + 1]) / (t + 1) end) from p where t < n + m)
    select d.k as s_nationkey, round(ks, 6) as ks, round(1 - inside[n + 1], 6) as p_value from p join d using (k) where t = n + m"""


@query(EXACT_SQL)
def ks_p_value_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact p-value of the distance of two small samples, for every nation."""
    rows = load(spark, sf_dir, "supplier").where("s_acctbal is not null").select("s_nationkey", F.col("s_acctbal").alias("x"), (F.col("s_suppkey") % 2).alias("side"))
    every, upto = Window.partitionBy("s_nationkey"), Window.partitionBy("s_nationkey").orderBy("x")
    count = lambda side, w: F.count(F.when(F.col("side") == side, 1)).over(w)
    steps = rows.select("s_nationkey", count(0, every).alias("n"), count(1, every).alias("m"), count(0, upto).alias("i"), count(1, upto).alias("j")).where("n > 0 and m > 0")
    found = steps.groupBy("s_nationkey", "n", "m").agg(F.max(F.abs(F.col("i") / F.col("n") - F.col("j") / F.col("m"))).alias("ks"))
    return rounded(stats.ks_p_values(found).select("s_nationkey", "ks", "p_value"))


@query("""with c as (select c_custkey % 2 = 0 as even, c_acctbal as x from customer)
    select 'c_acctbal' as "column", cast(count(*) filter (not even) - count(*) filter (even) as bigint) as n, round(avg(x) filter (not even) - avg(x) filter (even), 6) as mean, round(stddev_samp(x) filter (not even) - stddev_samp(x) filter (even), 6) as std,
      round(min(x) filter (not even) - min(x) filter (even), 6) as min, round(quantile_cont(x, 0.25) filter (not even) - quantile_cont(x, 0.25) filter (even), 6) as q25, round(quantile_cont(x, 0.5) filter (not even) - quantile_cont(x, 0.5) filter (even), 6) as q50,
      round(quantile_cont(x, 0.75) filter (not even) - quantile_cont(x, 0.75) filter (even), 6) as q75, round(max(x) filter (not even) - max(x) filter (even), 6) as max from c""")
def describe_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.describe_difference(*_halves(spark, sf_dir, "customer", "c_custkey"), ["c_acctbal"]))


@query("select p_size, case when p_size / 100.0 < 0.1 then 'low' when p_size / 100.0 < 0.3 then 'medium' else 'high' end as band, cast(count(*) as bigint) as n from part group by 1, 2")
def risk_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").groupBy("p_size", privacy.risk_band(F.col("p_size") / 100.0).alias("band")).agg(F.count(F.lit(1)).alias("n"))


# --- scores ---------------------------------------------------------------------------------------

MAGGIC_INPUTS = {
    "sex": "o_orderkey % 2", "smoking": "(o_orderkey // 2) % 2", "diabetes": "(o_orderkey // 3) % 2", "copd": "(o_orderkey // 5) % 2", "recent_hf": "(o_orderkey // 7) % 2",
    "betablocker": "(o_orderkey // 11) % 2", "ace_arb": "(o_orderkey // 13) % 2", "lvef": "10 + o_orderkey % 50", "nyha": "1 + o_orderkey % 4",
    "creatinine": "60 + (o_orderkey * 7) % 220", "bmi": "12 + (o_orderkey * 3) % 25", "sbp": "90 + (o_orderkey * 11) % 80", "age": "40 + (o_orderkey * 13) % 55",
}


def _maggic_sql() -> str:
    from cohortloom.scores import maggic as m

    def bands(x: str, rows: list[tuple]) -> str:
        return "case " + " ".join(f"when {x} < {b} then {p}" for b, p in rows[:-1]) + f" else {rows[-1][1]} end"

    def strata(f: Callable[[int], str]) -> str:
        return f"case when lvef < {m.STRATA[0]} then {f(0)} when lvef < {m.STRATA[1]} then {f(1)} else {f(2)} end"

    plus = " + ".join([f"case when {k} = 1 then {p} else 0 end" for k, p in m.POINTS.items()])
    total = f"case when sex = 0 then 1 else 0 end + {plus} + {bands('lvef', m.LVEF)} + case nyha when 2 then 2 when 3 then 6 when 4 then 8 else 0 end + {bands('creatinine', m.CREATININE)} + {bands('bmi', m.BMI)} + {strata(lambda s: bands('sbp', m.SBP[s]))} + {strata(lambda s: bands('age', list(zip(m.AGE_BELOW, m.AGE[s]))))}"
    inputs = ", ".join(f"{v} as {k}" for k, v in MAGGIC_INPUTS.items() if k != "lvef") + f", case when o_orderkey % 9 <> 0 then {MAGGIC_INPUTS['lvef']} end as lvef"
    risk = lambda t: f"round(list_extract({t}, cast(maggic + 1 as int)), 6)"
    return f"""with i as (select o_orderkey, {inputs} from orders), s as (select o_orderkey, case when lvef is not null then {total} end as maggic from i)
    select o_orderkey, cast(coalesce(maggic, -1) as bigint) as maggic, coalesce({risk(m.RISK_3_YEARS)}, -1) as risk_3y, coalesce({risk(m.RISK_1_YEAR)}, -1) as risk_1y from s"""


@query(_maggic_sql())
def maggic_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").selectExpr("o_orderkey", *[f"{v.replace('//', 'div')} as {k}" for k, v in MAGGIC_INPUTS.items()])
    orders = orders.withColumn("lvef", F.when(F.col("o_orderkey") % 9 != 0, F.col("lvef")))
    made = maggic(orders, {k: k for k in MAGGIC_INPUTS})
    minus = F.lit(-1.0)
    return made.select("o_orderkey", F.coalesce("maggic", F.lit(-1)).alias("maggic"), F.coalesce("maggic_risk_3y", minus).alias("risk_3y"), F.coalesce("maggic_risk_1y", minus).alias("risk_1y"))


#: Made-up trees that have every kind a table of trees can have: weight, kind, input, ge, at, input, ge, at.
DEMO_TREES = [(0.5, "one", 6, True, 3.5, 0, False, 0.0), (0.25, "both", 6, True, 3.0, 0, True, 60.0), (0.75, "either", 7, False, 14.0, 3, True, 12.0), (0.125, "constant", 0, False, 0.0, 0, False, 0.0)]
MARKER_INPUTS = {"bpdias": "15 + l_partkey % 110", "creatn": "(l_suppkey % 30) / 2.0", "bun": "l_partkey % 160", "hgb": "2 + l_quantity / 3.0", "wbc": "l_suppkey % 40", "plt": "l_partkey % 1500", "alb": "(l_partkey % 60) / 10.0", "rdw": "10 + l_suppkey % 20"}


@query(f"""with i as (select {", ".join(f"{v} as {k}" for k, v in MARKER_INPUTS.items())} from lineitem),
    s as (select *, (0.5 * case when alb >= 3.5 then -1 else 1 end + 0.25 * case when alb >= 3.0 and bpdias >= 60 then -1 else 1 end + 0.75 * case when rdw < 14 or hgb >= 12 then -1 else 1 end + 0.125) / 1.625 as v from i)
    select bpdias, rdw, round(case when bpdias between 20 and 120 and creatn between 0 and 25 and bun between 0 and 160 and hgb between 2 and 20 and wbc between 0 and 40 and plt between 0 and 1500 and alb between 0 and 6 and rdw between 10 and 30 then v else -99.0 end, 6) as score, cast(count(*) as bigint) as n from s group by 1, 2, 3""")
def marker_hf(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = load(spark, sf_dir, "lineitem").selectExpr(*[f"{v} as {k}" for k, v in MARKER_INPUTS.items()])
    made = stump_score(inputs, {k: k for k in MARKER_INPUTS}, DEMO_TREES, 1.625, "score")
    return made.groupBy("bpdias", "rdw", r6("score").alias("score")).agg(F.count(F.lit(1)).alias("n"))


def _many_trees() -> list[tuple]:
    """60 made-up trees over all inputs, by rule."""
    at = lambda k, i: round(RANGES[INPUTS[i]][0] + (RANGES[INPUTS[i]][1] - RANGES[INPUTS[i]][0]) * (k * 7 % 19 + 1) / 20, 3)
    return [((k % 8 + 1) / 16, ("one", "both", "either")[k % 3], k % 8, k % 2 == 0, at(k, k % 8), (k + 3) % 8, k % 5 < 2, at(k + 5, (k + 3) % 8)) for k in range(60)]


def _many_trees_sql() -> str:
    holds = lambda i, ge, x: f"{INPUTS[i]} {'>=' if ge else '<'} {x}"
    low = {"one": "{0}", "both": "{0} and {1}", "either": "{0} or {1}"}
    total = " + ".join(f"{w} * case when {low[kind].format(holds(i, ge, x), holds(j, ge2, y))} then -1 else 1 end" for w, kind, i, ge, x, j, ge2, y in _many_trees())
    good = " and ".join(f"{n} between {a} and {b}" for n, (a, b) in RANGES.items())
    return f"""with i as (select {", ".join(f"{v} as {k}" for k, v in MARKER_INPUTS.items())} from lineitem)
      select bpdias, rdw, round(case when {good} then ({total}) / 4.0 else -99.0 end, 6) as score, cast(count(*) as bigint) as n from i group by 1, 2, 3"""


@query(_many_trees_sql())
def marker_hf_many_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = load(spark, sf_dir, "lineitem").selectExpr(*[f"{v} as {k}" for k, v in MARKER_INPUTS.items()])
    made = stump_score(inputs, {k: k for k in MARKER_INPUTS}, _many_trees(), 4.0, "score")
    return made.groupBy("bpdias", "rdw", r6("score").alias("score")).agg(F.count(F.lit(1)).alias("n"))


@query()
def gaussian_copula_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthesis.synthesize(load(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"], 1000)


@query("select l_returnflag as value, round(count(*) / sum(count(*)) over (), 6) as share, true as near from lineitem where l_returnflag is not null group by 1")
def copula_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each category in the fitted copula, and whether it is drawn as often as it occurs, to two hundredths of all rows."""
    rows, category = load(spark, sf_dir, "lineitem"), "l_returnflag"
    model = synthesis.fit_gaussian_copula(rows, ["l_quantity", category])
    flag, made = model.columns[1], synthesis.sample_gaussian_copula(spark, model, 20_000)
    ends = [0.0, *flag.grid.tolist()]
    fitted = spark.createDataFrame([(v, high - low) for v, low, high in zip(flag.values, ends, ends[1:])], "value string, share double")
    part = lambda d, n: d.groupBy(F.col(category).alias("value")).agg((F.count(F.lit(1)) / F.lit(float(d.count() or 1))).alias(n)).where("value is not null")
    found = fitted.join(part(rows, "u"), "value", "full_outer").join(part(made, "v"), "value", "full_outer")
    return rounded(found.select("value", "share", (F.abs(F.coalesce("u", F.lit(0)) - F.coalesce("v", F.lit(0))) < 0.02).alias("near")))


MIXED = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]


@query(" union all ".join(f"""select '{c}' as "column", 'mean' as part, round(avg({c}), 4) as value from lineitem union all select '{c}', 'spread', round(stddev_pop({c}), 4) from lineitem""" for c in MIXED[:3])
    + " union all select 'l_returnflag', l_returnflag, round(count(*) / sum(count(*)) over (), 4) from lineitem where l_returnflag is not null group by 2")
def mixture_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and spread of each number, and the share of each category, of all components together: expectation maximisation keeps those of the table."""
    model = mixture.fit_mixture(load(spark, sf_dir, "lineitem"), MIXED, 4, 12)
    rows = []
    for j, (c, _, centre, spread, _, _) in enumerate(model.numbers):
        w = model.weight * model.known[:, j] / (model.weight @ model.known[:, j])
        mean = w @ model.mean[:, j]
        rows += [(c, "mean", float(mean * spread + centre)), (c, "spread", float((w @ (model.variance[:, j] + model.mean[:, j] ** 2) - mean**2) ** 0.5 * spread))]
    rows += [(c, v, float(model.weight @ model.chances[j][:, k])) for j, (c, _, values) in enumerate(model.categories) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, '"column" string, part string, value double'.replace('"', "`")).withColumn("value", F.round("value", 4))


@query()
def mixture_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthesis.synthesize(load(spark, sf_dir, "lineitem"), MIXED, 1000, "mixture")


TREE_COLUMNS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax"]


@query(" union all ".join(f"""select '{a}' as a, '{b}' as b, round(sum(n / total * ln(n * total / (na * nb))), 6) as information from
      (select count(*) as n, sum(count(*)) over () as total, sum(count(*)) over (partition by {a}) as na, sum(count(*)) over (partition by {b}) as nb from lineitem group by {a}, {b})""" for i, a in enumerate(TREE_COLUMNS) for b in TREE_COLUMNS[i + 1 :]))
def tree_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mutual information of each pair of columns, that the dependency tree is made from."""
    model = tree.fit_tree(load(spark, sf_dir, "lineitem"), TREE_COLUMNS)
    return rounded(spark.createDataFrame([(a, b, v) for (a, b), v in model.information.items()], "a string, b string, information double"))


@query()
def tree_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthesis.synthesize(load(spark, sf_dir, "lineitem"), [*TREE_COLUMNS, "l_extendedprice"], 1000, "tree")


NETWORK_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def _network(ends: list[tuple]) -> autoencoder.Autoencoder:
    return autoencoder.new_autoencoder(NETWORK_COLUMNS, ends, 3, 2, 7)


def _network_sql() -> str:
    """The untrained network written out: its weights are a fixed draw, its inputs are scaled by the table's ends."""
    w = _network([(0.0, 1.0, 0.5)] * 3).weights

    def layer(inputs: list[str], k: int, form: str) -> list[str]:
        return [form.format(" + ".join(f"{x} * ({m!r})" for x, m in zip(inputs, w[k][:, j].tolist())) + f" + ({float(w[k + 1][j])!r})") for j in range(w[k].shape[1])]

    names = lambda p, n: [f"{p}{i}" for i in range(n)]
    steps, inputs = [], names("x", 3)
    for k, (p, form) in enumerate((("a", "greatest(0, {})"), ("z", "{}"), ("c", "greatest(0, {})"), ("y", "1 / (1 + exp(-({})))"))):
        made = layer(inputs, 2 * k, form)
        inputs = names(p, len(made))
        steps.append(f"{p} as (select *, {', '.join(f'{e} as {n}' for e, n in zip(made, inputs))} from {'x' if not k else 'azc'[k - 1]})")
    scaled = ", ".join(f"({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()) as x{i}" for i, c in enumerate(NETWORK_COLUMNS))
    return f"""with x as (select l_linenumber, {scaled} from lineitem), {', '.join(steps)}
      select l_linenumber, round(avg(((y0 - x0) ** 2 + (y1 - x1) ** 2 + (y2 - x2) ** 2) / 3), 6) as error, round(avg(z0), 6) as code_0, round(avg(z1), 6) as code_1 from y group by 1"""


@query(_network_sql())
def autoencoder_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of a network on the whole table."""
    rows = load(spark, sf_dir, "lineitem")
    made = autoencoder.apply(rows, "l_linenumber", _network(autoencoder.column_ends(rows, NETWORK_COLUMNS)))
    return rounded(made.groupBy("l_linenumber").agg(F.avg("error").alias("error"), *[F.avg(F.get("code", F.lit(k))).alias(f"code_{k}") for k in (0, 1)]))


@query()
def autoencoder_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and validation loss of each epoch."""
    rows = load(spark, sf_dir, "lineitem").withColumn("line", F.struct("l_orderkey", "l_linenumber").cast("string"))
    model = autoencoder.train(rows, "line", NETWORK_COLUMNS, tables.scratch(spark, "training"), autoencoder.Training(16, 2, 2, 3, rate=0.01))
    return rounded(spark.createDataFrame([(h["epoch"], h["train_loss"], h["val_loss"]) for h in model.history], "epoch int, train_loss double, val_loss double"))


def _report_sql() -> str:
    """All metrics of the report over the customers' halves, from one statement."""
    cdf = lambda c: f"""(select c as x, sum(sum(e)) over (order by c) / sum(sum(e)) over () as f, sum(sum(1 - e)) over (order by c) / sum(sum(1 - e)) over () as g, lead(c) over (order by c) as nx
      from (select cast({c} as double) as c, (c_custkey % 2 = 0)::int as e from customer) group by c)"""  # noqa: E731
    parts = ["select 'new_rows' as section, '' as \"column\", 'share' as metric, (select avg((not exists (select 1 from customer r where r.c_custkey % 2 = 0 and r.c_acctbal = s.c_acctbal and r.c_nationkey = s.c_nationkey and r.c_mktsegment = s.c_mktsegment))::int) from customer s where s.c_custkey % 2 = 1) as value"]
    for c in NN_COLUMNS:
        t = f"(select max(abs(f - g)) * sqrt((select n * m / (n + m) from sizes)) from {cdf(c)})"
        p = f"(select case when t < 0.2 then 1.0 else greatest(0.0, least(1.0, (select 2 * sum((case when j % 2 = 1 then 1 else -1 end) * exp(-2.0 * j * j * t * t)) from range(1, 101) r(j)))) end from (select {t} as t))"
        for name, value in (("ks", f"(select max(abs(f - g)) from {cdf(c)})"), ("p_value", p), ("w1", f"(select sum(abs(f - g) * (nx - x)) from {cdf(c)})")):
            parts.append(f"select 'numeric', '{c}', '{name}', {value}")
    parts.append("select 'numerical_lr', 'c_nationkey', 'relative_error', (select avg(abs(c_nationkey - (k * c_acctbal + b))) / (max(c_nationkey) - min(c_nationkey)) from customer, (select regr_slope(c_nationkey, c_acctbal) as k, regr_intercept(c_nationkey, c_acctbal) as b from customer where c_custkey % 2 = 1) where c_custkey % 2 = 0)")
    parts += [f"select 'singling_out', c, '{m}', {m} from single" for m in ("rate", "baseline", "risk")]
    parts += [f"select 'closest', '', '{m}', (select {f} from d)" for m, f in (("mean", "avg(distance)"), ("median", "quantile_cont(distance, 0.5)"), ("min", "min(distance)"), ("max", "max(distance)"), ("std", "stddev_pop(distance)"))]
    parts += ["select 'membership', '', 'threshold', threshold from member", "select 'membership', '', 'rate', rate from member", "select 'attribute', 'c_nationkey', 'risk', risk from told"]
    parts += [f"select '{t}', '{c}', '{m}', {m} from {t}" for t, c in (("linkability", ""), ("inference", "c_acctbal")) for m in ("rate", "baseline", "risk")]
    parts.append("select 'summary', '', 'mean_risk', ((select avg(risk) from single) + (select risk from linkability) + (select risk from inference) + (select rate from member) + (select risk from told)) / 5")
    single = " union all ".join(f"""select '{c}' as c, count(*) filter (u = 1 and v = 1) / nullif(count(*) filter (v = 1), 0) as rate, count(*) filter (u = 1) / count(*) as baseline, count(*) filter (u = 1 and v = 1) / nullif(count(*) filter (v = 1), 0) - count(*) filter (u = 1) / count(*) as risk
      from (select count(*) filter (c_custkey % 2 = 0) as u, count(*) filter (c_custkey % 2 = 1) as v from customer where {c} is not null group by {c})""" for c in SINGLE_COLUMNS)
    near = lambda c, k: f"(select real_id, synthetic_id from r, s where real_id % 20 = 0 qualify row_number() over (partition by real_id order by abs(r.{c} - s.{c}), synthetic_id) <= {k})"
    return f"""with {NN_SQL}, sizes as (select cast(count(*) filter (c_custkey % 2 = 0) as double) as n, cast(count(*) filter (c_custkey % 2 = 1) as double) as m from customer), single as ({single}),
    member as (select threshold, count(*) filter (distance < threshold) / count(*) as rate from d, (select quantile_cont(distance, 0.1) as threshold from d) group by 1),
    told as (select greatest(0, 1 - avg(abs(t - g)) / (max(t) - min(t))) as risk from (select real_id, x.c_nationkey as t, arg_min(y.c_nationkey, (abs(r.a - s.a), synthetic_id)) as g from r, s, customer x, customer y where x.c_custkey = real_id and y.c_custkey = synthetic_id group by 1, 2)),
    linkability as (select k / n as rate, baseline, k / n - baseline as risk from (select count(*) as n from r where real_id % 20 = 0), (select count(distinct real_id) as k from {near("a", 10)} join {near("b", 10)} using (real_id, synthetic_id)),
      (select 1 - product((n - 10 - i) / (n - i)) as baseline from (select count(*) as n from s), range(10) t(i))),
    inference as (select rate, baseline, rate - baseline as risk from (select avg((abs(t.c_acctbal - y.c_acctbal) <= 0.05 * abs(t.c_acctbal))::int) as rate, avg((abs(blind - t.c_acctbal) <= 0.05 * abs(t.c_acctbal))::int) as baseline
      from {near("b", 1)} join customer t on t.c_custkey = real_id join customer y on y.c_custkey = synthetic_id, (select quantile_cont(c_acctbal, 0.5) as blind from customer where c_custkey % 2 = 1)))
    select section, "column", metric, round(value, 6) as value from ({" union all ".join(parts)})"""


@query(_report_sql())
def privacy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    real, synthetic = (h.select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment") for h in _halves(spark, sf_dir, "customer", "c_custkey"))
    return rounded(privacy.evaluate(real, synthetic, "c_custkey"))


@query("""with a as (select count(*) as n, count(*) filter (c_acctbal < 0) as k from customer where c_custkey % 2 = 0), b as (select count(*) as n, count(*) filter (c_acctbal < 0) as k from customer where c_custkey % 2 = 1)
    select 'balance' as "column", cast(a.k as bigint) as real_n_null, round(100.0 * a.k / a.n, 6) as real_pct_null, cast(b.k as bigint) as synthetic_n_null, round(100.0 * b.k / b.n, 6) as synthetic_pct_null from a, b""")
def audit_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    halves = [h.select(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")) for h in _halves(spark, sf_dir, "customer", "c_custkey")]
    return rounded(audit.compare_nulls(*halves, ["balance"]))


PIPELINE_SQL = f"""with {REFS_SQL},
    e as (select e.*, r.ref from events e left join refs r using (user_id)),
    w as (select user_id, arg_min(value, ts) filter (event_type = 'purchase' and (ref is null or ts >= ref)) as purchase_first_after,
      arg_min(value, ts) filter (event_type = 'view' and (ref is null or ts < ref)) as view_any_before from e where event_type in ('purchase', 'view') group by 1)
    select c_custkey, coalesce(case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 end, -1) as segment,
      round(purchase_first_after, 6) as purchase_first_after, round(view_any_before, 6) as view_any_before
    from customer left join w on c_custkey = w.user_id"""


@query(PIPELINE_SQL)
def configured_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings-driven pipeline end to end: flat and expanded sources, transforms, merge, as-of values."""
    refs = f"{tables.scratch(spark, 'refs')}.parquet"
    tables.write_parquet(_refs(load(spark, sf_dir, "events")), refs)
    settings = {
        "name": "demo", "absolute_path": "", "preprocessing": tables.scratch(spark, "cohort"),
        f"{sf_dir}/customer.parquet": ["c_custkey", "c_mktsegment"],
        f"{sf_dir}/events.parquet": ["user_id", "event_type", {"value": {"purchase": "purchase", "view": "view"}}, ["ts"]],
        refs: ["user_id", "ref"],
        "InitTransforms": {"c_mktsegment": {"func": "fillna", "kwargs": {"values": {"c_mktsegment": "none"}}}},
        "MergedTransforms": {"c_mktsegment": {"func": "map", "kwargs": {"map": {"BUILDING": 1, "MACHINERY": 2}}}},
        "ref_date": "ref", "tuple_vals_after": ["purchase"], "tuple_vals_anybefore": ["view"],
    }
    made = pipeline.run(spark, settings)
    return rounded(made.select("c_custkey", F.coalesce("c_mktsegment", F.lit(-1)).alias("segment"), "purchase_first_after", "view_any_before"))


@query(f"""with p as ({PIPELINE_SQL}), n as (select count(*) as rows, count(*) filter (segment != -1) as mapped, count(purchase_first_after) as bought from p)
    select 'preprocessed' as stage, cast(rows as bigint) as rows, cast(mapped as bigint) as known from n union all select 'selected', rows, bought from n union all select 'imputed', rows, rows from n union all select 'synthetic', rows, rows from n""")
def staged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw tables to the privacy report by the graph of stages: the rows of each stage, and those with a known value."""
    refs = f"{tables.scratch(spark, 'refs')}.parquet"
    tables.write_parquet(_refs(load(spark, sf_dir, "events")), refs)
    etl = {
        "name": "staged", "absolute_path": "",
        f"{sf_dir}/customer.parquet": ["c_custkey", "c_mktsegment"],
        f"{sf_dir}/events.parquet": ["user_id", "event_type", {"value": {"purchase": "purchase", "view": "view"}}, ["ts"]],
        refs: ["user_id", "ref"],
        "MergedTransforms": {"c_mktsegment": {"func": "map", "kwargs": {"map": {"BUILDING": 1, "MACHINERY": 2}}}},
        "ref_date": "ref", "tuple_vals_after": ["purchase"], "tuple_vals_anybefore": ["view"],
    }
    columns = ["c_mktsegment", "purchase_first_after", "view_any_before"]
    synth = {"columns": columns, "num_points": load(spark, sf_dir, "customer").count(), "synth_type": "tree"}
    where = stages.everything(spark, {"folder": tables.scratch(spark, "stages"), "key": "c_custkey", "etl": etl, "synth": synth})
    wanted = {"preprocessed": "c_mktsegment", "selected": "purchase_first_after", "imputed": "view_any_before", "synthetic": "c_custkey"}
    parts = [spark.read.parquet(f"{where[name]}/rows").agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"), F.count(c).alias("known")) for name, c in wanted.items()]
    return reduce(DataFrame.unionByName, parts)


@query("select p_partkey, p_brand in ('Brand#1', 'Brand#2', 'Brand#3') or starts_with(p_brand, 'Brand#1') as hit from part")
def code_prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.col("p_brand")
    return load(spark, sf_dir, "part").select("p_partkey", (in_codes(brand, ["Brand#1", "Brand#2", "Brand#3"]) | in_codes(brand, ["Brand#1"], "prefix")).alias("hit"))


@query("""with r as (select s_suppkey, s_acctbal from supplier), q as (select c_custkey, c_acctbal from customer where c_custkey % 20 = 0)
    select c_custkey, s_suppkey, round(abs(c_acctbal - s_acctbal), 6) as distance, cast(row_number() over (partition by c_custkey order by abs(c_acctbal - s_acctbal), s_suppkey) as int) as place from q, r qualify place <= 3""")
def k_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = load(spark, sf_dir, "customer").where("c_custkey % 20 = 0").select("c_custkey", F.col("c_acctbal").alias("x"))
    return rounded(nearest(queries, load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("x")), "c_custkey", "s_suppkey", ["x"], 3))
