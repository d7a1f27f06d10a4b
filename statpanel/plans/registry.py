"""Registered queries: each runs on the whole tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statpanel import functions as fn
from statpanel import operators as op
from statpanel import sources as src
from statpanel.plans import panels, views
from statpanel.plans.load import check_tables, load_tables
from statpanel.schema import enriched, landed

Query = Callable[[SparkSession, str], DataFrame]

SINCE = 1997
SEGMENT_TOPICS = [f"Order value: {s}" for s in ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")]
# MACHINERY has no category on purpose.
SEGMENT_CATEGORIES = [
    ("%FURNITURE%", "furniture"),
    ("%AUTO%", "automobile"),
    ("%HOUSE%", "household"),
]
PRIORITY_TOPICS = [f"Order value: {p}" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")]
PRIORITY_CATEGORIES = [("%URGENT%", "urgent"), ("%HIGH%", "high"), ("%-%", "normal")]
DATASETS = {
    "ACT1": "activity",
    "PRI1": "priorities",
    "SEG1": "segments",
    "TYP1": "types",
    "TYP2": "types",
}
TYPE_RULES = {"types": [panels.TYPE_PREFIX, r" \(\d.+\)$"]}

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---- The four views -----------------------------------------------------------------------------


@query
def view_expenditure_change(spark, sf_dir):
    panel = panels.with_national(panels.segments(spark, sf_dir))
    return views.consumer_expenditures(
        panel, topics=SEGMENT_TOPICS, categories=SEGMENT_CATEGORIES, since=SINCE
    )


@query
def view_expenditure_change_customers(spark, sf_dir):
    panel = panels.customer_spend(spark, sf_dir)
    return views.consumer_expenditures(
        panel, topics=PRIORITY_TOPICS, categories=PRIORITY_CATEGORIES, since=SINCE
    )


def _income(disposable, personal):
    return views.income(
        disposable,
        personal,
        disposable_topic="Per customer disposable order value",
        personal_topic="Per customer personal order value",
        since=SINCE,
    )


@query
def view_income_change(spark, sf_dir):
    return _income(*panels.incomes(spark, sf_dir))


@query
def view_income_change_customers(spark, sf_dir):
    return _income(*panels.customer_incomes(spark, sf_dir))


def _employment(panel):
    return views.employment_population(
        panel, employment_topic="Total orders", population_topic="Active customers", since=SINCE
    )


@query
def view_employment_population(spark, sf_dir):
    return _employment(_once(spark, panels.activity(spark, sf_dir)))


@query
def view_employment_population_customers(spark, sf_dir):
    return _employment(_once(spark, panels.customer_activity(spark, sf_dir)))


def _top_industry(panel):
    return views.industry_compensation(panel, national=panels.NATIONAL, aggregates=[panels.ALL_TYPES])


@query
def view_top_industry(spark, sf_dir):
    return _top_industry(panels.with_national(panels.part_types(spark, sf_dir)))


@query
def view_top_industry_suppliers(spark, sf_dir):
    return _top_industry(panels.supplier_part_types(spark, sf_dir))


@query
def view_top_priority_ties(spark, sf_dir):
    return _top_industry(panels.priorities(spark, sf_dir))


@query
def view_top_priority_ties_customers(spark, sf_dir):
    return _top_industry(panels.customer_orders(spark, sf_dir))


# ---- Change, rank, top --------------------------------------------------------------------------


def _changes(panel, **options):
    rows = panel.select("geoname", "topic", "timeperiod", "datavalue")
    return op.change(rows, ["geoname", "topic"], "timeperiod", "datavalue", **options)


@query
def lag_previous_period(spark, sf_dir):
    panel = panels.with_gaps(panels.segments(spark, sf_dir))
    return _changes(panel).drop("change")


@query
def lag_previous_period_chunked(spark, sf_dir):
    panel = panels.customer_spend(spark, sf_dir)
    decade = F.substring("timeperiod", 1, 3)
    return _changes(panel, chunk=decade).drop("change")


@query
def lag_previous_period_ranges(spark, sf_dir):
    """The same without a column that cuts the series: ranges of (entity, period) do."""
    return _changes(panels.customer_spend(spark, sf_dir), ranges=16).drop("change")


@query
def lag_on_bucketed_table(spark, sf_dir):
    """Change over a table whose series lie together: the window needs no shuffle."""
    by = ["geoname", "topic"]
    path = src.scratch_path(spark, "bucketed")
    table = src.create_table(
        panels.customer_spend(spark, sf_dir), "statpanel_series", path, bucket_by=by, sort_by=["timeperiod"], buckets=16
    )
    return _changes(table).drop("change")


@query
def pct_change_current_base(spark, sf_dir):
    return _changes(panels.segments(spark, sf_dir)).drop("prev")


@query
def dense_rank_change(spark, sf_dir):
    changed = _changes(panels.with_gaps(panels.segments(spark, sf_dir)))
    return op.rank_within(changed, ["timeperiod", "topic"], "change", "change_rank", digits=2)


@query
def dense_rank_value_customers(spark, sf_dir):
    rows = panels.customer_spend(spark, sf_dir).select("geoname", "topic", "timeperiod", "datavalue")
    return op.rank_within(rows, ["timeperiod"], "datavalue", "value_rank")


@query
def rank_fractional_customers(spark, sf_dir):
    """Values per order are doubles with all their digits."""
    rows = panels.customer_incomes(spark, sf_dir)[1].select("geoname", "timeperiod", "datavalue")
    return op.rank_within(rows, ["timeperiod"], "datavalue", "value_rank")


@query
def top_per_group(spark, sf_dir):
    panel = panels.priorities(spark, sf_dir)
    return op.top_per_group(panel, ["geoname", "timeperiod"], "datavalue")


@query
def top_two_per_group_customers(spark, sf_dir):
    panel = panels.customer_orders(spark, sf_dir)
    return op.top_per_group(panel, ["timeperiod", "topic"], "datavalue", k=2)


@query
def align_topics_pivot(spark, sf_dir):
    topics = {"Total orders": "orders", "Active customers": "customers"}
    return op.align_topics_pivot(panels.activity(spark, sf_dir), ["geoname", "timeperiod"], topics)


# ---- Set operations, filters --------------------------------------------------------------------


@query
def union_distinct(spark, sf_dir):
    placed = panels.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("tag")
    )
    known = panels.read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return op.union_distinct(placed, known)


@query
def union_by_name_missing(spark, sf_dir):
    priorities = panels.priorities(spark, sf_dir).drop("noteref")
    return op.union_by_name(panels.segments(spark, sf_dir), priorities)


@query
def symmetric_difference(spark, sf_dir):
    def bands(name, nation, balance):
        band = F.floor(F.col(balance) / 100).cast("bigint")
        return panels.read(spark, sf_dir, name).select(F.col(nation).alias("nation"), band.alias("band"))

    customers = bands("customer", "c_nationkey", "c_acctbal")
    return op.symmetric_difference(customers, bands("supplier", "s_nationkey", "s_acctbal"))


@query
def first_wins_merge(spark, sf_dir):
    panel = _once(spark, panels.customer_spend(spark, sf_dir).select("code", "geofips", "timeperiod", "datavalue"))
    estimates = panel.withColumn("datavalue", F.col("datavalue") * 2)
    return op.first_wins([panels.with_gaps(panel), estimates], ["code", "geofips", "timeperiod"])


def _reference_names(spark, sf_dir):
    nation = panels.read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("position"), F.concat("n_name", F.lit("[B]")).alias("name")
    )
    country = panels.read(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("position"), F.lit(f"The {panels.NATIONAL} here").alias("name")
    )
    district = nation.filter(F.col("position") == 24).withColumn("name", F.lit("NATION_24"))
    return op.reference_names(country, nation, district, n=20, word=panels.NATIONAL)


def _once(spark, df):
    """A panel that a query uses several times: written, and read again."""
    path = src.scratch_path(spark, "panel")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _marked_panel(spark, sf_dir, base=None):
    """Nations, their regions, and the marked national total."""
    nations = _once(spark, panels.segments(spark, sf_dir, base))
    total = panels.with_national(nations, mark=" *").filter(F.col("geofips") == "99999")
    return panels.with_regions(nations, spark, sf_dir).unionByName(total)


@query
def strip_annotation(spark, sf_dir):
    customers = panels.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("position"), F.concat("c_name", F.lit("[B]")).alias("name")
    )
    suppliers = panels.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("position"), F.col("s_name").alias("name")
    )
    country = suppliers.withColumn("name", F.lit(f"The {panels.NATIONAL} here"))
    return op.reference_names(country, customers, suppliers, n=50, word=panels.NATIONAL)


@query
def strip_annotation_all(spark, sf_dir):
    customers = panels.read(spark, sf_dir, "customer").select(F.concat("c_name", F.lit("[B]")).alias("name"))
    suppliers = panels.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    names = customers.unionByName(suppliers)
    return names.select(fn.strip_annotation(F.col("name")).alias("geoname"))


@query
def semi_join_names(spark, sf_dir):
    return op.keep_listed(_marked_panel(spark, sf_dir), _reference_names(spark, sf_dir), "geoname")


def _tables_by_key(spark, sf_dir):
    """The dictionary with its keys spread over the tables TYP1 to TYP6."""
    tag = F.concat(F.lit("TYP"), F.substring("Key", 2, 1))
    raw = panels.raw_dictionary(spark, sf_dir)
    return op.prepare_dictionary(raw.withColumn("Desc", F.regexp_replace("Desc", F.lit("TYP1"), tag)))


@query
def semi_join_values(spark, sf_dir):
    """Facts of the tables TYP5 to TYP9, TYP0 and TYP1: some tables are on one side only."""
    facts = panels.supplier_part_types(spark, sf_dir).select(
        F.concat(F.lit("TYP"), F.substring("timeperiod", 4, 1)).alias("table")
    )
    return op.keep_listed(_tables_by_key(spark, sf_dir), facts, "table")


@query
def geo_normalise(spark, sf_dir):
    name = fn.unmark_name(F.col("geoname"), panels.NATIONAL)
    return _marked_panel(spark, sf_dir).withColumn("geoname", name)


@query
def like_case_category(spark, sf_dir):
    category = fn.categorise(F.col("topic"), SEGMENT_CATEGORIES)
    return panels.segments(spark, sf_dir).select("code", "geofips", "timeperiod", category.alias("category"))


@query
def in_not_in_filter(spark, sf_dir):
    panel = panels.supplier_part_types(spark, sf_dir)
    return panel.filter(
        F.col("timeperiod").isin("1998", "1999")
        & ~F.col("topic").isin(panels.ALL_TYPES)
        & (F.col("endpoint") != "12")
        & (F.col("table") == "TYP2")
    )


def _with_bad_periods(panel):
    bad = F.col("geofips").endswith("7") & (F.col("timeperiod") == "1998")
    return panel.withColumn("timeperiod", F.when(bad, F.lit("(NA)")).otherwise(F.col("timeperiod")))


@query
def year_lower_bound(spark, sf_dir):
    panel = _with_bad_periods(panels.customer_spend(spark, sf_dir))
    kept = panel.filter(fn.at_least_year(F.col("timeperiod"), SINCE))
    return kept.withColumn("from_1999", F.col("timeperiod") >= "1999")


@query
def sorted_panel(spark, sf_dir):
    return op.in_order(panels.customer_spend(spark, sf_dir), "timeperiod", "topic", "geoname")


# ---- Checks -------------------------------------------------------------------------------------


def _damaged(spark, sf_dir):
    """Two datasets with nulls and bad periods."""
    panel = panels.segments(spark, sf_dir).unionByName(panels.customer_spend(spark, sf_dir))
    damaged = _with_bad_periods(panel).withColumns(
        {
            "code": F.nullif("code", F.lit("CUS1-4")),
            "geoname": F.nullif("geoname", F.lit("NATION_3")),
            "table": F.when(F.col("timeperiod") != "1996", F.col("table")),
            "topic": F.nullif("topic", F.lit("Order value: BUILDING")),
        }
    )
    dataset = F.when(F.col("geofips").startswith("0000") & (F.length("geofips") == 9), F.lit("customers"))
    return damaged.withColumn("dataset", F.coalesce(dataset, F.lit("others")))


@query
def any_null_count(spark, sf_dir):
    return op.check_keys(_damaged(spark, sf_dir))


@query
def entity_coverage(spark, sf_dir):
    return op.check_coverage(_damaged(spark, sf_dir))


@query
def repeated_keys(spark, sf_dir):
    return op.check_unique(_damaged(spark, sf_dir))


@query
def sentinel_codes(spark, sf_dir):
    return op.check_sentinels(_damaged(spark, sf_dir), ["SEG1-1"])


@query
def unmatched_codes(spark, sf_dir):
    facts = panels.part_types(spark, sf_dir).unionByName(panels.supplier_part_types(spark, sf_dir))
    dictionary = op.prepare_dictionary(panels.raw_dictionary(spark, sf_dir))
    return op.unmatched_codes(facts.withColumn("dataset", F.col("table")), dictionary)


# ---- Dictionary, enrichment, landing ------------------------------------------------------------


@query
def distinct_rows(spark, sf_dir):
    return panels.raw_dictionary(spark, sf_dir).distinct()


@query
def distinct_values(spark, sf_dir):
    return panels.raw_dictionary(spark, sf_dir).select("Key").distinct()


@query
def dictionary_prepare(spark, sf_dir):
    return op.prepare_dictionary(panels.raw_dictionary(spark, sf_dir))


@query
def request_manifest(spark, sf_dir):
    dictionary = op.prepare_dictionary(panels.raw_dictionary(spark, sf_dir))
    return op.request_manifest(dictionary, ["TYP1"], {"TYP1": r"\("})


@query
def code_split(spark, sf_dir):
    return op.split_codes(panels.supplier_part_types(spark, sf_dir))


@query
def topic_clean(spark, sf_dir):
    dictionary = op.prepare_dictionary(panels.raw_dictionary(spark, sf_dir))
    return op.topics_of(dictionary, DATASETS, TYPE_RULES)


def _enriched(spark, panel, sf_dir, table):
    facts = panel.select(*[F.col(c).alias(c.upper()) for c in landed().fieldNames()])
    dictionary = op.prepare_dictionary(panels.raw_dictionary(spark, sf_dir)).withColumn(
        "table", F.lit(table)
    )
    topics = op.sized(op.topics_of(dictionary, DATASETS, TYPE_RULES))
    return op.enrich(facts, dictionary, national=panels.NATIONAL, topics=topics)


@query
def enrich_observations(spark, sf_dir):
    panel = panels.with_national(panels.part_types(spark, sf_dir), mark=" *")
    return _enriched(spark, panel, sf_dir, "TYP1")


@query
def enrich_observations_suppliers(spark, sf_dir):
    return _enriched(spark, panels.supplier_part_types(spark, sf_dir), sf_dir, "TYP2")


@query
def route_datasets(spark, sf_dir):
    base = _once(spark, panels.orders_by_day(spark, sf_dir))
    frames = [
        _once(spark, _marked_panel(spark, sf_dir, base)),
        panels.priorities(spark, sf_dir, base).drop("noteref"),
        panels.activity(spark, sf_dir, base),
        _once(spark, panels.customer_activity(spark, sf_dir, base)),
    ]
    path = src.scratch_path(spark, "landing")
    names = frames[0].select("geoname").unionByName(frames[3].select("geoname"))
    names = names.filter(~F.col("geoname").isin("ASIA", "EUROPE"))
    return op.land(frames, names, path, DATASETS, rebalance=True)


@query
def load_and_check(spark, sf_dir):
    datasets = {"TYP1": "statpanel_nation_types", "TYP2": "statpanel_supplier_types"}
    panel = panels.part_types(spark, sf_dir).unionByName(panels.supplier_part_types(spark, sf_dir))
    landing = src.scratch_path(spark, "landing")
    other = panels.priorities(spark, sf_dir)
    frames = [df.select(landed().fieldNames()) for df in (panel, other)]
    op.land(frames, None, landing, datasets, rebalance=True)
    first = op.prepare_dictionary(panels.raw_dictionary(spark, sf_dir))
    dictionary = first.unionByName(first.withColumn("table", F.lit("TYP2")))
    names = sorted(datasets.values())
    observations = spark.read.schema(_landed_with_dataset()).parquet(landing)
    sentinels = ["TYP1-11", "TYP2-1"]
    counted = load_tables(
        spark,
        observations,
        dictionary,
        src.scratch_path(spark, "tables"),
        datasets=datasets,
        schemas={name: enriched() for name in names},
        rules={name: TYPE_RULES["types"] for name in names},
        sentinels=sentinels,
    )
    return check_tables(
        spark, names, observations=observations, dictionary=dictionary, sentinels=sentinels, counted=counted
    )


def _landed_with_dataset():
    return StructType([*landed().fields, StructField("dataset", StringType())])


# ---- Sources and sinks --------------------------------------------------------------------------


@query
def json_columnar_roundtrip(spark, sf_dir):
    path = src.scratch_path(spark, "json")
    src.write_columnar_json(
        panels.supplier_part_types(spark, sf_dir).withColumn("dataset", F.lit("types")), path
    )
    return src.read_columnar_json(spark, path, enriched(), pattern="*.txt")


@query
def json_discovery(spark, sf_dir):
    """A folder of `name.json` documents with other files beside them; the name is the dataset."""
    path = src.scratch_path(spark, "documents")
    panel = panels.part_types(spark, sf_dir).withColumn("dataset", F.lit("types")).coalesce(1)
    src.write_columnar_json(panel, f"{path}-parts")
    src.name_document(spark, f"{path}-parts/dataset=types", f"{path}/nation types+1.json")
    panel.select(F.lit("no document").alias("value")).write.text(f"{path}/notes.txt")
    return src.read_columnar_json(spark, path, enriched())


@query
def csv_dictionary(spark, sf_dir):
    path = src.scratch_path(spark, "csv")
    src.write_csv(_tables_by_key(spark, sf_dir), path)
    return src.read_dictionary(spark, path)


@query
def database_export_restore(spark, sf_dir):
    """Export tables and a view, run the scripts, read the tables: blanks, quotes, line breaks and nulls come back."""
    customers, nations, rich = "statpanel_back_customers", "statpanel_back_nations", "statpanel_back_rich"
    rows = panels.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("  "), "c_name", F.lit(" \t")).alias("padded"),
        F.concat("c_mktsegment", F.lit("\nsecond \"line\", 'quoted'")).alias("broken"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    names = panels.read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    path = src.scratch_path(spark, "it's an export")
    view = {rich: f"SELECT id FROM {customers}\nWHERE balance > 0"}
    src.export_database(spark, {customers: rows, nations: names}, path, view)
    spark.sql(f"DROP VIEW IF EXISTS {rich}")
    for name in (customers, nations):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    src.run_script(spark, f"{path}/schema.sql")
    src.run_script(spark, f"{path}/load.sql")
    shown = spark.table(rich).withColumn("rich", F.lit(True))
    back = spark.table(customers).join(shown, "id", "left").withColumn("rich", F.coalesce("rich", F.lit(False)))
    return back.withColumn("nations", F.lit(spark.table(nations).count()))


@query
def csv_roundtrip(spark, sf_dir):
    path = src.scratch_path(spark, "csv")
    src.write_csv(panels.supplier_part_types(spark, sf_dir), path)
    return src.import_csv(spark, path, enriched())


@query
def table_ctas(spark, sf_dir):
    panel = panels.customer_spend(spark, sf_dir)
    return src.create_table(panel, "statpanel_spend", src.scratch_path(spark, "table"))


@query
def fetch_manifest(spark, sf_dir):
    """Every request of the manifest is fetched by its task, from what stands in for the remote service."""
    return src.fetch_requests(_manifest(spark, sf_dir), _fetcher(_responses(spark, sf_dir)), _response_schema())


@query
def fetch_chosen(spark, sf_dir):
    """Requests as a data source: of the manifest's requests only the two that the filter names are fetched."""
    fetch = _fetcher(_responses(spark, sf_dir))
    rows = src.open_requests(_manifest(spark, sf_dir), fetch, _response_schema())
    return rows.filter((F.col("table") == "TYP1") & F.col("line_code").isin("11", "13")).drop("table", "line_code")


def _fetcher(path):
    schema = _response_schema()

    def fetch(table, line_code):
        import pyarrow.json as pj
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = pj.ParseOptions(explicit_schema=to_arrow_schema(schema))
        store, root = fs.FileSystem.from_uri(f"{path}/code={table}-{line_code}")
        for file in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if file.size and file.extension == "json":
                with store.open_input_stream(file.path) as stream:
                    yield from pj.read_json(stream, parse_options=shape).to_batches()

    return fetch


@query
def landed_responses(spark, sf_dir):
    return src.read_responses(spark, _responses(spark, sf_dir), _response_schema(), _manifest(spark, sf_dir))


def _responses(spark, sf_dir):
    path = src.scratch_path(spark, "responses")
    src.write_responses(panels.part_types(spark, sf_dir).drop("table", "endpoint", "topic"), path)
    return path


def _manifest(spark, sf_dir):
    dictionary = op.prepare_dictionary(panels.raw_dictionary(spark, sf_dir))
    return op.request_manifest(dictionary, ["TYP1"], {"TYP1": r"\("})


def _response_schema():
    return StructType([f for f in landed().fields if f.name != "code"])


@query
def memoised_panel(spark, sf_dir):
    """One panel, built by two callers and kept on the executors once."""
    total = F.sum("datavalue").alias("total")
    with src.Memo() as memo:
        sums = [
            memo(panels.customer_spend(spark, sf_dir)).groupBy(F.col(c).alias("part")).agg(total)
            for c in ("topic", "timeperiod")
        ]
        return _once(spark, op.union_by_name(*sums))


@query
def missing_views(spark, sf_dir):
    """A view that is there stays as it is, the other one is created."""
    kept, added = "statpanel_kept", "statpanel_added"
    src.create_or_replace_views({kept: panels.read(spark, sf_dir, "nation")})
    spark.catalog.dropTempView(added)
    builders = {kept: lambda: panels.segments(spark, sf_dir), added: lambda: panels.priorities(spark, sf_dir)}
    made = src.create_missing_views(spark, builders)
    rows = [spark.table(name).select(F.lit(name).alias("view_name")) for name in (kept, added)]
    counts = op.union_by_name(*rows).groupBy("view_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("created", F.col("view_name").isin(made))


@query
def view_catalog(spark, sf_dir):
    base = _once(spark, panels.orders_by_day(spark, sf_dir))
    segments = _once(spark, panels.segments(spark, sf_dir, base))
    types = _once(spark, panels.part_types(spark, sf_dir))
    spending = views.consumer_expenditures(
        panels.with_national(segments), topics=SEGMENT_TOPICS, categories=SEGMENT_CATEGORIES, since=SINCE
    )
    created = {
        "statpanel_expenditures": spending,
        "statpanel_income": _income(*panels.incomes(spark, sf_dir, base)),
        "statpanel_employment": _employment(panels.activity(spark, sf_dir, base)),
        "statpanel_industry": _top_industry(panels.with_national(types)),
    }
    src.create_or_replace_views(created)
    counted = [
        spark.table(name).select(F.lit(name).alias("view_name"))
        .groupBy("view_name").agg(F.count(F.lit(1)).alias("n_rows"))
        for name in src.view_names(spark)
        if name in created
    ]
    columns = src.describe_columns(spark, list(created)).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_columns")
    )
    return op.union_by_name(*counted).join(
        columns, F.col("view_name") == F.col("table_name")
    ).drop("table_name")
