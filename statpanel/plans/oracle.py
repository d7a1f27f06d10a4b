"""The registered queries as SQL over the same tables, written independently of the operators."""

from __future__ import annotations

COLUMNS = (
    'code, geofips, geoname, timeperiod, cl_unit, unit_mult, datavalue, noteref, "table", endpoint, topic'
)
SEGMENTS = "['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']"
PRIORITIES = "['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']"
TYPES = "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD']"
NOTE = "case when geofips like '%3' then 'rev \"A\", prelim' end"


def _shape(table: str, endpoint: str, topic: str, unit: str, source: str) -> str:
    return f"""
    select '{table}-' || {endpoint} as code, geofips, geoname, timeperiod, '{unit}' as cl_unit,
        cast(0 as bigint) as unit_mult, datavalue, {NOTE} as noteref, '{table}' as "table",
        {endpoint} as endpoint, {topic} as topic
    from ({source})"""


def _place(values: str, column: str, offset: int = 0) -> str:
    return f"cast(list_position({values}, {column}) + {offset} as varchar)"


_NATION = """lpad(cast(n_nationkey as varchar), 5, '0') as geofips, n_name as geoname,
        cast(year(o_orderdate) as varchar) as timeperiod"""
_NATION_ORDERS = """orders join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey"""
_CUSTOMER = """lpad(cast(c_custkey as varchar), 9, '0') as geofips, c_name as geoname,
        cast(year(o_orderdate) as varchar) as timeperiod"""
_CUSTOMER_ORDERS = "orders join customer on o_custkey = c_custkey"
_TOTAL = "cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint)"
_FINISHED = """cast(sum(case when o_orderstatus = 'F' then cast(round(o_totalprice * 100) as bigint)
        else 0 end) as bigint)"""

SEG = _shape(
    "SEG1",
    _place(SEGMENTS, "seg"),
    "'Order value: ' || seg",
    "cents",
    f"select {_NATION}, c_mktsegment as seg, {_TOTAL} as datavalue from {_NATION_ORDERS} group by all",
)
PRI = _shape(
    "PRI1",
    _place(PRIORITIES, "pri"),
    "pri",
    "orders",
    f"select {_NATION}, o_orderpriority as pri, count(*) as datavalue from {_NATION_ORDERS} group by all",
)
CUS = _shape(
    "CUS1",
    _place(PRIORITIES, "pri"),
    "'Order value: ' || pri",
    "cents",
    f"select {_CUSTOMER}, o_orderpriority as pri, {_TOTAL} as datavalue from {_CUSTOMER_ORDERS} group by all",
)
CUN = _shape(
    "CUS2",
    _place(PRIORITIES, "pri"),
    "pri",
    "orders",
    f"select {_CUSTOMER}, o_orderpriority as pri, count(*) as datavalue from {_CUSTOMER_ORDERS} group by all",
)


def _activity(table: str, entity: str, source: str, active: str) -> str:
    def one(topic: str, measure: str) -> str:
        return f"select {entity}, '{topic}' as t, {measure} as datavalue from {source} group by all"

    both = f"{one('Total orders', 'count(*)')} union all {one('Active customers', active)}"
    return _shape(table, _place("['Total orders', 'Active customers']", "t"), "t", "count", both)


ACT = _activity("ACT1", _NATION, _NATION_ORDERS, "count(distinct o_custkey)")
ACU = _activity("ACT2", _CUSTOMER, _CUSTOMER_ORDERS, "count(distinct cast(o_orderdate as date))")


def _incomes(entity: str, source: str, per: str, table: str) -> tuple[str, str]:
    def one(n: int, measure: str, topic: str) -> str:
        rows = f"select {entity}, {measure} / {per} as datavalue from {source} group by all"
        return _shape(f"{table}{n}", "'1'", f"'{topic}'", "cents per customer", rows)

    return (
        one(1, _FINISHED, "Per customer disposable order value"),
        one(2, _TOTAL, "Per customer personal order value"),
    )


INC = _incomes(_NATION, _NATION_ORDERS, "count(distinct o_custkey)", "INC")
CIN = _incomes(_CUSTOMER, _CUSTOMER_ORDERS, "count(*)", "CIN")


def _types(table: str, entity: str, source: str) -> str:
    revenue = "cast(sum(cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint)) as bigint)"
    rows = f"""
    select {entity}, cast(year(l_shipdate) as varchar) as timeperiod, p_type as t, {revenue} as datavalue
    from {source} group by all
    union all
    select {entity}, cast(year(l_shipdate) as varchar) as timeperiod, null as t, {revenue} as datavalue
    from {source} group by all"""
    endpoint = f"coalesce({_place(TYPES, 't', 10)}, '1')"
    topic = f"""coalesce('Revenue by type: ' || t || ' (' || {_place(TYPES, 't', 10)} || ')',
        'All types total')"""
    return _shape(table, endpoint, topic, "cents", rows)


_LINES = "lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey"
TYP = _types(
    "TYP1",
    "lpad(cast(n_nationkey as varchar), 5, '0') as geofips, n_name as geoname",
    f"{_LINES} join nation on s_nationkey = n_nationkey",
)
TYS = _types("TYP2", "lpad(cast(s_suppkey as varchar), 9, '0') as geofips, s_name as geoname", _LINES)


def _national(panel: str, mark: str = "") -> str:
    return f"""
    select code, '99999' as geofips, 'ALL NATIONS{mark}' as geoname, timeperiod, cl_unit, unit_mult,
        cast(sum(datavalue) as bigint) as datavalue, cast(null as varchar) as noteref, "table", endpoint, topic
    from ({panel}) group by all"""


def _with_national(panel: str, mark: str = "") -> str:
    return f"{panel} union all {_national(panel, mark)}"


MARKED = f"""
    {SEG} union all {_national(SEG, " *")} union all
    select code, 'R' || lpad(cast(r_regionkey as varchar), 4, '0') as geofips, r_name as geoname, timeperiod,
        cl_unit, unit_mult, cast(sum(datavalue) as bigint) as datavalue, cast(null as varchar) as noteref,
        "table", endpoint, topic
    from ({SEG}) join nation on geoname = n_name join region on n_regionkey = r_regionkey group by all"""

DIC = f"""
    select case when p_size = 1 then k || '(s)' else k end as "Key",
        '[TYP1] Revenue by type: ' || p_type || ' (' || k || ')' as "Desc"
    from (select p_type, p_size, {_place(TYPES, "p_type", 10)} as k from part)"""
DICTIONARY = f"""
    select "Key", substr("Desc", 8) as "Desc", 'TYP1' as "table" from ({DIC})"""


_TABLES_BY_KEY = f"""
    select "Key", substr("Desc", 8) as "Desc", 'TYP' || substr("Key", 2, 1) as "table" from ({DIC})"""


def _gaps(panel: str) -> str:
    return f"select * from ({panel}) where cast(timeperiod as int) % 7 <> cast(geofips as int) % 7"


def _pct(value: str, prev: str) -> str:
    return f"round(100 * ({value} - {prev}) / nullif({value}, 0), 2)"


def _changes(panel: str) -> str:
    prev = "lag(datavalue) over (partition by geoname, topic order by timeperiod)"
    return f"""
    select *, {_pct("datavalue", "prev")} as change
    from (select geoname, topic, timeperiod, datavalue, {prev} as prev from ({panel}))"""


def _expenditure(panel: str, topics: list[str], category: str) -> str:
    listed = ", ".join(f"'Order value: {t}'" for t in topics)
    return f"""
    with spent as (
        select geoname as state, timeperiod as year, datavalue as spend, topic,
            lag(datavalue) over (partition by geoname, topic order by timeperiod) as prev_year_spend
        from ({panel}) where topic in ({listed}) and timeperiod >= '1997'),
    changed as (
        select *, {_pct("spend", "prev_year_spend")} as spend_change,
            case {category} end as consumer_expenditure
        from spent)
    select state, year, spend, prev_year_spend, spend_change,
        dense_rank() over (
            partition by year, consumer_expenditure order by spend_change desc nulls last) as change_rank,
        consumer_expenditure
    from changed"""


def _income(panels: tuple[str, str]) -> str:
    def one(panel: str, word: str) -> str:
        return f"""
        select geoname as state, timeperiod as year, datavalue as income, topic from ({panel})
        where topic = 'Per customer {word} order value' and cast(timeperiod as int) >= 1997"""

    return f"""
    with all_income as ({one(panels[0], "disposable")} union {one(panels[1], "personal")}),
    lagged as (
        select *, lag(income) over (partition by state, topic order by year) as prev_year_income
        from all_income),
    changed as (
        select *, {_pct("income", "prev_year_income")} as income_change,
            case when topic like '%disposable%' then 'disposable income'
                when topic like '%personal%' then 'personal income' end as income_type
        from lagged)
    select state, year, income, prev_year_income, income_change,
        dense_rank() over (
            partition by year, income_type order by income_change desc nulls last) as change_rank,
        income_type
    from changed"""


def _employment(panel: str) -> str:
    return f"""
    with act as ({panel})
    select e.geoname as state, e.timeperiod as year, e.datavalue as employment, p.datavalue as population,
        e.topic
    from act e join act p on e.geoname = p.geoname and e.timeperiod = p.timeperiod
    where e.topic = 'Total orders' and p.topic = 'Active customers' and cast(e.timeperiod as int) >= 1997"""


def _industry(panel: str) -> str:
    return f"""
    with comp as (
        select * from ({panel}) where geoname <> 'ALL NATIONS' and topic <> 'All types total'),
    ranked as (
        select geoname, timeperiod, topic,
            dense_rank() over (partition by geoname, timeperiod order by datavalue desc nulls last) as r
        from comp)
    select c.geoname as state, c.timeperiod as year, c.datavalue as compensation, c.topic as industry,
        t.topic as top_industry
    from comp c join ranked t on c.geoname = t.geoname and c.timeperiod = t.timeperiod where t.r = 1"""


_SEGMENT_CASE = """when topic like '%FURNITURE%' then 'furniture' when topic like '%AUTO%' then 'automobile'
                when topic like '%HOUSE%' then 'household'"""
_PRIORITY_CASE = """when topic like '%URGENT%' then 'urgent' when topic like '%HIGH%' then 'high'
                when topic like '%-%' then 'normal'"""


def _bad_periods(panel: str) -> str:
    return f"""
    select * replace (
        case when geofips like '%7' and timeperiod = '1998' then '(NA)' else timeperiod end as timeperiod)
    from ({panel})"""


_DAMAGED = f"""
    select case when geofips like '0000%' and length(geofips) = 9 then 'customers' else 'others' end
            as dataset,
        nullif(code, 'CUS1-4') as code, geofips, nullif(geoname, 'NATION_3') as geoname, timeperiod,
        case when timeperiod <> '1996' then "table" end as "table", endpoint,
        nullif(topic, 'Order value: BUILDING') as topic
    from ({_bad_periods(f"{SEG} union all {CUS}")})"""


def _report(measures: dict[str, str], passed: str, source: str) -> str:
    return " union all ".join(
        f"""select dataset, '{name}' as "check", cast({measure} as bigint) as observed,
            {measure} {passed} as passed from ({source}) group by dataset"""
        for name, measure in measures.items()
    )


_NULL_KEY = """code is null or geofips is null or geoname is null or timeperiod is null or "table" is null
        or endpoint is null or topic is null"""


def _enriched(panel: str, table: str) -> str:
    return f"""
    with dims as (
        select distinct '{table}' as "table", "Key" as endpoint,
            regexp_replace(regexp_replace("Desc", 'Revenue by type: ', ''), ' \\(\\d.+\\)$', '') as topic
        from ({DICTIONARY}))
    select f.code, geofips, case when geoname = 'ALL NATIONS *' then 'ALL NATIONS' else geoname end as geoname,
        timeperiod, cl_unit, unit_mult, datavalue, noteref, d."table", d.endpoint, d.topic
    from ({panel}) f
    join dims d on split_part(f.code, '-', 1) = d."table" and split_part(f.code, '-', 2) = d.endpoint"""


_NAMES = """
    select 'ALL NATIONS *' as geoname union all
    select n_name from nation where n_nationkey < 20 union all select 'NATION_24'"""
_LANDED = f"""
    select code, geoname from ({MARKED}) union all
    select code, geoname from ({PRI} union all {ACT} union all {ACU})"""

_LOADED = f"""
    select case "table" when 'TYP1' then 'statpanel_nation_types' else 'statpanel_supplier_types' end
            as dataset, *
    from ({TYP} union all {TYS}) where endpoint in (select "Key" from ({DIC}))"""

VIEWS = {
    "view_expenditure_change": _expenditure(
        _with_national(SEG), ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"], _SEGMENT_CASE
    ),
    "view_income_change": _income(INC),
    "view_employment_population": _employment(ACT),
    "view_top_industry": _industry(_with_national(TYP)),
}

ORACLE = {
    **VIEWS,
    "view_expenditure_change_customers": _expenditure(
        CUS, ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"], _PRIORITY_CASE
    ),
    "view_income_change_customers": _income(CIN),
    "view_employment_population_customers": _employment(ACU),
    "view_top_industry_suppliers": _industry(TYS),
    "view_top_priority_ties": _industry(PRI),
    "view_top_priority_ties_customers": _industry(CUN),
    "lag_previous_period": f"select * exclude (change) from ({_changes(_gaps(SEG))})",
    **dict.fromkeys(
        ("lag_previous_period_chunked", "lag_previous_period_ranges", "lag_on_bucketed_table"),
        f"select * exclude (change) from ({_changes(CUS)})",
    ),
    "pct_change_current_base": f"select * exclude (prev) from ({_changes(SEG)})",
    "dense_rank_change": f"""
        select *, dense_rank() over (
            partition by timeperiod, topic order by change desc nulls last) as change_rank
        from ({_changes(_gaps(SEG))})""",
    "dense_rank_value_customers": f"""
        select geoname, topic, timeperiod, datavalue,
            dense_rank() over (partition by timeperiod order by datavalue desc) as value_rank
        from ({CUS})""",
    "top_per_group": f"""
        select * from ({PRI})
        qualify dense_rank() over (partition by geoname, timeperiod order by datavalue desc) = 1""",
    "top_two_per_group_customers": f"""
        select * from ({CUN})
        qualify dense_rank() over (partition by timeperiod, topic order by datavalue desc) <= 2""",
    "align_topics_pivot": f"""
        with act as ({ACT})
        select a.geoname, a.timeperiod, a.datavalue as orders, b.datavalue as customers
        from act a join act b on a.geoname = b.geoname and a.timeperiod = b.timeperiod
        where a.topic = 'Total orders' and b.topic = 'Active customers'""",
    "union_distinct": """
        select o_custkey as custkey, o_orderstatus as tag from orders
        union select c_custkey, c_mktsegment from customer""",
    "union_by_name_missing": f"{SEG} union all by name (select * exclude (noteref) from ({PRI}))",
    "symmetric_difference": """
        with c as (
            select distinct c_nationkey as nation, cast(floor(c_acctbal / 100) as bigint) as band from customer),
        s as (
            select distinct s_nationkey as nation, cast(floor(s_acctbal / 100) as bigint) as band from supplier)
        (select * from c except select * from s) union all (select * from s except select * from c)""",
    "first_wins_merge": f"""
        with panel as (select code, geofips, timeperiod, datavalue from ({CUS})),
        kept as ({_gaps("select * from panel")})
        select * from kept union all
        select code, geofips, timeperiod, datavalue * 2 from panel
        where (code, geofips, timeperiod) not in (select (code, geofips, timeperiod) from kept)""",
    "strip_annotation": """
        select 'ALL NATIONS *' as geoname union all
        (select c_name from customer order by c_custkey limit 50) union all
        (select s_name from supplier order by s_suppkey limit 1)""",
    "semi_join_names": f"select * from ({MARKED}) where geoname in (select geoname from ({_NAMES}))",
    "strip_annotation_all": "select c_name as geoname from customer union all select s_name from supplier",
    "semi_join_values": f"""
        select * from ({_TABLES_BY_KEY}) d
        where exists (select 1 from ({TYS}) f where d."table" = 'TYP' || substr(f.timeperiod, 4, 1))""",
    "csv_dictionary": _TABLES_BY_KEY,
    "database_export_restore": """
        select c_custkey as id, '  ' || c_name || ' ' || chr(9) as padded,
            c_mktsegment || chr(10) || 'second "line", ' || chr(39) || 'quoted' || chr(39) as broken,
            nullif(c_mktsegment, 'BUILDING') as segment, c_acctbal as balance, c_acctbal > 0 as rich,
            cast((select count(*) from nation) as int) as nations
        from customer""",
    "json_discovery": f"select *, 'nation types+1' as dataset from ({TYP})",
    "memoised_panel": f"""
        select topic as part, cast(sum(datavalue) as bigint) as total from ({CUS}) group by all union all
        select timeperiod as part, cast(sum(datavalue) as bigint) as total from ({CUS}) group by all""",
    "missing_views": f"""
        select 'statpanel_kept' as view_name, count(*) as n_rows, false as created from nation union all
        select 'statpanel_added', count(*), true from ({PRI})""",
    "rank_fractional_customers": f"""
        select geoname, timeperiod, datavalue,
            dense_rank() over (partition by timeperiod order by datavalue desc) as value_rank
        from ({CIN[1]})""",
    "geo_normalise": f"select * replace (replace(geoname, ' *', '') as geoname) from ({MARKED})",
    "like_case_category": f"""
        select code, geofips, timeperiod, case {_SEGMENT_CASE} end as category from ({SEG})""",
    "in_not_in_filter": f"""
        select * from ({TYS}) where timeperiod in ('1998', '1999') and topic not in ('All types total')
            and endpoint <> '12' and "table" = 'TYP2'""",
    "year_lower_bound": f"""
        select *, timeperiod >= '1999' as from_1999 from ({_bad_periods(CUS)})
        where try_cast(timeperiod as int) >= 1997""",
    "sorted_panel": CUS,
    "any_null_count": _report(
        {
            "null_records": f"count(*) filter (where {_NULL_KEY})",
            "non_numeric_periods": "count(*) filter (where timeperiod = '(NA)')",
        },
        "= 0",
        _DAMAGED,
    ),
    "entity_coverage": _report(
        {"geofips_count": "count(distinct geofips)", "geoname_count": "count(distinct geoname)"},
        ">= 50",
        _DAMAGED,
    ),
    "repeated_keys": _report(
        {"repeated_keys": "count(*) filter (where n > 1)"},
        "= 0",
        f"select dataset, geoname, timeperiod, topic, count(*) as n from ({_DAMAGED}) group by all",
    ),
    "sentinel_codes": _report(
        {"sentinel_records": "count(*) filter (where code = 'SEG1-1')"}, "> 0", _DAMAGED
    ),
    "unmatched_codes": _report(
        {"unmatched_codes": "count(distinct code) filter (where not known)"},
        "= 0",
        f"""select "table" as dataset, code,
            ("table", endpoint) in (select ("table", "Key") from ({DICTIONARY})) as known
        from ({TYP} union all {TYS})""",
    ),
    "distinct_rows": f"select distinct * from ({DIC})",
    "distinct_values": f'select distinct "Key" from ({DIC})',
    "dictionary_prepare": DICTIONARY,
    "request_manifest": f"""
        select distinct 'TYP1' as "table", "Key" as line_code, 'TYP1-' || "Key" as code
        from ({DIC}) where "Key" not like '%(%'""",
    "code_split": f"""select distinct code, "table", endpoint from ({TYS})""",
    "topic_clean": f"""
        select distinct 'TYP1' as "table", "Key" as endpoint,
            regexp_replace(substr("Desc", 25), ' \\(\\d\\d\\)$', '') as topic
        from ({DIC})""",
    "enrich_observations": _enriched(_with_national(TYP, " *"), "TYP1"),
    "enrich_observations_suppliers": _enriched(TYS, "TYP2"),
    "route_datasets": f"""
        select case split_part(code, '-', 1) when 'SEG1' then 'segments' when 'PRI1' then 'priorities'
                when 'ACT1' then 'activity' else '_unrouted' end as dataset,
            count(*) as n_rows
        from ({_LANDED}) where geoname not in ('ASIA', 'EUROPE') group by 1""",
    "load_and_check": _report(
        {
            "null_records": "count(*) filter (where geoname is null)",
            "non_numeric_periods": "count(*) filter (where try_cast(timeperiod as int) is null)",
            "null_values": "count(*) filter (where datavalue is null)",
            "repeated_keys": "count(*) - count(distinct (geoname, timeperiod, topic))",
        },
        "= 0",
        _LOADED,
    )
    + " union all "
    + _report({"sentinel_records": "count(*) filter (where code in ('TYP1-11', 'TYP2-1'))"}, "> 0", _LOADED)
    + f"""
    union all select '_unrouted', 'unrouted_records', count(*), count(*) = 0 from ({PRI})
    union all
    select case "table" when 'TYP1' then 'statpanel_nation_types' else 'statpanel_supplier_types' end,
        'unmatched_codes', count(distinct code) filter (where endpoint not in (select "Key" from ({DIC}))),
        count(distinct code) filter (where endpoint not in (select "Key" from ({DIC}))) = 0
    from ({TYP} union all {TYS}) group by "table"
    """
    + " union all "
    + _report(
        {"geofips_count": "count(distinct geofips)", "geoname_count": "count(distinct geoname)"},
        ">= 50",
        _LOADED,
    ),
    "json_columnar_roundtrip": f"select *, 'types' as dataset from ({TYS})",
    "csv_roundtrip": TYS,
    "table_ctas": CUS,
    **dict.fromkeys(("fetch_manifest", "landed_responses"), f"""
        select code, geofips, geoname, timeperiod, cl_unit, unit_mult, datavalue, noteref
        from ({TYP}) where code in (
            select 'TYP1-' || "Key" from ({DIC}) where "Key" not like '%(%')"""),
    "fetch_chosen": f"""
        select code, geofips, geoname, timeperiod, cl_unit, unit_mult, datavalue, noteref
        from ({TYP}) where code in ('TYP1-11', 'TYP1-13')""",
    "view_catalog": " union all ".join(
        f"""select '{name}' as view_name, cast({width} as bigint) as n_columns, count(*) as n_rows
            from ({VIEWS[key]})"""
        for name, key, width in (
            ("statpanel_expenditures", "view_expenditure_change", 7),
            ("statpanel_income", "view_income_change", 7),
            ("statpanel_employment", "view_employment_population", 5),
            ("statpanel_industry", "view_top_industry", 5),
        )
    ),
}
