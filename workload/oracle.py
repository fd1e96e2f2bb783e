"""The same results in plain SQL, for an independent engine on the same tables."""

from __future__ import annotations

from workload.data import RUN_ID

ORDERS = """(select * replace (case o_orderpriority when '5-LOW' then null
    when '1-URGENT' then ' ' || chr(9) else o_orderpriority end as o_orderpriority) from orders)"""
CUSTOMER = """(select *, case c_mktsegment when 'BUILDING' then cast(c_acctbal as varchar) || 'd'
    when 'MACHINERY' then null else cast(c_acctbal as varchar) end as balance_text from customer)"""
SETTLED = "(select case when o_orderstatus <> 'P' then o_orderkey end as o_orderkey from orders)"


def _blank(c: str) -> str:
    return f"({c} is null or trim({c}, ' ' || chr(9)) = '')"


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _verdict(rule_id: str, source: str, bad: str) -> str:
    return f"""select '{rule_id}' as rule_id, case when failed = 0 then 'pass' else 'fail' end as status,
        failed, total from (select count(*) filter (where {bad}) as failed, count(*) as total from {source})"""


def _with_top(
    rule_id: str,
    source: str,
    counted: str,
    failed: str,
    allowance: int = 0,
    order: str = "value",
    shown: str = "value, n",
) -> str:
    """A verdict with the 20 most frequent values of ``counted`` (value, n), one row each."""
    return f"""select v.*, t.place, {shown} from (
        select '{rule_id}' as rule_id, case when failed <= {allowance} then 'pass' else 'fail' end as status,
          failed, total from (select cast(coalesce((select {failed} from ({counted})), 0) as bigint) as failed,
          (select count(*) from {source}) as total)) v
      left join (select *, row_number() over (order by n desc, {order}) as place from ({counted})
        qualify row_number() over (order by n desc, {order}) <= 20) t on true"""


def _repeated(column: str, source: str) -> str:
    return f"""select cast({column} as varchar) as value, count(*) as n from {source}
        group by {column} having count(*) > 1"""


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return f"""select cast({column} as varchar) as value, count(*) as n from {child} c
        where {column} is not null and not exists (select 1 from {parent} p where p.{key} = c.{column})
        group by {column}"""


def _checks() -> dict[str, str]:
    sql = {}
    sql["check_schema"] = """select * from (values ('orders', 'fail', 'ts_load'),
        ('lineitem', 'fail', 'L_LINENUMBER'), ('documents', 'pass', '')) t(dataset_id, status, missing_columns)
      join (select 'orders' as dataset_id, count(*) as rows from orders union all
            select 'lineitem', count(*) from lineitem union all
            select 'documents', count(*) from documents) using (dataset_id)"""
    bad = _blank("o_orderpriority")
    parts = []
    for rule_id, column_bad, allowance in (("C001", bad, 0), ("C002", bad, 50), ("C003", "o_totalprice is null", 0)):
        parts.append(
            f"""select '{rule_id}' as rule_id,
              case when failed * 100.0 / total <= {allowance} then 'pass' else 'fail' end as status, failed, total,
              round(cast(failed as double) / total * 100, 6) as null_pct
            from (select count(*) filter (where {column_bad}) as failed, count(*) as total from {ORDERS})"""
        )
    sql["check_completeness"] = _union(parts)
    sql["check_uniqueness"] = _union(
        [
            _with_top("U001", "lineitem", _repeated("l_orderkey", "lineitem"), "sum(n - 1)"),
            _with_top("U002", "lineitem", _repeated("l_extendedprice", "lineitem"), "sum(n - 1)", 10**9),
        ]
    )
    sql["check_uniqueness_suspects"] = _union(
        [sql["check_uniqueness"], _with_top("U003", "pages", _repeated("html", "pages"), "sum(n - 1)", shown="md5(value) as value, n")]
    )
    text = "select text as value, count(*) as n from documents group by text having count(*) > 1"
    ids = "select cast(doc_id as varchar) as value, count(*) as n from documents group by doc_id having count(*) > 1"
    shown = "length(value) as length, md5(value) as value_md5, n"
    sql["check_uniqueness_text"] = _union(
        [
            _with_top("U001", "documents", text, "sum(n - 1)", shown=shown),
            _with_top("U002", "documents", ids, "sum(n - 1)", shown=shown),
        ]
    )
    tailed = "(select repeat('x', 200) || (doc_id % 50) as text, doc_id from documents)"
    long_ones = f"select text as value, count(*) as n from {tailed} group by text having count(*) > 1"
    listed = f"select text as value, count(*) as n from {tailed} where text <> repeat('x', 200) || '7' group by text"
    sql["check_long_texts"] = _union(
        [
            _with_top("U001", "documents", long_ones, "sum(n - 1)"),
            _with_top("D001", "documents", listed, "sum(n)"),
        ]
    )
    number = "try_cast(balance_text as double)"
    sql["check_range"] = _union(
        [
            _verdict("R001", CUSTOMER, "c_acctbal is null or c_acctbal < 0"),
            _verdict("R002", CUSTOMER, "c_acctbal is null or c_acctbal < -1000 or c_acctbal > 10000"),
            _verdict("R003", CUSTOMER, f"{number} is null or {number} < 0 or {number} > 9000"),
            _verdict("R004", CUSTOMER, f"{number} is null"),
            _verdict("R005", CUSTOMER, "c_nationkey is null or c_nationkey > 20"),
        ]
    )

    sql["source_formats"] = """select format, c_mktsegment, count(*) as n, cast(sum(c_custkey) as bigint) as keys,
          round(sum(c_acctbal), 2) as balance
        from customer, (values ('csv'), ('parquet'), ('orc'), ('json'), ('table')) f(format) group by all"""
    sql["run_containment"] = """select 'C001' as rule_id, 'pass' as status, null as error, count(*) as total, 0 as failed from orders
        union all select 'C002', 'fail', 'CAST_INVALID_INPUT', null, null
        union all select 'R001', if(count(*) filter (where o_totalprice > 100000) > 0, 'fail', 'pass'), null, count(*),
          count(*) filter (where o_totalprice > 100000 or o_totalprice is null) from orders"""
    keys = "(select cast(o_orderkey as hugeint) as key from orders)"
    odd = f"(select key from {keys} where key % 2 = 1)"
    sql["check_exact_numbers"] = " union all ".join(
        f"""select '{rule}' as rule_id, case when failed = 0 then 'pass' else 'fail' end as status, failed, total
          from (select {failed} as failed, count(*) as total from {source})"""
        for rule, failed, source in (
            ("R001", "count(*) filter (where key > 100)", keys),
            ("R002", "count(*) filter (where key < 50 or key > 1000)", odd),
            ("D001", "count(*) filter (where key not between 1 and 99)", keys),
            ("U001", "count(*) - count(distinct key)", keys),
            ("K001", f"count(*) filter (where key not in {odd})", keys),
            ("R003", "count(*) filter (where p_size > 25)", "part"),
            ("D002", "count(*) filter (where p_size > 25)", "part"),
            ("K002", "count(*) filter (where key % 2 = 1)", keys),
            ("K003", "count(*) filter (where key % 2 = 1)", keys),
        )
    )

    def invalid(column: str, bad: str) -> str:
        return f"""select cast({column} as varchar) as value, count(*) as n from {ORDERS}
            where {bad} group by {column}"""

    filled = f"not {_blank('o_orderpriority')}"
    sql["check_domain"] = _union(
        [
            _with_top("D001", "orders", invalid("o_orderstatus", "o_orderstatus not in ('F', 'O')"), "sum(n)"),
            _with_top("D002", "orders", invalid("o_orderpriority", f"{filled} and o_orderpriority <> '2-HIGH'"), "sum(n)"),
            _with_top("D003", "orders", invalid("o_orderpriority", filled), "sum(n)"),
            _with_top("D004", "orders", invalid("o_custkey", "o_custkey not in (1, 2, 3)"), "sum(n)"),
        ]
    )
    late = "cast(l_shipdate as date) > date '2000-01-01'"
    sql["check_date_not_in_future"] = _union(
        [_verdict("T001", "lineitem", late), _verdict("T002", "lineitem", f"l_returnflag = 'N' or {late}")]
    )
    sql["check_referential_integrity"] = _union(
        [
            _with_top("K001", "lineitem", _orphans("lineitem", "l_orderkey", SETTLED, "o_orderkey"), "sum(n)"),
            _with_top("K002", "lineitem", _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"), "sum(n)"),
        ]
    )
    sql["check_referential_integrity_documents"] = _union(
        [
            _with_top("K001", "documents", _orphans("documents", "doc_id", "labels", "doc_id"), "sum(n)"),
            _with_top("K002", "labels", _orphans("labels", "doc_id", "documents", "doc_id"), "sum(n)"),
        ]
    )
    age = "(epoch_us(timestamp '2024-02-05') - epoch_us(max(ts))) / 86400000000.0"
    latest = "strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') || '+00:00'"
    aged = [
        f"""select '{rule_id}' as rule_id, case when {age} <= {limit} then 'pass' else 'fail' end as status,
            count(*) as total, round({age}, 4) as age_days, cast(null as varchar) as error, {latest} as latest
            from events"""
        for rule_id, limit in (("F001", 7), ("F002", 5))
    ]
    none = "cast(null as double) as age_days"
    sql["check_freshness"] = _union(
        [
            *aged,
            f"""select 'F003', 'fail', null, {none},
                'Incorrect Freshness requirement: max(age) is less than 0', null""",
            f"select 'F004', 'fail', null, {none}, 'missing_ts_column', null",
            f"""select 'F005', 'fail', count(*), {none}, 'ts_column_not_parseable_or_all_null', null
                from events""",
        ]
    )
    return sql


# --- runs -------------------------------------------------------------------


def _run_rows() -> list[str]:
    """One select per rule of the three rule sets, in order."""
    rows: list[str] = []

    def add(dataset: str, version: int, rule: str, kind: str, severity: str, *, error: str | None = None,
            failed: str = "", allowance: int = 0, total: str = "", status: str = "", source: str = "") -> None:
        head = f"select {len(rows)} as seq, '{RUN_ID}' as run_id, '{dataset}' as dataset_id, {version} as ruleset_version, '{rule}' as rule_id, '{kind}' as rule_type, '{severity}' as severity"
        error_sql = "cast(null as varchar)" if error is None else f"'{error}'"
        if failed:
            verdict = status or f"case when failed <= {allowance} then 'pass' else 'fail' end"
            rows.append(
                f"{head}, {verdict} as status, failed, total, {error_sql} as error from "
                f"(select cast({failed} as bigint) as failed, (select count(*) from {dataset}) as total from {source})"
            )
        else:
            rows.append(
                f"{head}, {status} as status, cast(null as bigint) as failed, cast(null as bigint) as total, "
                f"{error_sql} as error{' from ' + source if source else ''}"
            )

    def bad(predicate: str) -> str:
        return f"count(*) filter (where {predicate})"

    def surplus(column: str, table: str) -> tuple[str, str]:
        return "coalesce(sum(n - 1), 0)", f"({_repeated(column, table)})"

    o, v = "orders", 3
    add(o, v, "G001", "schema", "critical", status="'fail'")
    blank = bad(_blank("o_orderpriority"))
    add(o, v, "C001", "completeness", "high", failed=blank, source=ORDERS,
        status="case when failed * 100.0 / total <= 30 then 'pass' else 'fail' end")
    add(o, v, "C002", "completeness", "high", failed=bad("o_orderkey is null"), source="orders")
    failed, source = surplus("o_orderkey", "orders")
    add(o, v, "U001", "uniqueness", "critical", failed=failed, source=source)
    failed, source = surplus("o_custkey", "orders")
    add(o, v, "U002", "uniqueness", "medium", failed=failed, source=source, allowance=10)
    add(o, v, "R001", "range", "medium", failed=bad("not (o_totalprice between 2000 and 450000.5)"), source="orders")
    add(o, v, "D001", "domain", "high", failed=bad("o_orderstatus not in ('F', 'O')"), source="orders")
    other = f"not {_blank('o_orderpriority')} and o_orderpriority not in ('2-HIGH', '3-MEDIUM')"
    add(o, v, "D002", "domain", "low", failed=bad(other), source=ORDERS)
    add(o, v, "T001", "date_not_in_future", "medium", failed=bad("cast(o_orderdate as date) > date '2024-02-05'"), source="orders")
    old = "(epoch_us(timestamp '2024-02-05') - epoch_us(max(o_orderdate))) / 86400000000.0 <= 10000"
    add(o, v, "F001", "freshness", "high", status=f"case when {old} then 'pass' else 'fail' end", source="orders")
    add(o, v, "X001", "sortedness", "low", status="'fail'", error="unknown_rule_type")
    add(o, v, "C003", "completeness", "medium", status="'fail'", error="missing_column")

    li, v = "lineitem", 1
    orphans = _orphans("lineitem", "l_orderkey", SETTLED, "o_orderkey")
    add(li, v, "K001", "referential_integrity", "critical", failed="coalesce(sum(n), 0)", source=f"({orphans})")
    orphans = _orphans("lineitem", "l_orderkey", "orders", "o_orderkey")
    add(li, v, "K002", "referential_integrity", "high", failed="coalesce(sum(n), 0)", source=f"({orphans})")
    add(li, v, "K003", "referential_integrity", "high", status="'fail'", error="missing_dataset")
    failed, source = surplus("l_orderkey", "lineitem")
    add(li, v, "U001", "uniqueness", "high", failed=failed, source=source)
    add(li, v, "R001", "range", "medium", failed=bad("not (l_quantity between 1 and 45)"), source="lineitem")
    add(li, v, "D001", "domain", "medium", failed=bad("l_linenumber not in (1, 2, 3, 4)"), source="lineitem")
    add(li, v, "D002", "domain", "low", failed=bad("l_returnflag not in ('A', 'N', 'R')"), source="lineitem")

    e, v = "events", 2
    age = "(epoch_us(timestamp '2024-02-05') - epoch_us(max(ts))) / 86400000000.0"
    for rule, severity, limit in (("F001", "critical", 7), ("F002", "high", 2)):
        add(e, v, rule, "freshness", severity, source="events",
            status=f"case when {age} <= {limit} then 'pass' else 'fail' end")
    add(e, v, "F003", "freshness", "high", status="'fail'",
        error="Incorrect Freshness requirement: max(age) is less than 0")
    add(e, v, "F004", "freshness", "low", status="'fail'", error="missing_ts_column")
    add(e, v, "R001", "range", "low", failed=bad("value is null or value > 100"), source="events")
    failed, source = surplus("event_id", "events")
    add(e, v, "U001", "uniqueness", "critical", failed=failed, source=source)
    add(e, v, "D001", "domain", "medium", failed=bad("event_type not in ('click', 'view')"), source="events")
    return rows


RUN = f"run as ({_union(_run_rows())})"
RUN_COLUMNS = "run_id, dataset_id, ruleset_version, rule_id, rule_type, severity, status, failed, total, error"
SUMMARY = """select run_id,
    case when failed_critical > 0 then 'fail' when failed > 0 then 'warn' else 'pass' end as status,
    round(greatest(0.0, 100.0 - 100.0 * (cast(failed as double) / total_rules)), 2) as score,
    total_rules, failed, failed_critical
  from (select run_id, count(*) as total_rules, count(*) filter (where status = 'fail') as failed,
    count(*) filter (where status = 'fail' and severity = 'critical') as failed_critical
    from {0} group by run_id)"""


def _runs() -> dict[str, str]:
    sql = {}
    sql["run_all"] = f"with {RUN} select {RUN_COLUMNS} from run"
    thresholds = {
        "G001": '{"required_columns": ["o_orderkey", "o_orderdate", "ts_load"]}',
        "C001": '{"max_null_percent": 30.0}',
        "C002": '{"max_null_percent": 0.0}',
        "U001": '{"max_duplicates_allowed": 0}',
        "U002": '{"max_duplicates_allowed": 10}',
        "R001": '{"min": 2000, "max": 450000.5}',
        "D001": '{"allowed_values": ["F", "O"]}',
        "D002": '{"allowed_values": ["2-HIGH", "3-MEDIUM"]}',
        "T001": '{"not_in_future": true}',
        "F001": '{"max_age_days": 10000, "ts_column": "o_orderdate"}',
        "X001": "{}",
        "C003": '{"column": "O_ORDERKEY"}',
    }
    listed = ", ".join(f"('{k}', '{v}')" for k, v in thresholds.items())

    def tops(rule: str, column: str, bad: str) -> str:
        return f"""select '{rule}' as rule_id, '{{' || coalesce(string_agg('"' || value || '":' || n, ','
            order by n desc, value), '') || '}}' as top from (select {column} as value, count(*) as n from {ORDERS}
            where {bad} group by {column} order by n desc, value limit 10)"""

    filled = f"not {_blank('o_orderpriority')}"
    sql["run_ruleset"] = f"""with {RUN},
      thresholds(rule_id, threshold) as (values {listed}),
      tops as ({tops("D001", "o_orderstatus", "o_orderstatus not in ('F', 'O')")} union all
        {tops("D002", "o_orderpriority", filled + " and o_orderpriority not in ('2-HIGH', '3-MEDIUM')")})
      select {RUN_COLUMNS}, threshold, case
        when rule_type = 'range' then '{{"failed":' || failed || ',"total":' || total || '}}'
        when rule_type = 'domain' then '{{"failed":' || failed || ',"total":' || total || ',"top_invalid_values":' || top || '}}'
        when rule_type = 'date_not_in_future'
          then '{{"failed":' || failed || ',"total":' || total || ',"today":"2024-02-05"}}' end as payload
      from run left join tops using (rule_id) left join thresholds using (rule_id) where dataset_id = 'orders'"""

    first_ten = (
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus"
    )
    orphan = f"not exists (select 1 from {SETTLED} p where p.o_orderkey = l_orderkey)"
    repeated = "l_orderkey in (select l_orderkey from lineitem group by l_orderkey having count(*) > 1)"
    picks = [
        f"""select 'lineitem' as dataset_id, '{rule}' as rule_id, row_number() over (order by {first_ten}) as position,
            l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity, l_returnflag
            from lineitem where {bad} qualify position <= 100"""
        for rule, bad in (
            ("K001", orphan),
            ("U001", repeated),
            ("R001", "not (l_quantity between 1 and 45)"),
            ("D001", "l_linenumber not in (1, 2, 3, 4)"),
        )
    ]
    sql["bad_samples"] = _union(picks)
    sql["violations_range"] = f"""select c_custkey, c_mktsegment, balance_text from {CUSTOMER}
        where coalesce(try_cast(balance_text as double) < 0, true)"""
    sql["violations_uniqueness"] = """select doc_id, lang, source, n_chars from documents
        where text in (select text from documents group by text having count(*) > 1)"""
    sql["violations_referential_integrity"] = f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber,
        l_extendedprice from lineitem where {orphan}"""
    sql["run_summary"] = f"with {RUN} {SUMMARY.format('run')}"
    sql["sink_summary"] = sql["run_summary"]
    sql["report_kpi"] = f"""with {RUN} select dataset_id, severity, status, count(*) as count from run
        group by dataset_id, severity, status order by dataset_id, severity, status"""
    sql["report_top_failures"] = f"""with {RUN} select dataset_id, rule_id, severity, rule_type,
        cast(null as varchar) as sample_ref, failed, error from run where status = 'fail' order by seq limit 50"""
    sql["report_digest"] = f"""with {RUN}, s as (select run_id,
          case when count(*) filter (where status = 'fail' and severity = 'critical') > 0 then 'FAIL'
               when count(*) filter (where status = 'fail') > 0 then 'WARN' else 'PASS' end as status,
          count(distinct dataset_id) as datasets, count(*) filter (where status = 'fail') as failed
          from run group by run_id)
      select s.run_id, '[DQ] Local run result: ' || s.status || ' | datasets=' || datasets || ' | failed_rules=' || s.failed
        as headline, s.status, row_number() over (order by seq) as place, dataset_id, rule_id, severity, rule_type
      from s join run on s.run_id = run.run_id and run.status = 'fail' qualify place <= 20"""
    policy = """policy(severity, stop_pipeline, notify_channels, create_ado_task) as (values
        ('critical', true, 'teams,email,ado', true), ('high', false, 'teams,email', false),
        ('medium', false, 'teams', false), ('low', false, '', false))"""
    sql["report_actions"] = f"""with {RUN}, {policy} select run_id, dataset_id, rule_id, severity, stop_pipeline,
        create_ado_task, notify_channels from run join policy using (severity) where status = 'fail'"""
    sql["report_run_actions"] = f"""with {RUN}, {policy}, failing as (select * from run join policy using (severity)
          where status = 'fail')
        select run_id, bool_or(stop_pipeline) as stop_pipeline, bool_or(create_ado_task) as create_ado_task,
          (select string_agg(channel, ',' order by channel) from (select distinct channel from
             (select unnest(string_split(notify_channels, ',')) as channel from failing) where channel <> ''))
            as notify_channels from failing group by run_id"""
    sql["report_latest"] = f"with {RUN} {SUMMARY.format('''(select * from run where dataset_id = 'events')''')}"
    sampled = "status = 'fail' and failed > 0 and rule_type <> 'freshness'"
    sql["sink_results"] = f"""with {RUN},
        groups as (select 'orders' as dataset_id, 'U002' as rule_id, coalesce(sum(n), 0) as bad
            from ({_repeated("o_custkey", "orders")}) union all
          select 'lineitem', 'U001', coalesce(sum(n), 0) from ({_repeated("l_orderkey", "lineitem")}) union all
          select 'events', 'U001', coalesce(sum(n), 0) from ({_repeated("event_id", "events")}))
      select dataset_id, rule_id, status, {sampled.replace("failed > 0", "coalesce(failed, 0) > 0")} as sampled,
        cast(case when {sampled} then least(100, coalesce(bad, failed)) else 0 end as bigint) as samples
      from run left join groups using (dataset_id, rule_id)"""
    sql["sink_interrupted_run"] = f"select '{RUN_ID}' as run_id, dataset_id, rule_id, status, samples from ({sql['sink_results']})"
    sql["source_csv"] = """select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey,
        case when c_mktsegment <> 'BUILDING' then c_acctbal end as c_acctbal, c_mktsegment from customer"""
    return sql


# --- profile ----------------------------------------------------------------

PROFILED = {
    "orders": (
        ORDERS,
        [
            ("o_orderkey", "int64"),
            ("o_custkey", "int64"),
            ("o_orderstatus", "object"),
            ("o_totalprice", "float64"),
            ("o_orderdate", "datetime64[ns]"),
            ("o_orderpriority", "object"),
        ],
    ),
    "customer": (
        "(select * replace (case when c_mktsegment <> 'BUILDING' then c_acctbal end as c_acctbal) from customer)",
        [
            ("c_custkey", "int64"),
            ("c_name", "object"),
            ("c_nationkey", "int32"),
            ("c_acctbal", "float64"),
            ("c_mktsegment", "object"),
        ],
    ),
    "part": (
        "(select * replace (case when p_type = 'ECONOMY' then '  ' else p_type end as p_type) from part)",
        [
            ("p_partkey", "int64"),
            ("p_name", "object"),
            ("p_brand", "object"),
            ("p_type", "object"),
            ("p_size", "int32"),
            ("p_retailprice", "float64"),
        ],
    ),
}
LINEITEM = {
    "lineitem": (
        "lineitem",
        [
            ("l_orderkey", "int64"),
            ("l_partkey", "int64"),
            ("l_suppkey", "int64"),
            ("l_linenumber", "int32"),
            ("l_quantity", "float64"),
            ("l_extendedprice", "float64"),
            ("l_discount", "float64"),
            ("l_tax", "float64"),
            ("l_returnflag", "object"),
            ("l_linestatus", "object"),
            ("l_shipdate", "datetime64[ns]"),
        ],
    )
}
# what tables look like that were written as CSV and read back
CSV = {
    "orders": ("orders", PROFILED["orders"][1]),
    "customer": ("customer", [(c, dtype.replace("int32", "int64")) for c, dtype in PROFILED["customer"][1]]),
}
DOCUMENTS = {
    "documents": (
        "documents",
        [
            ("doc_id", "int64"),
            ("text", "object"),
            ("lang", "object"),
            ("source", "object"),
            ("n_chars", "int64"),
        ],
    )
}


def _profile_ctes(tables: dict) -> str:
    """CTEs ``prof`` (a row per column) and ``tops`` (a row per frequent value)."""
    columns, tops = [], []
    for dataset, (source, fields) in tables.items():
        for i, (c, dtype) in enumerate(fields):
            numeric = dtype.startswith(("int", "float"))
            missing = _blank(c) if dtype == "object" else f"{c} is null"
            stats = [f"cast({f}({c}) as double)" if numeric else "cast(null as double)" for f in ("min", "max", "avg")]
            columns.append(
                f"""select '{dataset}' as dataset_id, {i} as ordinal, '{c}' as column_name, '{dtype}' as dtype,
                  count(*) as row_count, count(*) filter (where {missing}) as null_count,
                  count(distinct {c}) as distinct_count,
                  (select max(n) from (select count(*) as n from {source} where {c} is not null group by {c})) as max_dup_count,
                  {stats[0]} as min, {stats[1]} as max, {stats[2]} as mean from {source}"""
            )
            tops.append(
                f"""select '{dataset}' as dataset_id, {i} as ordinal, '{c}' as column_name,
                  row_number() over (order by n desc, key) as place, cast(key as varchar) as value, n
                from (select {c} as key, count(*) as n from {source} where {c} is not null group by {c})
                qualify place <= 10"""
            )
    return f"""base as ({_union(columns)}),
      prof as (select *, row_count - null_count as non_null_count,
        cast(null_count as double) / row_count as null_pct,
        cast(distinct_count as double) / nullif(row_count - null_count, 0) as distinct_ratio_non_null,
        greatest(0, row_count - null_count - distinct_count) as duplicate_count from base),
      tops as ({_union(tops)})"""


PROFILE_COLUMNS = """dataset_id, cast(ordinal as bigint) as ordinal, column_name, dtype, row_count, null_count,
    round(null_pct, 9) as null_pct, distinct_count, non_null_count,
    round(distinct_ratio_non_null, 9) as distinct_ratio_non_null, max_dup_count, duplicate_count, min, max,
    round(mean, 4) as mean"""



def _hits(*patterns: str) -> str:
    """The patterns found in the column name, joined by commas."""
    tests = (f"case when regexp_matches(column_name, '{p}', 'i') then '{p}' end" for p in patterns)
    return f"concat_ws(',', {', '.join(tests)})"


# The score of a key candidate: uniqueness, distinctness, few nulls, name hints.
KEYS = f"""scored as (select *,
      row_count >= 0 and non_null_count >= row_count * 0.85 and null_pct <= 0.02 and distinct_ratio_non_null >= 0.75 as pool,
      duplicate_count = 0 as exact, duplicate_count <= 5000 and cast(duplicate_count as double) / non_null_count <= 0.05 as near,
      {_hits("(^|_)id$", "uuid", "guid", "surrogate", "key")} as positive,
      {_hits("date", "dt", "ts", "status", "type", "code")} as negative
      from prof),
    keyed as (select *, least(1.0, greatest(0.0,
        case when exact then 0.6 when near then 0.4 else 0.0 end
        + 0.2 * least(1.0, greatest(0.0, (distinct_ratio_non_null - 0.85) / (1.0 - 0.85)))
        + 0.1 * least(1.0, greatest(0.0, 1.0 - null_pct / 0.02))
        + case when positive <> '' then 0.1 else 0.0 end
        + case when negative <> '' then -0.2 else 0.0 end)) as confidence from scored where pool),
    keys as (select *, row_number() over (partition by dataset_id order by round(confidence, 12) desc, ordinal) as place
      from keyed where confidence >= 0.55 qualify place <= 3)"""

DATE_NAME = """(contains(column_name, 'date') or contains(column_name, 'dt') or contains(column_name, 'ts')
    or contains(column_name, 'time') or ends_with(column_name, '_at') or ends_with(column_name, '_time')
    or contains(dtype, 'datetime'))"""
CANDIDATES = f"""ranges as (select *, row_number() over (partition by dataset_id order by abs(max - min) desc, ordinal) as place
      from prof where regexp_matches(dtype, 'int|float') and (min is not null or max is not null) qualify place <= 20),
    domains as (select *, row_number() over (partition by dataset_id order by distinct_count, ordinal) as place
      from prof where distinct_count between 1 and 50 qualify place <= 20),
    uniques as (select *, row_number() over (partition by dataset_id order by ordinal) as place
      from prof where distinct_ratio_non_null >= 0.8),
    dates as (select *, row_number() over (partition by dataset_id order by ordinal) as place
      from prof where {DATE_NAME})"""
LISTED = """listed as (select dataset_id, column_name, count(*) as n_listed,
      string_agg(value || ':' || n, '|' order by place) as top_values,
      string_agg('"' || replace(value, chr(9), '\\t') || '"', ',' order by place) as quoted,
      string_agg('[' || replace(value, chr(9), '\\t') || ', ' || n || ']', ', ' order by place) filter (where place <= 5) as shown
      from tops group by dataset_id, column_name)"""
# Heuristic proposals: domains, then dates, then non-negative ranges.
PROPOSALS = f"""offers as (
      select dataset_id, 1 as section, place, 'domain' as rule_type, column_name, 'medium' as severity,
        '{{"allowed_values":[' || quoted || ']}}' as params, 0.7 as confidence,
        'Low cardinality column with ' || n_listed || ' distinct values.' as rationale,
        '["top_values=[' || shown || ']"]' as evidence_used
      from domains join listed using (dataset_id, column_name) where distinct_count <= n_listed
      union all
      select dataset_id, 2, place, 'date_not_in_future', column_name, 'medium', '{{}}', 0.6,
        'Column name/dtype suggests datetime; prevent future dates.', '["dtype=' || dtype || '"]' from dates
      union all
      select dataset_id, 3, place, 'range', column_name, 'low', '{{"min":0}}', 0.6,
        'Observed min=' || min || '; suggest non-negative constraint.',
        '["min=' || min || '","max=' || max || '"]' from ranges where min < 0),
    proposed as (select *, row_number() over (partition by dataset_id order by section, place) as ordinal
      from offers qualify ordinal <= 15)"""


def _profiles() -> dict[str, str]:
    ctes = _profile_ctes(PROFILED)
    sql = {
        "profile_table": f"with {ctes} select {PROFILE_COLUMNS} from prof",
        "profile_top_values": f"with {ctes} select dataset_id, column_name, place, value, n from tops",
        "profile_lineitem": f"with {_profile_ctes(LINEITEM)} select {PROFILE_COLUMNS} from prof",
        "profile_csv": f"with {_profile_ctes(CSV)} select {PROFILE_COLUMNS} from prof",
        "profile_csv_top_values": f"with {_profile_ctes(CSV)} select dataset_id, column_name, place, value, n from tops",
        "profile_documents": f"with {_profile_ctes(DOCUMENTS)} select {PROFILE_COLUMNS} from prof",
    }
    sql["profile_sketched"] = f"""with {_profile_ctes(LINEITEM)} select column_name, cast(ordinal as bigint) as ordinal, dtype, row_count,
        null_count, min, max, round(mean, 4) as mean, distinct_count, true as within_bound from prof"""

    def whole_key(dataset: str, column: str) -> str:
        return f"""select '{dataset}' as dataset_id, '{column}' as column_name, count(*) as row_count,
            count(distinct {column}) as distinct_count,
            (select max(n) from (select count(*) as n from {dataset} where {column} is not null group by {column})) as max_dup_count,
            round(count(distinct {column}) / count({column}), 9) as distinct_ratio_non_null,
            count({column}) - count(distinct {column}) as duplicate_count from {dataset}"""

    sql["profile_sketched_keys"] = _union([whole_key("orders", "o_orderkey"), whole_key("documents", "doc_id"), whole_key("events", "event_id")])
    sql["key_candidates"] = f"""with {ctes}, {KEYS}
      select dataset_id, place, column_name, round(confidence, 9) as confidence, row_count, non_null_count,
        distinct_count, duplicate_count, max_dup_count, positive, negative,
        concat_ws(';', case when not exact and near then 'near-unique (within near-unique thresholds)'
            when not exact then 'duplicates exceed near-unique thresholds' end,
          case when max_dup_count > 1 then 'max_dup_count=' || max_dup_count end) as notes
      from keys"""
    sql["key_rules"] = f"""with {ctes}, {KEYS}
      select dataset_id, (place - 1) * 2 + nth as ordinal, rule_type, column_name, 'high' as severity
      from keys, (values (1, 'uniqueness'), (2, 'completeness')) r(nth, rule_type)"""
    sql["candidates_range"] = f"""with {ctes}, {CANDIDATES} select dataset_id, place, column_name, dtype,
        round(null_pct, 9) as null_pct, min, max, non_null_count from ranges"""
    sql["candidates_domain"] = f"""with {ctes}, {CANDIDATES}, {LISTED} select dataset_id, place, column_name, dtype,
        round(null_pct, 9) as null_pct, distinct_count, top_values
      from domains left join listed using (dataset_id, column_name)"""
    sql["candidates_all"] = f"""with {ctes}, {CANDIDATES}
      select dataset_id, 'range' as rule_type, place, column_name from ranges union all
      select dataset_id, 'domain', place, column_name from domains union all
      select dataset_id, 'completeness', ordinal + 1, column_name from prof union all
      select dataset_id, 'uniqueness', place, column_name from uniques union all
      select dataset_id, 'date_not_in_future', place, column_name from dates"""
    sql["propose_rules"] = f"""with {ctes}, {CANDIDATES}, {LISTED}, {PROPOSALS}
      select dataset_id, ordinal, rule_type, column_name, severity, params, cast(confidence as double) as confidence,
        rationale, evidence_used from proposed"""

    def short(dataset: str, column: str, length: int) -> str:
        return f"""(select '[' || coalesce(string_agg('"' || value || '"', ',' order by place), '') || ']' from tops
            where dataset_id = '{dataset}' and column_name = '{column}' and length(trim(value, ' ' || chr(9))) between 1 and {length})"""

    slots = [
        ("orders", 1, "O001_schema_presence", "schema", "critical", """'{"required_columns":["o_orderkey","o_custkey"]}'"""),
        ("orders", 2, "O002_o_orderkey_unique", "uniqueness", "critical", """'{"column":"o_orderkey","max_duplicates_allowed":0}'"""),
        ("orders", 3, "O003_o_orderkey_not_null", "completeness", "critical", """'{"column":"o_orderkey","max_null_percent":0}'"""),
        ("orders", 4, "O003_o_orderpriority_not_null", "completeness", "high", """'{"column":"o_orderpriority","max_null_percent":0}'"""),
        ("orders", 5, "O010_o_orderpriority_domain", "domain", "high",
         f"""'{{"column":"o_orderpriority","allowed_values":' || {short("orders", "o_orderpriority", 8)} || '}}'"""),
        ("orders", 6, "O011_o_totalprice_range", "range", "high",
         """'{"column":"o_totalprice","min":0,"max":' || (select round(max(o_totalprice) * 1.2, 2) from orders) || '}'"""),
        ("orders", 7, "O012_o_orderdate_not_future", "date_not_in_future", "medium", """'{"column":"o_orderdate"}'"""),
        ("orders", 8, "O003_dataset_is_fresh", "freshness", "critical", """'{"column":"o_orderdate","max_age_days":2,"timezone":"UTC"}'"""),
        ("part", 1, "P001_schema_presence", "schema", "critical", """'{"required_columns":["p_partkey"]}'"""),
        ("part", 2, "P002_p_partkey_unique", "uniqueness", "critical", """'{"column":"p_partkey","max_duplicates_allowed":0}'"""),
        ("part", 3, "P003_p_name_not_null", "completeness", "high", """'{"column":"p_name","max_null_percent":0}'"""),
        ("part", 4, "P010_p_type_domain", "domain", "high",
         f"""'{{"column":"p_type","allowed_values":' || {short("part", "p_type", 12)} || '}}'"""),
        ("part", 5, "P011_p_size_range", "range", "high", """'{"column":"p_size","min":0}'"""),
    ]
    sql["template_rules"] = f"with {ctes} " + _union(
        [
            f"""select '{d}' as dataset_id, cast({n} as bigint) as ordinal, '{rule}' as rule_id, '{kind}' as rule_type,
                '{severity}' as severity, {expectation} as expectation"""
            for d, n, rule, kind, severity, expectation in slots
        ]
    )
    sql["baseline_rules"] = f"""with {ctes}, entries as (select dataset_id,
          string_agg('"' || column_name || '"', ',' order by ordinal) filter (where null_count = 0) as complete,
          min(case when contains(dtype, 'datetime') then column_name end) as ts from prof group by dataset_id)
      select dataset_id, 'schema_0001' as rule_id, 'schema' as rule_type, 'high' as severity,
        '{{"required_columns":[' || case when ts is not null then complete else '"updated_at"' end || ']}}' as expectation,
        'Deterministic schema: required columns from dataset config' as description, 'dataset_config' as suggested_by
      from entries where dataset_id <> 'part'
      union all
      select dataset_id, 'freshness_0001', 'freshness', 'medium', '{{"ts_column":"' || ts || '","max_age_days":2}}',
        'Deterministic freshness: 2 days max age', 'dataset_config' from entries where ts is not null"""

    # Proposals of twelve kinds for every column; what becomes of each kind follows from the rules.
    judged = """listed_n as (select dataset_id, column_name, count(*) as n_listed from tops group by all),
      held as (select *, dtype = 'object' and distinct_count = n_listed as has_domain
        from prof left join listed_n using (dataset_id, column_name)),
      offered as (select held.*, kind, ordinal * 100 + kind as place,
          ['completeness', 'uniqueness', 'uniqueness', 'uniqueness', 'range', 'range', 'range', 'domain', 'domain',
           'monotonic', 'date_not_in_future', 'date_not_in_future'][kind + 1] as rule_type,
          case kind when 2 then null when 8 then upper(column_name) when 11 then '  ' else column_name end as col,
          case when kind = 9 then 'type not allowed: monotonic'
               when null_count > 0 then 'confidence below threshold: 0.4'
               when kind = 2 then 'only single column supported in patch format'
               when kind = 11 then 'missing/invalid column'
               when kind = 8 then 'column not in dataset: ' || upper(column_name)
               when kind = 10 then 'params must be dict'
               when kind = 6 then 'range.params must include min and/or max'
               when kind in (0, 5) or (kind = 7 and has_domain) then 'duplicate rule (signature already exists)'
          end as reason
        from held, (select cast(range as integer) as kind from range(12))),
      counted as (select *, sum(case when reason is null then 1 else 0 end)
          over (partition by dataset_id order by place) as so_far from offered),
      judged as (select * from counted
        where so_far < {cap} or (so_far = {cap} and reason is null))"""
    sql["proposal_guardrails"] = f"""with {ctes}, {judged.format(cap=15)}
      select dataset_id, cast(place as bigint) as ordinal, rule_type,
        case when kind = 1 and null_count > 0 then column_name else col end as column_name,
        case when reason is null then 'accepted' else 'rejected' end as decision, reason as reject_reason from judged"""
    existing = """existing as (select dataset_id, 'completeness' as rule_type, column_name,
          'C' || lpad(cast(ordinal * 2 + 1 as varchar), 3, '0') as rule_id from prof union all
        select dataset_id, 'domain', column_name, 'D' || lpad(cast(ordinal + 1 as varchar), 3, '0')
        from held where has_domain)"""
    sql["merge_rules"] = f"""with {ctes}, {judged.format(cap=12)}, {existing},
      added as (select *, upper(substr(rule_type, 1, 1)) as prefix,
        row_number() over (partition by dataset_id, rule_type order by place) as k from judged where reason is null),
      free as (select dataset_id, prefix, n, row_number() over (partition by dataset_id, prefix order by n) as k
        from (select distinct dataset_id, prefix from added), (select range + 1 as n from range(200))
        where prefix || lpad(cast(n as varchar), 3, '0') not in
          (select rule_id from existing e where e.dataset_id = dataset_id))
      select dataset_id, 5 as ruleset_version, 'suggested' as status, rule_id, rule_type, 'high' as severity,
        column_name, cast(null as varchar) as suggested_by, cast(null as double) as ai_confidence from existing
      union all
      select dataset_id, 5, 'suggested', prefix || lpad(cast(n as varchar), 3, '0'), rule_type, 'medium', column_name,
        'ai_patcher', 0.9 from added join free using (dataset_id, prefix, k)"""
    sql["merge_rules"] = sql["merge_rules"].replace(
        "(select rule_id from existing e where e.dataset_id = dataset_id)",
        "(select e.rule_id from existing e where e.dataset_id = groups.dataset_id)",
    ).replace("from (select distinct dataset_id, prefix from added),", "from (select distinct dataset_id, prefix from added) groups,")
    sql["sink_suggestions"] = f"""with {ctes}, {judged.format(cap=12)}, {existing},
      decided as (select dataset_id, count(*) filter (where reason is null) as accepted,
        count(*) filter (where reason is not null) as rejected from judged group by dataset_id),
      held_rules as (select dataset_id, count(*) as active from existing group by dataset_id)
      select dataset_id, active, active + accepted as suggested, 5 as latest_version, accepted, rejected
      from held_rules join decided using (dataset_id)"""
    sql["registry_current"] = f"""with {ctes}, {judged.format(cap=1)}, {existing}
      select dataset_id, 4 as ruleset_version, 'active' as status, rule_id, rule_type from existing"""
    versions = "(values (4, 'active'), (5, 'suggested'), (6, 'suggested')) v(ruleset_version, status)"
    sql["registry_two_writers"] = f"""with {ctes}, {judged.format(cap=1)}, {existing}
      select dataset_id, ruleset_version, v.status, count(*) as rules, count(distinct rule_id) as rule_ids
      from existing cross join {versions} group by all"""
    sql["validate_rules"] = f"""with {ctes}, {judged.format(cap=1)}
      select dataset_id, 'X' || lpad(cast(place as varchar), cast(greatest(3, length(cast(place as varchar))) as integer), '0') as rule_id,
        case when kind > 0 then rule_type end as rule_type,
        case kind when 0 then 'rule_type is required' when 6 then 'range must have min and/or max'
          when 8 then 'allowed_values is required' when 9 then 'unknown rule type: monotonic'
          when 11 then 'column is required' end as problem
      from offered where kind in (0, 6, 8, 9, 11)"""
    prefixes = "upper(substr(case rule_type when 'date_not_in_future' then 'T' else rule_type end, 1, 1))"
    sql["suggest_rulesets"] = f"""with {ctes}, {KEYS}, {CANDIDATES}, {LISTED}, {PROPOSALS},
      fixed(dataset_id, section, place, rule_id, rule_type, severity, suggested_by, column_name) as (values
        ('orders', 0, 1, 'schema_0001', 'schema', 'high', 'dataset_config', null),
        ('orders', 0, 2, 'freshness_0001', 'freshness', 'medium', 'dataset_config', 'o_orderdate'),
        ('customer', 0, 1, 'schema_0001', 'schema', 'high', 'dataset_config', null)),
      found as (select dataset_id, 1 as section, (place - 1) * 2 + nth as place, rule_type, 'high' as severity,
          'key_detection_engine' as suggested_by, column_name
          from keys, (values (1, 'uniqueness'), (2, 'completeness')) r(nth, rule_type)
        union all
        select dataset_id, 2, ordinal, rule_type, severity, 'ai_patcher', column_name from proposed),
      numbered as (select *, {prefixes} || lpad(cast(row_number() over (partition by dataset_id, {prefixes}
          order by section, place) as varchar), 3, '0') as rule_id from found),
      everything as (select dataset_id, section, place, rule_id, rule_type, severity, suggested_by, column_name from fixed
        union all select dataset_id, section, place, rule_id, rule_type, severity, suggested_by, column_name from numbered)
      select dataset_id, 1 as ruleset_version, 'suggested' as status,
        case dataset_id when 'orders' then 'Sales' else 'UNKNOWN' end as owner_team,
        row_number() over (partition by dataset_id order by section, place) as ordinal,
        rule_id, rule_type, severity, suggested_by, column_name from everything"""
    return sql


ORACLE: dict[str, str] = {**_checks(), **_runs(), **_profiles()}
