"""DuckDB SQL of every registered query -- the correctness oracle.

The oracle states each operator the plain SQL way (window ranks, LAG,
NOT EXISTS), independent of the aggregate-based Spark plans, over the same
test tables (pre-registered views).  Builders return SELECT text; larger
queries nest smaller ones as derived tables.
"""

from __future__ import annotations

from vaultspark.operators import quality
from vaultspark.operators.staging import EARLY_PAYMENT, MDM, SPECS, StageSpec
from vaultspark.sources.fixtures import SQL as RAW

# --- hash recipe ---------------------------------------------------------------------


def _norm(x: str) -> str:
    return f"nullif(upper(trim(cast({x} as varchar))), '')"


def _parts(xs) -> str:
    return ", ".join(f"coalesce({_norm(x)}, '^^')" for x in xs)


def hkey(xs) -> str:
    if len(xs) == 1:
        return f"md5({_norm(xs[0])})"
    empty = "||".join(["^^"] * len(xs))
    return f"md5(nullif(concat_ws('||', {_parts(xs)}), '{empty}'))"


def hdiff(xs) -> str:
    return f"md5(concat_ws('||', {_parts(xs)}))"


def _ts(year: int) -> str:
    return f"TIMESTAMP '{year:04d}-01-01 00:00:00'"


def _d(year: int) -> str:
    return f"DATE '{year:04d}-01-01'"


# --- ODS ---------------------------------------------------------------------------------

def _year_filter(col: str, year: int | None, kind: str) -> str:
    if year is None:
        return ""
    lo, hi = (_d(year), _d(year + 1)) if kind == "date" else (_ts(year), _ts(year + 1))
    return f" where {col} >= {lo} and {col} < {hi}"


def ods_sql(src: str, year: int | None) -> str:
    r = f"({RAW[src]})"
    if src == "billing":
        return ("select user_id, cast(strptime(billing_period, '%Y-%m') as date) billing_period, "
                "service, tariff, cast(sum as integer) sum, cast(created_at as date) created_at "
                f"from {r} s" + _year_filter("created_at", year, "date"))
    if src == "issue":
        return ("select cast(user_id as integer) user_id, start_time, end_time, title, description, "
                f"service from {r} s" + _year_filter("start_time", year, "ts"))
    if src == "payment":
        return ("select user_id, pay_doc_type, pay_doc_num, account, phone, "
                "cast(strptime(billing_period, '%Y-%m') as date) billing_period, pay_date, "
                f"cast(sum as integer) sum from {r} s" + _year_filter("pay_date", year, "date"))
    if src == "traffic":
        where = ""
        if year is not None:
            lo = f"epoch_ms({_ts(year)})"
            hi = f"epoch_ms({_ts(year + 1)})"
            where = f' where "timestamp" >= {lo} and "timestamp" < {hi}'
        return ('select user_id, make_timestamp("timestamp" * 1000) "timestamp", device_id, '
                "device_ip_addr, cast(bytes_sent as bigint) bytes_sent, "
                f"cast(bytes_received as bigint) bytes_received from {r} s" + where)
    if src == "user":
        return ("select id user_id, legal_type, district, cast(registered_at as date) registered_at, "
                f"billing_mode, is_vip from {r} s")
    raise KeyError(src)


def _trunc_int(x: str, target: str = "integer") -> str:
    return f"try_cast(trunc(try_cast({x} as decimal(38,9))) as {target})"


def ods_hive_sql(src: str, year: int) -> str:
    r = f"({RAW[src]})"
    if src == "billing":
        return (f"select {_trunc_int('user_id')} user_id, try_cast(concat(billing_period, '-01') as date) "
                f"billing_period, service, tariff, {_trunc_int('sum')} sum, try_cast(created_at as date) "
                f"created_at from {r} s" + _year_filter("created_at", year, "date"))
    if src == "issue":
        return (f"select {_trunc_int('user_id')} user_id, start_time, end_time, title, description, "
                f"service from {r} s" + _year_filter("start_time", year, "ts"))
    if src == "payment":
        return (f"select {_trunc_int('user_id')} user_id, pay_doc_type, {_trunc_int('pay_doc_num')} "
                "pay_doc_num, account, try_cast(phone as decimal(11,0)) phone, "
                "try_cast(concat(billing_period, '-01') as date) billing_period, "
                f"try_cast(pay_date as date) pay_date, {_trunc_int('sum')} sum from {r} s"
                + _year_filter("pay_date", year, "date"))
    if src == "traffic":
        octs = [f"try_cast(split_part(device_ip_addr, '.', {k}) as bigint)" for k in (1, 2, 3, 4)]
        v = f"({octs[0]} * 16777216 + {octs[1]} * 65536 + {octs[2]} * 256 + {octs[3]})"
        signed = (f"cast(case when ({v} % 4294967296 + 4294967296) % 4294967296 >= 2147483648 "
                  f"then ({v} % 4294967296 + 4294967296) % 4294967296 - 4294967296 "
                  f"else ({v} % 4294967296 + 4294967296) % 4294967296 end as integer)")
        lo, hi = f"epoch_ms({_ts(year)})", f"epoch_ms({_ts(year + 1)})"
        return (f'select {_trunc_int("user_id")} user_id, make_timestamp(cast("timestamp" as bigint) * 1000) '
                f'"timestamp", device_id, {signed} device_ip_addr, cast(bytes_sent as bigint) bytes_sent, '
                f"cast(bytes_received as bigint) bytes_received from {r} s "
                f'where "timestamp" >= {lo} and "timestamp" < {hi}')
    raise KeyError(src)


def partition_label_sql(col: str) -> str:
    y = f"year({col})"
    return (f"case when {y} >= 2000 and {y} < 2013 then 'before_2013' "
            f"when {y} >= 2013 and {y} <= 2030 then cast({y} as varchar) else 'badyear' end")


# --- staging ------------------------------------------------------------------------------

def _text(spec: StageSpec, c: str) -> str:
    q = f'"{c}"'
    if c in spec.text_forms:  # INET text of a bare host carries /32 or /128
        return f"(case when contains({q}, '/') then {q} when contains({q}, ':') then {q} || '/128' else {q} || '/32' end)"
    return q


def stage_sql(spec: StageSpec, ods_select: str, year: int) -> str:
    t = lambda c: _text(spec, c)
    cols = [f'"{c}"' for c in spec.columns]
    for name, cs in spec.keys:
        parts = [f"cast({t(c)} as varchar)" for c in cs]
        key = parts[0] if len(parts) == 1 else f"concat_ws('{spec.key_separator}', {', '.join(parts)})"
        cols.append(f"{key} as {name}")
    cols.append(f"'{spec.record_source}' as RECORD_SOURCE")
    cols += [f"{hkey([t(c) for c in cs])} as {n}" for n, cs in spec.hash_keys]
    cols += [f"{hdiff([t(c) for c in cs])} as {n}" for n, cs in spec.hash_diffs]
    cols.append(f"{_ts(year)} as LOAD_DATE")
    eff = f'"{spec.effective_from}"'
    if spec.effective_from_type:
        eff = f"cast({eff} as timestamp)"
    cols.append(f"{eff} as EFFECTIVE_FROM")
    return f"select {', '.join(cols)} from ({ods_select}) o"


def staged(src: str, year: int) -> str:
    """Staging of one source for a batch year (mdm: whole table, stamped with the year)."""
    if src == "mdm":
        return stage_sql(MDM, ods_sql("user", None), year)
    if src == "early_payment":
        return stage_sql(EARLY_PAYMENT, ods_sql("payment", year), year)
    return stage_sql(SPECS[src], ods_sql(src, year), year)


def staged_all_years(src: str, years) -> str:
    return " union all ".join(f"({staged(src, y)})" for y in years)


# --- vault --------------------------------------------------------------------------------

HUB_SOURCES = {"user": ("payment", "mdm", "billing", "issue", "traffic"), "account": ("payment",),
               "billing_period": ("payment", "billing"), "pay_doc_type": ("payment",)}


def hub_sql(name: str, year: int, target: str | None = None, sources=None) -> str:
    p = name.upper()
    pk, key = f"{p}_PK", f"{p}_KEY"
    srcs = sources or HUB_SOURCES[name]
    union = " union all ".join(f"select {pk}, {key}, LOAD_DATE, RECORD_SOURCE from ({staged(s, year)}) s"
                               for s in srcs)
    where = f"where {pk} is not null" if len(srcs) > 1 else ""
    ranked = (f"select *, row_number() over (partition by {pk} order by LOAD_DATE, RECORD_SOURCE, "
              f"{key} nulls first) rn from ({union}) u {where}")
    out = f"select {pk}, {key}, LOAD_DATE, RECORD_SOURCE from ({ranked}) r where rn = 1"
    if target:
        out += f" and not exists (select 1 from ({target}) t where t.{pk} = r.{pk})"
    return out


LINK_FKS = ["USER_PK", "ACCOUNT_PK", "BILLING_PERIOD_PK", "PAY_DOC_TYPE_PK"]


def link_sql(stg: str, target: str | None = None, pk: str = "PAYMENT_PK", fks=None) -> str:
    cols = ", ".join([pk, *(fks or LINK_FKS), "LOAD_DATE", "RECORD_SOURCE"])
    out = f"select distinct {cols} from ({stg}) s"
    if target:
        out += f" where not exists (select 1 from ({target}) t where t.{pk} = s.{pk})"
    return out


def sat_sql(src: str, pk: str, hd: str, payload: list[str], year: int,
            target: str | None = None) -> str:
    cols = ", ".join([pk, hd, *payload, "EFFECTIVE_FROM", "LOAD_DATE", "RECORD_SOURCE"])
    out = f"select distinct {cols} from ({src}) s"
    if target:
        latest = (f"select {pk}, {hd} from (select {pk}, {hd}, rank() over (partition by {pk} "
                  f"order by LOAD_DATE desc) rk from ({target}) h where LOAD_DATE <= {_ts(year)}) x "
                  "where rk = 1")
        out += (f" where not exists (select 1 from ({latest}) l where l.{pk} = s.{pk} "
                f"and l.{hd} = s.{hd})")
    return out


def sat_payment_src(year: int) -> str:
    return (f"select PAYMENT_PK, PAY_DOC_HASHDIFF, pay_doc_num, pay_date, sum, EFFECTIVE_FROM, "
            f"LOAD_DATE, RECORD_SOURCE from ({staged('payment', year)}) p")


def sat_mdm_src(year: int) -> str:
    return (f"select MDM_PK, MDM_HASHDIFF, cast(registered_at as timestamp) registered_at, is_vip, "
            f"cast(EFFECTIVE_FROM as timestamp) EFFECTIVE_FROM, LOAD_DATE, RECORD_SOURCE "
            f"from ({staged('mdm', year)}) m")


def sat_user_src(year: int, src: str = "payment") -> str:
    lagged = (f"select *, lag(phone) over (partition by USER_PK order by EFFECTIVE_FROM asc nulls last, "
              f"pay_doc_num asc nulls last) prev_phone from ({staged(src, year)}) p")
    return f"select * from ({lagged}) l where phone is distinct from prev_phone"


SATS = {
    "sat_payment": (sat_payment_src, "PAYMENT_PK", "PAY_DOC_HASHDIFF", ["pay_doc_num", "pay_date", "sum"]),
    "sat_mdm": (sat_mdm_src, "MDM_PK", "MDM_HASHDIFF", ["registered_at", "is_vip"]),
    "sat_user": (sat_user_src, "USER_PK", "USER_HASHDIFF", ["phone"]),
}


def sat_year(name: str, year: int, target: str | None = None) -> str:
    src, pk, hd, payload = SATS[name]
    return sat_sql(src(year), pk, hd, payload, year, target)


def sat_second_year(name: str, y1: int, y2: int) -> str:
    return sat_year(name, y2, sat_year(name, y1))


def sat_rerun(name: str, y1: int, y2: int) -> str:
    first = sat_year(name, y1)
    after = f"({first}) union all ({sat_year(name, y2, first)})"
    return sat_year(name, y2, after)


# --- marts ---------------------------------------------------------------------------------

def report_sql(years, link: str | None = None, sat: str | None = None) -> str:
    """Report over the vault after loading ``years``.  ``link`` and ``sat`` name the loaded tables.  Without
    them one pass over all years' staging stands for both: payment keys are local to one
    year there (the billing period is part of the key)."""
    pay = staged_all_years("payment", years)
    link = link or link_sql(pay)
    sat = sat or f"select distinct PAYMENT_PK, PAY_DOC_HASHDIFF, pay_doc_num, pay_date, sum, EFFECTIVE_FROM, LOAD_DATE, RECORD_SOURCE from ({pay}) p"
    bp = " union all ".join(f"select BILLING_PERIOD_PK, BILLING_PERIOD_KEY from ({staged(s, y)}) x"
                            for y in years for s in ("payment", "billing"))
    hbp = (f"select BILLING_PERIOD_PK, min(BILLING_PERIOD_KEY) BILLING_PERIOD_KEY from ({bp}) b "
           "where BILLING_PERIOD_PK is not null group by BILLING_PERIOD_PK")
    us = " union all ".join(f"select USER_PK, USER_KEY from ({staged(s, y)}) x"
                            for y in years for s in ("payment", "mdm", "billing", "issue", "traffic"))
    hu = f"select USER_PK, min(USER_KEY) USER_KEY from ({us}) u where USER_PK is not null group by USER_PK"
    mu = ods_sql("user", None)
    return (
        "select cast(year(cast(h.BILLING_PERIOD_KEY as date)) as smallint) billing_year, mu.legal_type, "
        "mu.district, cast(year(mu.registered_at) as smallint) registration_year, mu.billing_mode, "
        "mu.is_vip, cast(sum(sp.sum) as bigint) tot_sum "
        f"from ({link}) l join ({sat}) sp on l.PAYMENT_PK = sp.PAYMENT_PK "
        f"join ({hbp}) h on l.BILLING_PERIOD_PK = h.BILLING_PERIOD_PK "
        f"join ({hu}) hu on l.USER_PK = hu.USER_PK "
        f"left join ({mu}) mu on hu.USER_KEY = cast(mu.user_id as varchar) "
        "group by 1, 2, 3, 4, 5, 6")


DIMS = ["billing_year", "legal_type", "district", "registration_year", "billing_mode"]


def _dim_body(attr: str, src: str = "r") -> str:
    return (f"select cast(row_number() over (order by {attr}_key asc nulls last) as smallint) id, "
            f"{attr}_key from (select distinct {attr} as {attr}_key from {src}) d")


def mart_ctes(report: str) -> str:
    """The report, its five dimensions and the fact, each computed once."""
    dims = ", ".join(f"d_{a} as materialized ({_dim_body(a)})" for a in DIMS)
    joins = " ".join(f"join d_{a} on t.{a} = d_{a}.{a}_key" for a in DIMS)
    ids = ", ".join(f"d_{a}.id as {a}_id" for a in DIMS)
    fact = f"select {ids}, t.is_vip, t.tot_sum from r t {joins}"
    return f"with r as materialized ({report}), {dims}, f as materialized ({fact}) "


def dim_sql(report: str, attr: str) -> str:
    return f"with r as materialized ({report}) {_dim_body(attr)}"


def fact_sql(report: str) -> str:
    return mart_ctes(report) + "select * from f"


def fk_violations_sql(report: str) -> str:
    parts = [f"select '{a}_id' as foreign_key, f.{a}_id as id from f where f.{a}_id is not null "
             f"and not exists (select 1 from d_{a} d where d.id = f.{a}_id)" for a in DIMS]
    return mart_ctes(report) + " union all ".join(parts)


def dm_traffic_sql(year: int) -> str:
    return ("select user_id, device_id, cast(date_trunc('month', \"timestamp\") as date) \"month\", "
            "cast(sum(bytes_sent) as bigint) bytes_sent, cast(sum(bytes_received) as bigint) "
            f"bytes_received, cast(count(*) as bigint) records from ({ods_sql('traffic', year)}) t "
            "group by 1, 2, 3")


# --- quality -----------------------------------------------------------------------------------

ODS_SQL_TYPES = {  # DuckDB types of the ODS selects, for type rules
    "INTEGER": ("INTEGER",), "BIGINT": ("BIGINT",), "DATE": ("DATE",), "TIMESTAMP": ("TIMESTAMP",),
    "TEXT": ("VARCHAR",), "NUMERIC": ("DECIMAL",), "INET": ("VARCHAR",),
}

IPV4_SQL = ("regexp_full_match({c}, '((25[0-5]|2[0-4][0-9]|1[0-9]{{2}}|[1-9]?[0-9])\\.){{3}}"
            "(25[0-5]|2[0-4][0-9]|1[0-9]{{2}}|[1-9]?[0-9])(/([0-9]|[12][0-9]|3[0-2]))?')")


def _lit(v, sql_type: str) -> str:
    if sql_type == "DATE":
        return f"DATE '{v}'"
    if sql_type == "TIMESTAMP":
        return f"TIMESTAMP '{v}'"
    return str(v)


def validate_sql(table: str, types: dict[str, str], suite: str, expectations: list[dict],
                 run_name: str, run_time: str) -> str:
    """One UNION ALL branch per rule over ``table``; ``types`` maps column ->
    DuckDB type name of the table."""
    rows = []
    head = f"'{run_name}' run_name, TIMESTAMP '{run_time}' run_time, '{suite}' suite"

    def row(i, et, col, success, element, missing, unexpected, src):
        return (f"select {head}, cast({i} as integer) rule_index, '{et}' expectation_type, '{col}' \"column\", "
                f"cast({success} as boolean) success, cast({element} as bigint) element_count, "
                f"cast({missing} as bigint) missing_count, cast({unexpected} as bigint) unexpected_count "
                f"from {src}")

    t = f"({table}) t"
    for i, e in enumerate(expectations):
        et, kw = e["expectation_type"], e["kwargs"]
        if et == quality.COMPOUND_UNIQUE:
            cols = kw["column_list"]
            allnull = " and ".join(f'"{c}" is null' for c in cols)
            g = (f"(select {', '.join(f'{chr(34)}{c}{chr(34)}' for c in cols)}, count(*) n from {t} "
                 f"group by all) g")
            u = f"coalesce(sum(case when n > 1 and not ({allnull}) then n else 0 end), 0)"
            rows.append(row(i, et, ",".join(cols), f"{u} = 0", "coalesce(sum(n), 0)", "NULL", u, g))
            continue
        c = f'"{kw["column"]}"'
        missing = f"count(*) filter (where {c} is null)"
        if et == quality.NOT_NULL:
            rows.append(row(i, et, kw["column"], f"{missing} = 0", "count(*)", missing, missing, t))
        elif et == quality.OF_TYPE:
            ok = types[kw["column"]].split("(")[0] in ODS_SQL_TYPES[kw["type_"].upper()]
            if not ok:
                rows.append(row(i, et, kw["column"], "false", "count(*)", missing, "NULL", t))
            elif kw["type_"].upper() == "INET":
                u = f"count(*) filter (where {c} is not null and not {IPV4_SQL.format(c=c)})"
                rows.append(row(i, et, kw["column"], f"{u} = 0", "count(*)", missing, u, t))
            else:
                rows.append(row(i, et, kw["column"], "true", "count(*)", missing, "0", t))
        elif et == quality.BETWEEN:
            ty = types[kw["column"]].split("(")[0]
            conds = []
            if kw.get("min_value") is not None:
                conds.append(f"{c} < {_lit(kw['min_value'], ty)}")
            if kw.get("max_value") is not None:
                conds.append(f"{c} > {_lit(kw['max_value'], ty)}")
            u = f"count(*) filter (where {c} is not null and ({' or '.join(conds) or 'false'}))"
            rows.append(row(i, et, kw["column"], f"{u} = 0", "count(*)", missing, u, t))
        elif et == quality.REGEX:
            u = f"count(*) filter (where {c} is not null and not regexp_matches({c}, '{kw['regex']}'))"
            rows.append(row(i, et, kw["column"], f"{u} = 0", "count(*)", missing, u, t))
        elif et in (quality.IN_SET, quality.EQUAL_SET):
            vals = ", ".join(f"'{v}'" for v in kw["value_set"])
            g = f"(select {c} v, count(*) n from {t} group by 1) g"
            out = f"count(*) filter (where v is not null and v not in ({vals}))"
            inside = f"count(*) filter (where v in ({vals}))"
            u = out if et == quality.IN_SET else f"({out} + ({len(set(kw['value_set']))} - {inside}))"
            m = "coalesce(sum(n) filter (where v is null), 0)"
            rows.append(row(i, et, kw["column"], f"{u} = 0", "coalesce(sum(n), 0)", m, u, g))
    return " union all ".join(rows)
