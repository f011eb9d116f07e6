"""SQL text of the input views, for the oracles (DuckDB dialect)."""

from __future__ import annotations

from stayline.sources.views import HAN, LATIN

VIEWS = {
    "v1": f"""select l.l_orderkey, l.l_linenumber, o.o_custkey as guid,
        case o.o_orderstatus when 'F' then 'a' when 'O' then 'b' else 'c' end as flag,
        p.p_type as showname,
        concat(p.p_name, ' ', cast(cast(l.l_quantity*3 as int) as string)) as title,
        concat(translate(case when l.l_linenumber % 2 = 0 then replace(p.p_name, ' ', '') else p.p_name end,
            '{LATIN}', '{HAN}'), ' ', cast(cast(l.l_quantity*3 as int) as string)) as title_han,
        p.p_brand as channel, cast(l.l_linenumber as double) as weight
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey""",
    "v2": """select concat_ws(chr(9), cast(event_id as string), concat('guid=', cast(user_id as string), '&complete=',
        case when event_type = 'purchase' then '1' else '0' end, '&play_types=',
        case when event_type in ('view','click') then 'net' else 'local' end), event_type) as line from events""",
    # base features as columns: cls, f1..f8; spend_token tells which rows hold a special token in f2
    "v3": """select c_custkey, case when n%3=0 then 'a' when n%3=1 then 'b' else 'c' end as cls,
        cast(n as double) as f1, cast(s as double) as f2, cast(mx as double) as f3, cast(mn as double) as f4,
        cast(nf as double) as f5, cast(no as double) as f6, cast(floor(c_acctbal) as double) as f7,
        cast(c_nationkey as double) as f8,
        case when c_custkey%11=0 then 'NULL' when c_custkey%13=0 then 'NaN' when c_custkey%17=0 then 'Infinity' else '' end as spend_token
        from customer join (select o_custkey, count(*) n, cast(floor(sum(o_totalprice)) as bigint)*1000 s,
            cast(floor(max(o_totalprice)) as bigint) mx, cast(floor(min(o_totalprice)) as bigint) mn,
            count(case when o_orderstatus='F' then 1 end) nf, count(case when o_orderstatus='O' then 1 end) no
            from orders group by o_custkey) t on c_custkey = o_custkey""",
    "v5": """select o_custkey as user_id, l_partkey as item, round(avg(l_quantity), 6) as rating
        from lineitem join orders on l_orderkey = o_orderkey group by o_custkey, l_partkey""",
    "v6": "select vec_id, label, cast(embedding as double[]) as x from embeddings",
    "v7": """select distinct case when l_returnflag='R' then l_partkey else -1 - l_suppkey end as src,
        case when l_returnflag='R' then -1 - l_suppkey else l_partkey end as dst from lineitem""",
    "v8": """select event_id as id, value as score, case when event_type='purchase' then 1 else 0 end as label,
        case when value > 50 then 1 else 0 end as pred from events""",
    "clicks": """select event_id, ts, user_id, event_type as page, regexp_extract(props, '([0-9]+)', 1) as pos,
        event_id%50 as vid, concat('t', cast(event_id%50 as string)) as title from events""",
}


def with_views(names: str, sql: str) -> str:
    parts = [f"{n} as ({VIEWS[n]})" for n in names.split()]
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(parts)}, {body[5:]}"
    return f"with {', '.join(parts)} {body}"


def hash_number(key: str, seed) -> str:
    return f"cast(concat('0x', substr(md5(concat(cast({key} as string), ':{seed}')), 1, 8)) as bigint)"
