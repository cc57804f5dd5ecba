"""DuckDB SQL for every registered query that SQL can express, over the given tables."""

from __future__ import annotations

N = 20


def bag_hash(key: str) -> str:
    """Hash of a key before the final mixing, over its UTF-8 bytes."""
    data = f"encode({key})"
    byte = f"('0x' || hex({data})[2*i-1:2*i])::BIGINT"
    mixed = "(((h + b) & 4294967295) * 1025) & 4294967295"
    return (
        f"list_reduce(list_prepend(0::BIGINT, [{byte} for i in range(1, octet_length({data}) + 1)]),"
        f" lambda h, b: xor({mixed}, ({mixed}) >> 6))"
    )


def finish(h: str) -> str:
    nine = f"(({h} * 9) & 4294967295)"
    return f"((xor({nine}, {nine} >> 11) * 32769) & 4294967295)"


def hashed(relation: str, key: str) -> str:
    """``relation`` with u (unsigned hash), pos (from the smallest hash) and item_hash."""
    text = (
        "(case when u >= 2147483648 then '0' || lpad((4294967296 - u)::varchar, 10, '0')"
        " else '1' || lpad(u::varchar, 10, '0') end)"
    )
    return (
        f"(select * exclude (h0), (u + 2147483648) % 4294967296 as pos, {text} as item_hash from"
        f" (select *, {finish('h0')} as u from (select *, {bag_hash(key)} as h0 from {relation})))"
    )


def shard(n: int, pos: str = "pos") -> str:
    return f"least({pos} // {4294967295 // n}, {n - 1})::INTEGER"


def slice_of(n: int, slices: int) -> str:
    width = 4294967295 // n
    return f"least((pos - {shard(n)}::BIGINT * {width}) * {slices} // {width}, {slices - 1})::INTEGER"


ORDERS = (
    "(select o_orderkey::varchar as id, o_custkey::varchar as customer,"
    " o_orderstatus as status, o_orderpriority as priority from orders)"
)
PEOPLE = (
    "(select c_name as name, c_nationkey::varchar as nation, c_mktsegment as segment from customer)"
)


def routed(relation: str, key: str, n: int = N, keep: str = "") -> str:
    return f"(select *, {shard(n)} as shard from {hashed(relation, key)})"


CHANGES = """(
  select o_orderkey::varchar as id, null::varchar as customer, 'X' as status
  from orders where o_orderpriority = '1-URGENT'
  union all
  select 'new-' || o_orderkey, o_custkey::varchar, 'N' from orders where o_orderstatus = 'P'
)"""

LINES = "(select l_orderkey::varchar as id, l_returnflag, l_linestatus, l_suppkey::varchar as s from lineitem)"
ATTRS = f"""(
  select id as item_name, 'flag' as name, l_returnflag as value from {LINES}
  union select id, 'state', l_linestatus from {LINES}
  union select id, 'supplier', s from {LINES}
)"""
PUTS = """(
  select o_orderkey::varchar as item_name, 'priority' as name, o_orderpriority as value from orders
  union all select o_orderkey::varchar, 'flag', o_orderstatus from orders
)"""


def upserted(customer: str, status: str) -> str:
    """Full outer join of orders and changes, with the given columns, routed by id."""
    merged = f"""(
      select coalesce(n.id, o.id) as id, {customer} as customer, {status} as status, o.priority
      from {ORDERS} o full join {CHANGES} n on n.id = o.id)"""
    return f"select id, customer, status, priority, item_hash, shard from {routed(merged, 'id')}"


UPSERT = upserted("coalesce(n.customer, o.customer)", "coalesce(n.status, o.status)")

EVENTS = """(
  select user_id::varchar as id,
    last(event_type order by ts, event_id) filter (where event_type <> 'error') as status,
    last(props order by ts, event_id) filter (where props is not null) as props
  from events group by user_id)"""


def balanced(matching: str, key: str, limit: int, columns: str) -> str:
    return f"""
    with recursive m as (select * from {matching}),
    c as (select shard, count(*) as cnt from m group by shard),
    r(i, quota, rem) as (
      select -1, 0::BIGINT, {limit}::BIGINT
      union all
      select i + 1, least(rem // ({N} - (i + 1)), coalesce(cnt, 0)),
        rem - least(rem // ({N} - (i + 1)), coalesce(cnt, 0))
      from r left join c on c.shard = r.i + 1 where i + 1 < {N}),
    ranked as (
      select *, row_number() over (partition by shard order by pos, {key}) as rn from m)
    {columns}
    """


def limited(matching: str, key: str, limit: int, columns: str) -> str:
    return balanced(
        matching,
        key,
        limit,
        f"select {columns} from ranked join r on r.i = ranked.shard where rn <= quota",
    )


PENDING = f"(select * from {routed(ORDERS, 'id')} where status = 'P')"
NATION_3 = f"(select * from {routed(PEOPLE, 'name')} where nation = '3')"

SAMPLES = """(
  select c_custkey as id, c_mktsegment as table_name,
    c_mktsegment || case c_custkey % 5 when 0 then '-x-' else '-' end
      || (c_custkey % 20 + 1)
      || case c_custkey % 5 when 1 then '-of-' when 2 then '-of-20 ' else '-of-20' end as name
  from customer)"""


def part(group: int, table: str | None = None) -> str:
    pattern = r"'^(.+)-(\d+)-of-(\d+)$'"
    mine = f" and regexp_extract(name, {pattern}, 1) = {table}" if table else ""
    return (
        f"(case when regexp_full_match(name, {pattern}){mine}"
        f" then regexp_extract(name, {pattern}, {group})::INTEGER else -1 end)"
    )


NATION_CATALOG = f"""(
  select 'nation-' || nation as table_name,
    shard + case nation when '23' then 2 else 1 end as number,
    case when nation = '24' and shard > 9 then 10 else 20 end as total,
    'nation-' || nation || '-' || (shard + case nation when '23' then 2 else 1 end) || '-of-'
      || case when nation = '24' and shard > 9 then 10 else 20 end as name
  from {routed(PEOPLE, 'name')})"""

NATION_SHARDS = f"(select 'nation-' || n_nationkey as table_name, 'nation-' || n_nationkey || '-' || i || '-of-20' as name from nation, range(1, 21) t(i))"

CONDITIONS = f"""
  a as (select * from {ATTRS}), p as (select * from {PUTS}),
  failed as (
    select o_orderkey::varchar as item_name from orders
    where case when o_orderkey % 2 = 0
      then o_orderkey::varchar not in (select item_name from a where name = 'flag' and value = 'R')
      else o_orderkey::varchar in (select item_name from a where name = 'state') end)"""

DOCS = "(select doc_id::varchar as item_name, text, lang, source from documents)"


def _oversized(name: str) -> str:
    size = f"octet_length(encode({name}))"
    return (
        f"select 'value' as problem, item_name, '{name}' as name, {size}::BIGINT as size,"
        f" 1024::BIGINT as allowed from {DOCS} where {size} > 1024"
    )


_DOC_SIZE = "octet_length(encode(item_name)) + " + " + ".join(
    f"coalesce(octet_length(encode({c})) + {len(c)}, 0)" for c in ("text", "lang", "source")
)
CAPACITY = " union all ".join(
    [_oversized(c) for c in ("text", "lang", "source")]
    + [
        f"select 'item', item_name, null, ({_DOC_SIZE})::BIGINT, 20000::BIGINT from {DOCS}"
        f" where {_DOC_SIZE} > 20000"
    ]
)


def _complement(text: str) -> str:
    return f"translate({text}, '0123456789', '9876543210')"


_KEY = "(c_custkey - 700)"
_BALANCE = "c_acctbal::DECIMAL(18,2)"
_BALANCE_TEXT = f"lpad(abs({_BALANCE})::varchar, 15, '0')"

ORACLES: dict[str, str] = {
    "item_hash": f"""
        select key, (case when u >= 2147483648 then u - 4294967296 else u end)::INTEGER as key_hash,
          item_hash
        from {hashed("(select c_name as key from customer union all select url from pages)", "key")}""",
    "shard_index": f"""
        select id, {', '.join(f'{shard(n)} as of_{n}' for n in (1, 3, 4, 20, 100))}
        from {hashed("(select o_orderkey::varchar as id from orders)", "id")}""",
    "shard_names": """
        select s_name as table_name, s_name || '-' || i || '-of-4' as name
        from supplier, range(1, 5) t(i)""",
    "parse_shard_names": f"""
        select id, name, {part(2)} as number, {part(3)} as total,
          {part(2, 'table_name')} as number_in_table, {part(3, 'table_name')} as total_in_table
        from {SAMPLES}""",
    "infer_num_shards": f"""
        with c as (select distinct table_name, number, total from {NATION_CATALOG}),
        s as (
          select table_name, min(total) as low,
            case when min(number) < 1 or max(case when number > total then 1 else 0 end) = 1
                then 'shard number out of range'
              when min(total) <> max(total) then 'shards with different total counts'
              when count(*) < min(total) then 'missing shard' end as problem
          from c group by table_name)
        select table_name, case when problem is null then low end as num_shards, problem,
          case when problem = 'missing shard' then (
            select min(i)::INTEGER from range(1, 21) t(i)
            where i not in (select number from c where c.table_name = s.table_name)) end
            as first_missing
        from s""",
    "sharded_scan": f"""
        select id, customer, status, priority, item_hash, shard from {routed(ORDERS, 'id')}""",
    "scheme_projection": f"select status, id, null::varchar as clerk from {ORDERS}",
    "where_scan": f"select * from {ORDERS} where status = 'P'",
    "key_like_scan": f"select * from {PEOPLE} where name like 'Customer#%7'",
    "text_order_scan": f"""
        select * from {PEOPLE} where nation > '5' and nation >= '10' and nation <= '7'""",
    "item_lookup": f"select * from {PEOPLE} where name = 'Customer#000000042'",
    "items_lookup": f"""
        select name, nation, shard from {routed(PEOPLE, 'name')}
        where name in (select 'Customer#' || lpad(o_custkey::varchar, 9, '0') from orders
          where o_orderstatus = 'P')""",
    "balanced_limit": limited(
        PENDING, "id", 1000, "id, customer, status, priority, item_hash, shard"
    ),
    "balanced_limit_scarce": limited(
        NATION_3, "name", 60, "name, nation, segment, item_hash, shard"
    ),
    "shard_plan": balanced(
        NATION_3,
        "name",
        60,
        f"""select shard, 'people-' || (shard + 1) || '-of-{N}' as name, cnt as items, quota
            from r join c on c.shard = r.i where quota > 0""",
    ),
    "shard_plan_unlimited": f"""
        select shard, 'orders-' || (shard + 1) || '-of-{N}' as name, count(*) as items,
          -1::BIGINT as quota
        from {PENDING} group by shard""",
    "plain_limit": f"select * from {ORDERS} where status = 'P' order by id limit 100",
    "count_by_shard": f"select shard, count(*) as items from {PENDING} group by shard",
    "count_total": f"select count(*) as items from {ORDERS} where status = 'P'",
    "count_capped": f"""
        select shard, least(count(*), 700) as items from {routed(ORDERS, 'id')}
        where status <> 'P' group by shard""",
    "count_capped_rows": f"""
        select shard, least(count(*), 700) as items from {routed(ORDERS, 'id')}
        where status <> 'P' group by shard""",
    "table_count": """
        select 'all' as asked, count(*) as items from orders
        union all select 'all, up to 100', least(count(*), 100) from orders
        union all select 'pending', count(*) from orders where o_orderstatus = 'P'
        union all select 'pending, up to 50', least(count(*), 50) from orders where o_orderstatus = 'P'
        union all select 'filled, up to 1000000', least(count(*), 1000000) from orders where o_orderstatus = 'F'""",
    "upsert": UPSERT,
    "upsert_null_deletes": upserted(
        "case when n.id is not null then n.customer else o.customer end",
        "case when n.id is not null then n.status else o.status end",
    ),
    "upsert_dedup": f"""
        select id, customer, status, priority, props, item_hash, shard from {routed(f'''(
          select coalesce(n.id, o.id) as id, customer, coalesce(n.status, o.status) as status,
            priority, props
          from {ORDERS} o full join {EVENTS} n on n.id = o.id)''', 'id')}""",
    "table_update": UPSERT,
    "table_update_bulk": UPSERT,
    "table_update_ordered": f"select id, status, props from {EVENTS}",
    "replace_table": f"""
        select id, customer, status, priority, item_hash, shard from {routed(ORDERS, 'id')}""",
    "keep_table": f"select * from {PEOPLE}",
    "key_validation": """
        select name, nation, segment, coalesce(name, '') <> '' as valid from (
          select case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then ''
              else c_name end as name,
            c_nationkey as nation, c_mktsegment as segment
          from customer)""",
    "encode_strings": """
        with l as (select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
            as item_name, * from lineitem)
        select item_name, 'line' as name, l_linenumber::varchar as value from l
        union all select item_name, 'bulk', (l_quantity > 25)::varchar from l
        union all select item_name, 'shipped', l_shipdate::varchar from l
        union all select item_name, 'flag', l_returnflag from l where l_returnflag <> 'N'""",
    "typed_roundtrip": """
        select l_orderkey as id, l_linenumber as line, l_quantity > 25 as bulk,
          l_extendedprice as price, l_returnflag as flag from lineitem""",
    "typed_permissive": """
        select l_orderkey as id, case when l_quantity <= 25 then l_linenumber end as flag
        from lineitem""",
    "to_long": f"""
        select name as item_name, 'nation' as name, nation as value from {PEOPLE}
        union all select name, 'segment', segment from {PEOPLE} where segment <> 'BUILDING'""",
    "to_item_map": f"""
        select item_name, 0::BIGINT as part, string_agg(pair, ';' order by name) as attributes
        from (select item_name, name, name || '=' || string_agg(value, ',' order by value) as pair
          from {ATTRS} group by item_name, name)
        group by item_name""",
    "item_ranges": """
        with l as (select distinct l_returnflag as item_name, l_linestatus as name,
            l_shipdate || '-' || l_suppkey as value from lineitem),
        placed as (select *, (row_number() over (partition by item_name order by name, value) - 1) // 50 as part from l)
        select item_name, part, string_agg(pair, ';' order by name) as attributes
        from (select item_name, part, name, name || '=' || string_agg(value, ',' order by value) as pair
          from placed group by item_name, part, name)
        group by item_name, part""",
    "select_items": f"""
        with a as (select * from {ATTRS}),
        f as (select item_name from a group by item_name
          having min(value) filter (where name = 'flag') = 'A'
            and min(value) filter (where name = 'state') <> 'F')
        select item_name, 0::BIGINT as part, string_agg(pair, ';' order by name) as attributes
        from (select item_name, name, name || '=' || string_agg(value, ',' order by value) as pair
          from a where item_name in (select item_name from f) group by item_name, name)
        group by item_name""",
    "select_any_value": f"""
        with a as (select * from {ATTRS}),
        f as (select item_name from a group by item_name
          having (bool_or(name = 'flag' and value = 'R') and bool_or(name = 'state' and value = 'O'))
            or bool_or(name = 'supplier' and value >= '9'))
        select item_name, 0::BIGINT as part, string_agg(pair, ';' order by name) as attributes
        from (select item_name, name, name || '=' || string_agg(value, ',' order by value) as pair
          from a where item_name in (select item_name from f) group by item_name, name)
        group by item_name""",
    "table_items": f"""
        with a as (select * from {ATTRS}),
        f as (select item_name from a group by item_name
          having bool_or(name = 'flag' and value = 'R') and bool_or(name = 'state' and value = 'O'))
        select item_name, 0::BIGINT as part, string_agg(pair, ';' order by name) as attributes
        from (select item_name, name, name || '=' || string_agg(value, ',' order by value) as pair
          from a where item_name in (select item_name from f) group by item_name, name)
        group by item_name""",
    "table_conditional_put": f"""
        with {CONDITIONS},
        ok as (select * from p where item_name not in (select item_name from failed))
        select *, null::varchar as error from (
          select * from a where not exists (
            select 1 from ok where ok.item_name = a.item_name and ok.name = a.name)
          union select * from ok)
        union all
        select *, 'ConditionalCheckFailed' as error from p
        where item_name in (select item_name from failed)""",
    "table_delete": f"""
        select * from {ATTRS} where item_name not in (
          select o_orderkey::varchar from orders where o_orderstatus = 'F')
        and not (name = 'flag' and value = 'R'
          and item_name in (select o_orderkey::varchar from orders))
        and not (name = 'state' and item_name in (
          select o_orderkey::varchar from orders where o_orderpriority = '1-URGENT'))""",
    "table_attribute": f"""
        with a as (select * from {ATTRS} where item_name = '7')
        select item_name, name, value, (select min(value) from a where name = 'flag') as flag
        from a where name = 'supplier'""",
    "table_stats": f"""
        select shard, count(*) as items, 3 * count(*) as attribute_values,
          3::BIGINT as attribute_names, sum(octet_length(encode(name)))::BIGINT as item_names_bytes,
          (11 * count(*) + sum(octet_length(encode(nation)))
            + sum(octet_length(encode(segment))))::BIGINT as attribute_values_bytes,
          22::BIGINT as attribute_names_bytes, true as modified
        from {routed(PEOPLE, 'name')} group by shard""",
    "table_lookup_few": f"""
        select * from {PEOPLE}
        where name in (select printf('Customer#%09d', n_nationkey::int * 57) from nation)""",
    "table_lookup_all": f"select * from {ORDERS} where priority = '1-URGENT' and status <> 'F'",
    "table_plan": balanced(
        PENDING,
        "id",
        500,
        f"""select c.shard, 'orders-' || (c.shard + 1) || '-of-20' as name, cnt as items, quota,
              (select count(*) from {routed(ORDERS, 'id')} s where s.shard = c.shard) as stored
            from c join r on r.i = c.shard where quota > 0""",
    ),
    "shard_stats_modified": f"""
        select shard, count(*) as items, 2 * count(*) as attribute_values,
          2::BIGINT as attribute_names, sum(octet_length(encode(id)))::BIGINT as item_names_bytes,
          (11 * count(*) + sum(octet_length(encode(status))))::BIGINT as attribute_values_bytes,
          15::BIGINT as attribute_names_bytes, max(changed) as modified
        from {routed("(select o_orderkey::varchar as id, o_orderstatus as status, o_orderdate as changed from orders)", 'id')}
        group by shard""",
    "shard_count_check": """
        select p_partkey::varchar as table_name, (3 * p_size)::BIGINT as num_shards, 100 as allowed
        from part where 3 * p_size > 100""",
    "item_parts": f"select * from {ATTRS}",
    "to_wide": f"""
        select item_name as id, min(value) filter (where name = 'flag') as flag,
          min(value) filter (where name = 'state') as state,
          min(value) filter (where name = 'supplier') as supplier, null::varchar as none
        from {ATTRS} group by item_name""",
    "first_value": f"""
        select item_name as id, min(value) filter (where name = 'flag') as flag,
          string_agg(value, ',' order by value) filter (where name = 'supplier') as suppliers,
          null::varchar as none
        from {ATTRS} group by item_name""",
    "attribute_lookup": f"select * from {ATTRS} where item_name = '7' and name = 'supplier'",
    "put_append": f"select * from {ATTRS} union select * from {PUTS}",
    "put_replace": f"""
        with p as (select * from {PUTS})
        select * from {ATTRS} a where not exists (
          select 1 from p where p.item_name = a.item_name and p.name = a.name)
        union select * from p""",
    "batch_put": f"""
        with p as (select * from {PUTS})
        select * from {ATTRS} a where not exists (
          select 1 from p where p.item_name = a.item_name and p.name = a.name
            and p.item_name::BIGINT % 2 = 0)
        union select * from p""",
    "conditional_put": f"""
        with {CONDITIONS},
        ok as (select * from p where item_name not in (select item_name from failed))
        select * from a where not exists (
          select 1 from ok where ok.item_name = a.item_name and ok.name = a.name)
        union select * from ok""",
    "conditional_put_rejected": f"""
        with {CONDITIONS}
        select *, 'ConditionalCheckFailed' as error from p
        where item_name in (select item_name from failed)""",
    "delete_item": f"""
        select * from {ATTRS} where item_name not in (
          select o_orderkey::varchar from orders where o_orderstatus = 'F')""",
    "delete_attribute": f"""
        select * from {ATTRS} where not (name = 'supplier' and item_name in (
          select o_orderkey::varchar from orders where o_orderstatus = 'F'))""",
    "delete_value": f"""
        select * from {ATTRS} where not (name = 'flag' and value = 'R'
            and item_name in (select o_orderkey::varchar from orders))
          and not (name = 'state' and item_name in (
            select o_orderkey::varchar from orders where o_orderpriority = '1-URGENT'))""",
    "table_put": f"""
        with p as (select * from {PUTS})
        select * from {ATTRS} a where not exists (
          select 1 from p where p.item_name = a.item_name and p.name = a.name
            and p.item_name::BIGINT % 2 = 0)
        union select * from p""",
    "create_table": f"""
        select 'people-' || (i + 1) || '-of-{N}' as name, count(shard) as items
        from range({N}) t(i) left join {routed(PEOPLE, 'name')} on shard = i group by i""",
    "table_exists": f"""
        select table_name, bool_and(name in (select name from {NATION_CATALOG})) as table_exists
        from {NATION_SHARDS} group by table_name""",
    "missing_shards": f"""
        select * from {NATION_SHARDS}
        where table_name in (select table_name from {NATION_CATALOG})
          and name not in (select name from {NATION_CATALOG})""",
    "drop_table": f"""
        select name, 'people2-' || (shard + 1) || '-of-3' as shard_name
        from {routed(PEOPLE, 'name', 3)}""",
    "list_tables": f"""
        select 'people-' || i || '-of-20' as name from range(1, 21) t(i)
        union select 'orders-' || i || '-of-4' from range(1, 5) t(i)
        union select name from {NATION_CATALOG} where table_name <> 'nation-1'""",
    "list_tables_max": f"select distinct name from {NATION_CATALOG} order by name limit 100",
    "last_modified": """
        select event_type as table_name, max(ts) as modified from events group by event_type""",
    "shard_stats": f"""
        select shard, count(*) as items,
          (count(*) + count(nation) + count(segment))::BIGINT as attribute_values,
          (1 + max((nation is not null)::INT) + max((segment is not null)::INT))::BIGINT
            as attribute_names,
          sum(octet_length(encode(name)))::BIGINT as item_names_bytes,
          (11 * count(*) + sum(octet_length(encode(nation)))
            + coalesce(sum(octet_length(encode(segment))), 0))::BIGINT as attribute_values_bytes,
          (9 + 6 * max((nation is not null)::INT) + 7 * max((segment is not null)::INT))::BIGINT
            as attribute_names_bytes
        from (select name, nation, nullif(segment, 'BUILDING') as segment, shard
          from {routed(PEOPLE, 'name')})
        group by shard""",
    "attribute_stats": f"""
        with a as (select * from {routed(ATTRS, 'item_name')}),
        i as (select shard, item_name, count(*) as n, sum(octet_length(encode(value))) as b
          from a group by shard, item_name),
        k as (select shard, count(*) + 1 as attribute_names,
            sum(octet_length(encode(name))) + 9 as attribute_names_bytes
          from (select distinct shard, name from a) group by shard)
        select shard, count(*) as items, (sum(n) + count(*))::BIGINT as attribute_values,
          any_value(attribute_names)::BIGINT as attribute_names,
          sum(octet_length(encode(item_name)))::BIGINT as item_names_bytes,
          (sum(b) + 11 * count(*))::BIGINT as attribute_values_bytes,
          any_value(attribute_names_bytes)::BIGINT as attribute_names_bytes
        from i join k using (shard) group by shard""",
    "reshard": f"select id, item_hash, shard from {routed(ORDERS, 'id', 7)}",
    "table_reshard": f"""
        select id, customer, status, priority, item_hash, shard from {routed(ORDERS, 'id', 7)}""",
    "hash_slices": f"select id, shard, {slice_of(N, 8)} as slice from {routed(ORDERS, 'id')}",
    "slice_scan": f"""
        select id, shard from {routed(ORDERS, 'id', 4)} where shard = 1 and {slice_of(4, 3)} = 2""",
    "sortable_doubles": """
        with lines as (
            select l_orderkey as id, l_linenumber as line,
                   l_extendedprice * (case when l_linenumber % 2 = 0 then -1.0::double else 1.0::double end) / 7 as value
            from lineitem
        ),
        scaled as (select *, abs(value) as x, floor(log2(abs(value)))::bigint as near from lines),
        settled as (
            select *, (near - (pow(2.0::double, near) > x)::bigint + (pow(2.0::double, near + 1) <= x)::bigint) as e from scaled
        ),
        bits as (
            select *, (e + 1023) * 4503599627370496 + ((x / pow(2.0::double, e) - 1) * 4503599627370496)::bigint as b from settled
        )
        select id, line, value,
               case when value < 0 then '0' || printf('%016X', 9223372036854775807 - b) else '1' || printf('%016X', b) end as text,
               row_number() over (partition by id order by value, line) as place
        from bits""",
    "sortable_encode": f"""
        select c_custkey as id,
          case when {_KEY} < 0 then '0' || {_complement(f"lpad(abs({_KEY})::varchar, 19, '0')")}
            else '1' || lpad({_KEY}::varchar, 19, '0') end as key_text,
          case when {_BALANCE} < 0 then '0' || {_complement(_BALANCE_TEXT)}
            else '1' || {_BALANCE_TEXT} end as balance_text,
          ({_BALANCE})::DOUBLE as balance, {_KEY}::BIGINT as key
        from customer""",
    "capacity_check": CAPACITY,
    "attribute_capacity_check": CAPACITY,
    "contact_flow": balanced(
        PENDING,
        "id",
        1000,
        f"""select shard, status, count(*) as items from (
              select shard, case when id in (
                select id from ranked join r on r.i = ranked.shard where rn <= quota)
                then 'F' else status end as status
              from {routed(ORDERS, 'id')})
            group by shard, status""",
    ),
}
