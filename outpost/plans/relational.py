"""Relational queries over the driver tables: one Spark text, and the oracle's text where it differs.

Tables are written as ``{name}``; Spark gets them as DataFrames bound at call time, so no temporary view
outlives a query. Every computed column is aliased and cast alike in both texts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outpost.sources import TABLES, read_table

#: name: (Spark text, oracle text or None if equal)
SQL: dict[str, tuple[str, str | None]] = {
    "b01_full_scan": ("select * from {supplier}", None),
    "b01_scan_lineitem": ("select * from {lineitem}", None),
    "b02_filter": ("select l_orderkey, l_linenumber from {lineitem} where l_quantity > 45 and l_discount between 0.05 and 0.07", None),
    "b13_maps": ("select n_nationkey, map('a', n_regionkey, 'b', n_nationkey)['b'] as b, map('a', n_regionkey)['z'] as z, size(map('a', 1, 'b', 2)) as n from {nation}", "select n_nationkey, map(['a', 'b'], [n_regionkey, n_nationkey])['b'] as b, map(['a'], [n_regionkey])['z'] as z, cast(2 as integer) as n from nation"),
    "b14_more_strings": ("select n_nationkey, ltrim('  ' || n_name) as l, rtrim(n_name || '  ') as r, chr(65 + n_nationkey) as c, concat(n_name, '-', n_regionkey) as j, lpad(n_name, 4, '*') as p, instr(n_name, 'A') as i from {nation}", "select n_nationkey, ltrim('  ' || n_name) as l, rtrim(n_name || '  ') as r, chr(65 + n_nationkey) as c, concat(n_name, '-', n_regionkey) as j, lpad(n_name, 4, '*') as p, cast(instr(n_name, 'A') as integer) as i from nation"),
    "b17_json_objects": ("select n_nationkey, to_json(named_struct('k', n_nationkey, 'name', n_name)) as j, get_json_object(to_json(named_struct('in', named_struct('k', n_regionkey))), '$.in.k') as k from {nation}", "select n_nationkey, cast(json_object('k', n_nationkey, 'name', n_name) as varchar) as j, json_object('in', json_object('k', n_regionkey))->>'$.in.k' as k from nation"),
    "b102_temp_relation": ("with v as (select c_nationkey as k, count(*) as n from {customer} group by c_nationkey) select a.k, cast(a.n as bigint) as n, cast(b.n as bigint) as m from v a join v b on a.k = b.k + 1", None),
    "b63_partitioned_windows": ("select o_orderkey, cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as bigint) as rn, cast(count(*) over (partition by o_custkey) as bigint) as n, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as before from {orders}", None),
    "b70_order_by": ("select o_orderkey, o_orderstatus, o_orderpriority from {orders} order by o_orderstatus desc, length(o_orderpriority), o_orderkey % 10, o_orderkey", None),
    "b85_set_op_order": ("(select s_nationkey as k from {supplier} union select c_nationkey as k from {customer}) order by k desc", None),
    "b91_in_or_exists": ("select c_custkey from {customer} where c_nationkey in (select n_nationkey from {nation} where n_regionkey = 2) or exists (select 1 from {orders} where o_custkey = c_custkey and o_totalprice > 450000)", None),
    # As a subquery, Catalyst joins all balances to all orders. Grouped by a struct, the join's shuffle doesn't fit the grouping, so adaptive execution may split a customer of many orders.
    "b93_correlated_sum": ("with counts as (select kb, count(*) as n from (select named_struct('k', k, 'b', b) as kb from (select distinct c_custkey as k, c_acctbal as b from {customer}) join {orders} on o_custkey = k and o_totalprice > 20 * b) group by kb) select c_custkey, cast(coalesce(n, 0) as bigint) as n from {customer} left join counts on c_custkey = kb.k and c_acctbal = kb.b", "select c_custkey, (select cast(count(*) as bigint) from orders where o_custkey = c_custkey and o_totalprice > 20 * c_acctbal) as n from customer"),
    "b03_projection": ("select c_mktsegment as seg, c_custkey as k, c_name as name from {customer}", None),
    "b04_arithmetic": ("select l_orderkey, l_linenumber, l_orderkey % 7 as m, l_extendedprice * (1 - l_discount) / 2 as half from {lineitem}", None),
    "b05_case": ("select o_orderkey, case when o_totalprice < 100000 then 'low' else 'high' end as bucket from {orders}", None),
    "b06_between": ("select p_partkey from {part} where p_size between 10 and 20", None),
    "b07_cast": ("select o_orderkey, cast(o_totalprice as bigint) as whole, cast(o_orderkey as string) as txt from {orders} where o_totalprice - floor(o_totalprice) < 0.5", "select o_orderkey, cast(o_totalprice as bigint) as whole, cast(o_orderkey as varchar) as txt from {orders} where o_totalprice - floor(o_totalprice) < 0.5"),
    "b08_in_values": ("select n_name from {nation} where n_nationkey in (select col1 from values (3),(7),(9))", "select n_name from {nation} where n_nationkey in (values (3),(7),(9))"),
    "b09_coalesce": ("select n_nationkey, coalesce(s.k, -1) as k from {nation} left join (select min(s_suppkey) as k, s_nationkey from {supplier} where s_acctbal > 5000 group by s_nationkey) s on s_nationkey = n_nationkey", None),
    "b10_struct_path": ("select s.a.b as v from (select named_struct('a', named_struct('b', n_nationkey)) as s from {nation})", "select s.a.b as v from (select {{'a': {{'b': n_nationkey}}}} as s from {nation})"),
    "b12_lambda": ("select n_nationkey from {nation} where array_contains(transform(array(1,2,3), x -> x+2), n_nationkey)", "select n_nationkey from {nation} where list_contains(list_transform([1,2,3], lambda x: x+2), n_nationkey)"),
    "b13_literals": ("select n_nationkey, element_at(array(10,20,30), 2) as two, named_struct('a', n_name).a as a from {nation}", "select n_nationkey, ([10,20,30])[2] as two, ({{'a': n_name}}).a as a from {nation}"),
    "b14_strings": ("select p_partkey, lower(p_brand) || '-' || upper(p_type) as tag, cast(length(p_name) as bigint) as len, startswith(p_name, 'a') as a, contains(p_name, 'b') as b, replace(p_brand, '#', '') as r from {part} where p_name like '%a%' or p_name rlike '^[m-z]'", "select p_partkey, lower(p_brand) || '-' || upper(p_type) as tag, cast(length(p_name) as bigint) as len, starts_with(p_name, 'a') as a, contains(p_name, 'b') as b, replace(p_brand, '#', '') as r from {part} where p_name like '%a%' or regexp_matches(p_name, '^[m-z]')"),
    "b15_hashes": ("select c_custkey, md5(c_name) as m, sha2(c_name, 256) as s from {customer}", "select c_custkey, md5(c_name) as m, sha256(c_name) as s from {customer}"),
    "b16_dates": ("select o_orderkey, o_orderdate + make_dt_interval(0,0,0,o_orderkey) as later, cast(year(o_orderdate) as bigint) as y, cast(date_trunc('month', o_orderdate) as timestamp_ntz) as m from {orders}", "select o_orderkey, o_orderdate + interval (o_orderkey) second as later, cast(year(o_orderdate) as bigint) as y, cast(date_trunc('month', o_orderdate) as timestamp) as m from {orders}"),
    "b17_json": ("select event_id, cast(get_json_object(props,'$.k') as int) as k from {events}", "select event_id, cast(json_extract_string(props,'$.k') as integer) as k from {events}"),
    "b34_join_cross": ("select r_name, n_name from {region} cross join {nation} where n_nationkey < 5", None),
    "b35_join_theta": ("select a.s_suppkey as s1, b.s_suppkey as s2 from {supplier} a join {supplier} b on a.s_acctbal > b.s_acctbal + 9000", None),
    "b43_lateral_nested": ("select r_name, n_name, m.n as n from {region} join {nation} on n_regionkey = r_regionkey, lateral (select cast(count(*) as bigint) as n from {supplier} where s_nationkey = n_nationkey and s_acctbal > r_regionkey * 1000) m", None),
    "b58_group_by_subquery": ("select g, cast(count(*) as bigint) as n from (select o_orderkey % (select count(*) from {region}) as g from {orders}) group by g", None),
    "b74_order_by_subquery": ("select n_nationkey from {nation} order by (select max(r_regionkey) from {region}) - n_nationkey, n_nationkey limit 3", None),
    "b96_cte_set_operation": ("with u as (select c_nationkey as k from {customer} union select s_nationkey as k from {supplier}) select k from u where k > 10", None),
    "b98_rec_cte_join": ("with recursive w(k, depth) as (select n_nationkey, 0 from {nation} where n_regionkey = 1 union all select w.k + 1, depth + 1 from w join {region} on r_regionkey = depth where depth < 3) select cast(k as bigint) as k, cast(depth as bigint) as depth from w", None),
    "b20_except_column": ("select * except (n_name) from {nation}", "select * exclude (n_name) from {nation}"),
    "b21_from_first": ("from {region} select r_name", None),
    "b22_constant": ("select 42 as a, 43 as b", None),
    "b23_struct_columns": ("select s.* from (select named_struct('x', n_nationkey, 'y', n_name) as s from {nation})", "select unnest(s) from (select {{'x': n_nationkey, 'y': n_name}} as s from {nation})"),
    "b30_join_inner": ("select c_mktsegment, cast(count(*) as bigint) as n, round(sum(o_totalprice),2) as total from {customer} join {orders} on c_custkey=o_custkey group by c_mktsegment", None),
    "b31_join_using": ("select k, a.p as p, b.q as q from (select n_nationkey as k, n_name as p from {nation}) a join (select s_nationkey as k, s_suppkey as q from {supplier}) b using (k)", None),
    "b32_join_left": ("select c_custkey, cast(count(o_orderkey) as bigint) as n from {customer} left join {orders} on c_custkey=o_custkey group by c_custkey", None),
    "b33_join_natural": ("select * from (select n_nationkey as k, n_name from {nation}) a natural join (select s_nationkey as k, s_suppkey from {supplier}) b", None),
    "b35_join_computed_key": ("select a.n_nationkey as i, b.n_nationkey as j from {nation} a join {nation} b on a.n_nationkey + 1 = b.n_nationkey", None),
    "b36_join_three": ("select n_name, r_name, cast(count(s_suppkey) as bigint) as n from {region} join ({nation} join {supplier} on s_nationkey = n_nationkey) on n_regionkey = r_regionkey group by n_name, r_name", None),
    "b37_join_extra_predicate": ("select c_custkey, o_orderkey from {customer} join {orders} on c_custkey = o_custkey and o_totalprice > 400000 and c_acctbal < 0", None),
    "b41_lateral": ("select r_name, m.n as n from {region}, lateral (select cast(count(*) as bigint) as n from {nation} where n_regionkey = r_regionkey) m", None),
    "b42_lateral_top": ("select r_name, n_name from (select r_name, n_name, row_number() over (partition by r_regionkey order by abs(n_nationkey - r_regionkey), n_nationkey) as rn from {region} join {nation} on n_regionkey = r_regionkey) where rn <= 2", "select r_name, m.n_name from {region}, lateral (select n_name from {nation} where n_regionkey = r_regionkey order by abs(n_nationkey - r_regionkey), n_nationkey limit 2) m"),
    "b44_series_join": ("select n_name, g.i as i from {nation} join (select explode(sequence(0, 9)) as i) g on g.i = n_nationkey", "select n_name, cast(g.i as integer) as i from {nation} join (select unnest(generate_series(0, 9)) as i) g on g.i = n_nationkey"),
    "b45_exists": ("select c_custkey from {customer} where exists (select 1 from {orders} where o_custkey = c_custkey and o_totalprice > 300000)", None),
    "b45_not_exists": ("select p_partkey from {part} where not exists (select 1 from {lineitem} where l_partkey = p_partkey and l_quantity > 45)", None),
    "b45_in": ("select s_name from {supplier} where s_nationkey in (select n_nationkey from {nation} where n_regionkey=1)", None),
    "b45_not_in": ("select s_name from {supplier} where s_nationkey not in (select n_nationkey from {nation} where n_regionkey=1)", None),
    "b50_totals": ("select cast(count(*) as bigint) as n, round(sum(o_totalprice), 2) as total, min(o_orderkey) as lo, max(o_orderkey) as hi from {orders}", None),
    "b51_count_distinct": ("select cast(count(distinct l_suppkey) as bigint) as n from {lineitem}", None),
    "b52_group_expression": ("select o_orderkey % 10 as bucket, cast(count(*) as bigint) as n from {orders} group by o_orderkey % 10", None),
    "b53_having": ("select l_partkey, cast(count(*) as bigint) as n from {lineitem} group by l_partkey having count(*) > 35", None),
    "b54_agg_filter": ("select l_returnflag, cast(count(*) filter (where l_discount >= 0.05) as bigint) as hi, cast(count(*) as bigint) as n from {lineitem} group by l_returnflag", None),
    "b55_distinct": ("select distinct c_mktsegment, c_nationkey from {customer}", None),
    "b56_distinct_on": ("select o_custkey, o_orderkey from (select o_custkey,o_orderkey,row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) rn from {orders}) where rn=1", "select distinct on (o_custkey) o_custkey, o_orderkey from {orders} order by o_custkey, o_totalprice desc, o_orderkey"),
    "b57_group_by_all": ("select c_mktsegment, c_nationkey, cast(count(*) as bigint) as n from {customer} group by all", None),
    "b60_row_number": ("select o_orderkey, cast(row_number() over (partition by o_custkey order by o_orderkey) as bigint) as rn from {orders}", None),
    "b61_rank": ("select p_partkey, cast(rank() over (partition by p_brand order by p_retailprice desc) as bigint) as rk from {part}", None),
    "b62_running_sum": ("select event_id, round(sum(value) over (partition by user_id order by ts, event_id),2) as rs from {events}", None),
    "b64_qualify": ("select o_custkey, o_orderkey from (select o_custkey,o_orderkey,row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) rn from {orders}) where rn<=2", "select o_custkey, o_orderkey from {orders} qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) <= 2"),
    "b71_limit_offset": ("select o_orderkey from {orders} order by o_orderkey limit 20 offset 5", None),
    "b72_top_k": ("select l_orderkey, l_linenumber, l_extendedprice from {lineitem} order by l_extendedprice desc, l_orderkey, l_linenumber limit 50", None),
    "b80_union_all": ("select n_regionkey as k from {nation} union all select r_regionkey as k from {region}", None),
    "b81_union": ("select c_nationkey as k from {customer} union select s_nationkey as k from {supplier}", None),
    "b82_intersect": ("select o_custkey as k from {orders} intersect select c_custkey as k from {customer} where c_nationkey<10", None),
    "b82_intersect_all": ("select c_nationkey as k from {customer} intersect all select s_nationkey as k from {supplier}", None),
    "b83_except": ("select c_custkey as k from {customer} except select o_custkey as k from {orders} where o_totalprice > 200000", None),
    "b83_except_all": ("select o_custkey as k from {orders} except all select c_custkey as k from {customer}", None),
    "b84_nested_set_ops": ("(select n_nationkey as k from {nation} union all select s_nationkey as k from {supplier}) except select c_nationkey as k from {customer} where c_acctbal > 9990", None),
    "b90_scalar_subquery": ("select o_orderkey, (select max(r_regionkey) from {region}) as m from {orders} where o_totalprice > (select avg(o_totalprice) * 2 from {orders})", None),
    "b92_corr_scalar": ("select n_name, (select cast(count(*) as bigint) from {supplier} where s_nationkey=n_nationkey) as n from {nation}", None),
    "b94_derived": ("select k, n from (select k, cast(count(*) as bigint) as n from (select o_custkey % 5 as k from {orders} where o_orderkey > 100) group by k) where n > 10", None),
    "b95_cte": ("with big as (select * from {orders} where o_totalprice > 300000), named as (select c_name, o_orderkey from big join {customer} on c_custkey = o_custkey) select c_name, cast(count(*) as bigint) as n from named group by c_name", None),
    "b97_rec_cte": ("with recursive chain(n,depth) as (select cast(min(c_custkey) as bigint),cast(0 as bigint) from {customer} union all select n+1,depth+1 from chain where depth<20) select n, depth from chain", None),
    "tpch_q1": ("select l_returnflag,l_linestatus,round(sum(l_quantity),2) as sum_qty,round(sum(l_extendedprice*(1-l_discount)),2) as disc,round(avg(l_discount),6) as avg_disc,cast(count(*) as bigint) as n from {lineitem} where l_shipdate <= timestamp_ntz '2000-09-02' group by l_returnflag,l_linestatus", "timestamp"),
    "tpch_q3": ("select l_orderkey, round(sum(l_extendedprice*(1-l_discount)),2) as revenue, o_orderdate from {customer},{orders},{lineitem} where c_mktsegment='BUILDING' and c_custkey=o_custkey and l_orderkey=o_orderkey and o_orderdate < timestamp_ntz '1998-03-15' and l_shipdate > timestamp_ntz '1998-03-15' group by l_orderkey,o_orderdate order by revenue desc, o_orderdate, l_orderkey limit 10", "timestamp"),
    "tpch_q5": ("select n_name, round(sum(l_extendedprice*(1-l_discount)),2) as revenue from {customer},{orders},{lineitem},{supplier},{nation},{region} where c_custkey=o_custkey and l_orderkey=o_orderkey and l_suppkey=s_suppkey and c_nationkey=s_nationkey and s_nationkey=n_nationkey and n_regionkey=r_regionkey and r_name=(select min(r_name) from {region}) group by n_name", None),
    "tpch_q6": ("select round(sum(l_extendedprice*l_discount),2) as revenue from {lineitem} where l_shipdate >= timestamp_ntz '1996-01-01' and l_shipdate < timestamp_ntz '1997-01-01' and l_discount between 0.05 and 0.07 and l_quantity < 24", "timestamp"),
    "tpch_q7": ("select supp, cust, y, cast(sum(cast(v as decimal(18,4))) as double) as revenue from (select a.n_name as supp, b.n_name as cust, cast(year(l_shipdate) as bigint) as y, l_extendedprice*(1-l_discount) as v from {supplier} join {lineitem} on s_suppkey=l_suppkey join {orders} on o_orderkey=l_orderkey join {customer} on c_custkey=o_custkey join {nation} a on s_nationkey=a.n_nationkey join {nation} b on c_nationkey=b.n_nationkey where a.n_regionkey = 1 and b.n_regionkey = 2) group by supp, cust, y", None),
    "tpch_q8": ("select y, round(sum(case when r = 2 then v else 0 end) / sum(v), 6) as share from (select cast(year(o_orderdate) as bigint) as y, l_extendedprice*(1-l_discount) as v, n_regionkey as r from {part} join {lineitem} on p_partkey=l_partkey join {orders} on o_orderkey=l_orderkey join {supplier} on s_suppkey=l_suppkey join {nation} on s_nationkey=n_nationkey where p_type = 'PROMO') group by y", None),
    "tpch_q10": ("select c_custkey, c_name, round(sum(l_extendedprice*(1-l_discount)),2) as revenue, n_name from {customer} join {orders} on c_custkey=o_custkey join {lineitem} on l_orderkey=o_orderkey join {nation} on n_nationkey=c_nationkey where l_returnflag='R' and o_orderdate >= timestamp_ntz '1997-01-01' and o_orderdate < timestamp_ntz '1997-04-01' group by c_custkey, c_name, n_name", "timestamp"),
    "tpch_q13": ("select n_orders, cast(count(*) as bigint) as n_customers from (select c_custkey, cast(count(o_orderkey) as bigint) as n_orders from {customer} left join {orders} on c_custkey=o_custkey group by c_custkey) group by n_orders", None),
    "tpch_q14": ("select round(100.0*sum(case when p_type like 'PROMO%' then l_extendedprice*(1-l_discount) else 0 end)/sum(l_extendedprice*(1-l_discount)),6) as promo from {lineitem}, {part} where l_partkey=p_partkey and l_shipdate >= timestamp_ntz '1996-09-01' and l_shipdate < timestamp_ntz '1996-10-01'", "timestamp"),
    "tpch_q15": ("with revenue as (select l_suppkey as k, round(sum(l_extendedprice*(1-l_discount)),2) as total from {lineitem} where l_shipdate >= timestamp_ntz '1996-01-01' and l_shipdate < timestamp_ntz '1996-04-01' group by l_suppkey) select s_suppkey, s_name, total from {supplier} join revenue on s_suppkey = k where total = (select max(total) from revenue)", "timestamp"),
    "tpch_q17": ("select round(sum(l_extendedprice)/7.0,2) as avg_yearly from {lineitem} join {part} on p_partkey=l_partkey join (select l_partkey as k, 0.2*avg(l_quantity) as lim from {lineitem} group by l_partkey) on k=l_partkey where l_quantity < lim and p_size < 25", None),
    "tpch_q18": ("select o_custkey, o_orderkey, round(sum(l_quantity),2) as q from {orders} join {lineitem} on o_orderkey=l_orderkey where o_orderkey in (select l_orderkey from {lineitem} group by l_orderkey having sum(l_quantity)>200) group by o_custkey,o_orderkey", None),
    "tpch_q19": ("select round(sum(l_extendedprice*(1-l_discount)),2) as revenue from {lineitem} join {part} on p_partkey=l_partkey where (p_size between 1 and 5 and l_quantity between 1 and 11) or (p_size between 6 and 10 and l_quantity between 10 and 20) or (p_size between 11 and 15 and l_quantity between 20 and 30)", None),
}


def _named(sql: str) -> list[str]:
    return [t for t in dict.fromkeys(re.findall(r"\{(\w+)\}", sql)) if t in TABLES]


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one text with its tables bound as DataFrames."""
    return spark.sql(sql, **{t: read_table(spark, sf_dir, t) for t in _named(sql)})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda s, d, sql=sql: run(s, d, sql)) for name, (sql, _) in SQL.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (sql, other) in SQL.items():
        text = sql.replace("timestamp_ntz '", "timestamp '") if other == "timestamp" else other or sql
        out[name] = text.format(**{t: t for t in TABLES})
    return out
