"""Registered queries over change statements, row picking, sources and ingestion."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from outpost.functions.uri import parse_endpoint
from outpost.operators import change, recursive, rows
from outpost.operators.change import When
from outpost.operators.joins import lookup_join
from outpost.sources import TABLES, read_table
from outpost.sources.namespace import CatalogError, attach, lookup
from outpost.streaming import ingest


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared folder that the cluster names, or on this machine if all executors are on it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}" if base else "file://" + tempfile.mkdtemp(prefix="outpost-")


def b110_insert_select(spark, d):
    n, r = read_table(spark, d, "nation"), read_table(spark, d, "region")
    return change.insert(n, r.select((F.col("r_regionkey") + 100).alias("k"), F.col("r_name"), "r_regionkey")).after


def b111_insert_defaults(spark, d):
    n, r = read_table(spark, d, "nation"), read_table(spark, d, "region")
    return change.insert(n, r.select(F.col("r_regionkey") + 200), ["n_nationkey"], {"n_name": F.lit("unknown")}).after


def b112_upsert_update(spark, d):
    t = read_table(spark, d, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("v"))
    s = read_table(spark, d, "nation").where("n_nationkey >= 10").select(F.col("n_nationkey").alias("k"), (F.col("n_regionkey") * 10).alias("v"))
    return change.upsert(t, s, ["k"], {"v": F.col("s.v")}).after


def b112_upsert_nothing(spark, d):
    t = read_table(spark, d, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("v"))
    s = read_table(spark, d, "nation").where("n_nationkey >= 10").select(F.col("n_nationkey").alias("k"), (F.col("n_regionkey") * 10).alias("v"))
    return change.upsert(t, s, ["k"]).after


def b113_update(spark, d):
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return change.update(s, {"s_acctbal": F.col("s_acctbal") + 100}, F.col("s_nationkey") < 10).after


def b114_update_from(spark, d):
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    n = read_table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    return change.update_from(s, n, ["s_nationkey"], {"s_acctbal": F.col("s.n_regionkey") * 1000}).after


def b115_delete(spark, d):
    o = read_table(spark, d, "orders")
    mean = o.agg(F.avg("o_totalprice")).first()[0]
    return change.delete(o, F.col("o_totalprice") > mean).after.select("o_orderkey")


def b116_delete_using(spark, d):
    c, o = read_table(spark, d, "customer"), read_table(spark, d, "orders")
    return change.delete_using(c, o.where("o_totalprice > 300000"), c["c_custkey"] == o["o_custkey"]).after.select("c_custkey")


def _merged(spark, d):
    t = read_table(spark, d, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("v"))
    s = read_table(spark, d, "nation").where("n_nationkey >= 10").select(F.col("n_nationkey").alias("k"), (F.col("n_regionkey") * 10).alias("v"))
    return change.merge(t, s, ["k"], [
        When("matched", "delete", condition=F.col("s.v") > 30),
        When("matched", "update", {"v": F.col("s.v")}),
        When("not matched", "insert", {"k": F.col("s.k"), "v": F.col("s.v")}, F.col("s.v") < 40),
        When("not matched by source", "update", {"v": F.col("v") + 1}, F.col("k") < 5),
    ])


def b117_merge(spark, d):
    return _merged(spark, d).after


def b118_merge_returning(spark, d):
    return _merged(spark, d).returning("merge_action", "k", "v")


def b120_update_returning(spark, d):
    p = read_table(spark, d, "part")
    return change.update(p, {"p_size": F.col("p_size") * 2}, F.col("p_size") > 45).returning("p_partkey", F.col("p_size").alias("twice"))


def b124_affected_rows(spark, d):
    return change.delete(read_table(spark, d, "orders"), F.col("o_totalprice") > 300000).count()


def b56_distinct_on_operator(spark, d):
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rows.distinct_on(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey")


def b73_limit_subquery(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    n = read_table(spark, d, "nation").agg(F.count(F.lit(1)))
    return rows.limit_by(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], n, read_table(spark, d, "region").agg(F.count(F.lit(1)))).select("o_orderkey")


def b38_join_duplicate_names(spark, d):
    n = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("i"))
    return rows.dedupe_names(n.alias("a").join(n.alias("b"), F.col("a.i") + 1 == F.col("b.i")))


def b39_checked_broadcast_join(spark, d):
    c, n = read_table(spark, d, "customer"), read_table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return lookup_join(c, n, ["c_nationkey"]).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


def a46_catalog_tables(spark, d):
    """Tables and columns as the attached folder has them; only those of the driver, should there be others."""
    return attach(spark, d, "here", read_only=True).columns().where(F.col("table_name").isin(*TABLES)).select("table_name", "column_name")


def a72_endpoint_parser(spark, d):
    uri = F.concat(F.lit("outpost:"), F.concat_ws(".", F.lower("n_name"), F.lit("example.org")), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit(":"), (F.col("n_nationkey") + 9000).cast("string"))).otherwise(""))
    return read_table(spark, d, "nation").select("n_nationkey", parse_endpoint(uri, "outpost").alias("e")).select("n_nationkey", "e.host", "e.port", "e.url")


def s1_ordered_ingest(spark, d):
    """Events arrive in batches out of order, one of them twice; what is read back is the events in order."""
    path = _scratch(spark)
    events = read_table(spark, d, "events").select("event_id", "user_id", "value")
    for batch in (2, 0, 3, 1, 2):
        ingest.write_batch(events.where(F.floor(F.col("event_id") % 4) == batch), batch, path)
    return ingest.read_batches(spark, path, "event_id", total=4)


def _times(factor: int, n: int):
    """``k`` multiplied by ``factor`` modulo ``n`` so many times; null if ``n`` is 0."""
    kind = "long" if n <= 3_000_000_000 else "decimal(19,0)"

    def power(f, m):
        product = F.col("k").cast(kind) * F.lit(pow(factor, m, n) if n else 0).cast(kind)
        return f.select(F.try_mod(product, F.lit(n).cast(kind)).cast("long").alias("k"))

    return power


def b99_recursive_union(spark, d):
    """Customers reachable from customer 1 by stepping to (2 k) and (3 k) modulo the number of customers."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_scratch(spark))
    n = read_table(spark, d, "customer").count()
    base = spark.range(1, 2).select(F.col("id").alias("k"))
    # a chain may have as many steps as there are customers; the two products commute
    return recursive.orbit(base, [_times(2, n), _times(3, n)])


def b70_null_keys(spark, d):
    """Orders by customer, a third of them without, and their places from either end."""
    t = read_table(spark, d, "orders").select("o_orderkey", F.expr("case when o_orderkey % 3 > 0 then o_custkey end").alias("k"))
    orders = {"at": [F.col("k").desc_nulls_last(), F.col("o_orderkey")], "up": [F.col("k").asc_nulls_first(), F.col("o_orderkey")]}
    # in the order of keys as well: those without a customer would be one part
    return rows.sorted_parts(rows.numbered(t, orders, _scratch(spark)), [*rows.nulls_last("k"), F.col("o_orderkey")], t.count())


def b140_scalar_function(spark, d):
    spark.sql("create or replace temporary function outpost_discounted(price double, cut double) returns double return price * (1 - cut)")
    li = read_table(spark, d, "lineitem")
    return spark.sql("select l_orderkey, l_linenumber, outpost_discounted(l_extendedprice, l_discount) as net from {li} where outpost_discounted(l_extendedprice, l_discount) > 90000", li=li)


def b141_table_function(spark, d):
    spark.sql("create or replace temporary function outpost_series(n int) returns table (i int) return select explode(sequence(1, n))")
    return spark.sql("select n_nationkey, i from {nation}, lateral outpost_series(3)", nation=read_table(spark, d, "nation"))


def b19_session_variable(spark, d):
    spark.sql("declare or replace variable outpost_floor double default 0")
    spark.sql("set var outpost_floor = 300000")
    return spark.sql("select o_orderkey from {orders} where o_totalprice > outpost_floor", orders=read_table(spark, d, "orders"))


def a86_prepared(spark, d):
    """The same statement with other values; tables are bound when it runs."""
    text = "select o_orderkey, o_totalprice from {orders} where o_totalprice > :floor and o_orderstatus = :status"
    run = lambda **values: spark.sql(text, args=values, orders=read_table(spark, d, "orders"))
    return run(floor=400000.0, status="F").unionByName(run(floor=450000.0, status="O"))


def a12_generators(spark, d):
    return spark.range(3, 12, 2).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("j"))


def b40_two_namespaces(spark, d):
    """The same folder attached twice, and a local frame, in one plan."""
    a, b = attach(spark, d, "a"), attach(spark, d, "b")
    local = spark.createDataFrame([(i,) for i in range(0, 25, 3)], "k int")
    nations = a.table("a.nation").join(local, F.col("n_nationkey") == F.col("k"))
    return nations.join(b.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


def b86_set_ops_over_namespaces(spark, d):
    """Tables of two namespaces and a local frame in one tree of set operations."""
    a, b = attach(spark, d, "a"), attach(spark, d, "b")
    local = spark.createDataFrame([(i,) for i in range(0, 25, 5)], "k int")
    both = a.table("supplier").select(F.col("s_nationkey").alias("k")).intersect(b.table("customer").select("c_nationkey"))
    return both.exceptAll(local).union(b.table("b.region").select("r_regionkey"))


def b100_changes_from_subquery(spark, d):
    """A named subquery feeds an insert, an update and a delete, one after another."""
    o, c = read_table(spark, d, "orders"), read_table(spark, d, "customer")
    keyed = c.select(F.col("c_custkey").alias("k"), F.round("c_acctbal", 2).alias("v"))
    spent = o.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("top"))
    rows = change.insert(keyed, spent.where("top > 400000").select((-F.col("k")).alias("k"), F.col("top").alias("v"))).after
    rows = change.update(rows, {"v": F.lit(0.0)}, F.col("k") % 2 == 0).after
    return change.delete(rows, F.col("v") < 0).after


def b134_alter_table(spark, d):
    """A table's columns dropped, renamed and added, published, then the table renamed."""
    shop = attach(spark, _scratch(spark), "shop")
    shop.create("s.nation", read_table(spark, d, "nation"))
    shop.alter("s.nation", drop=["n_regionkey"], rename={"N_NAME": "name"}, add={"active": F.lit(True), "info": F.struct(F.col("n_nationkey").alias("k"))})
    shop.alter("shop.s.nation", add={"info.twice": F.col("n_nationkey") * 2})
    shop.rename("s.nation", "country")
    return shop.table("s.country").select("n_nationkey", "name", "active", F.col("info.k").alias("k"), F.col("info.twice").alias("twice"))


def _customers(spark, d):
    return read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")


def b120_insert_returning(spark, d):
    new = read_table(spark, d, "region").select((F.col("r_regionkey") + 300).alias("k"), "r_name")
    return change.insert(read_table(spark, d, "nation"), new, ["n_nationkey", "n_name"], {"n_regionkey": F.lit(7)}).returning()


def b120_delete_returning(spark, d):
    return change.delete(_customers(spark, d), F.col("c_acctbal") < 0).returning("c_custkey", (-F.col("c_acctbal")).alias("owed"))


def b121_returning_expressions(spark, d):
    """RETURNING with a function and a scalar subquery."""
    top = read_table(spark, d, "orders").agg(F.max("o_totalprice")).scalar()
    c = change.update(_customers(spark, d), {"c_acctbal": F.lit(0.0)}, F.col("c_acctbal") > 9000)
    return c.returning("c_custkey", F.concat(F.lit("customer "), F.col("c_custkey").cast("string")).alias("label"), top.alias("top"))


def b101_change_feeds_change(spark, d):
    """What a delete returns is inserted elsewhere, and what that insert returns is updated."""
    gone = change.delete(_customers(spark, d), F.col("c_nationkey") == 3)
    kept = change.insert(_customers(spark, d).where("c_nationkey = 4"), gone.returning("c_custkey", "c_nationkey", "c_acctbal"))
    return change.update(kept.returning(), {"c_nationkey": F.lit(-1)}, F.col("c_acctbal") < 0).after


def b114_update_joined(spark, d):
    """UPDATE … FROM two joined sources with a predicate that is no equality of keys alone."""
    c, n, r = _customers(spark, d), read_table(spark, d, "nation"), read_table(spark, d, "region")
    source = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    on = (c["c_nationkey"] == source["n_nationkey"]) & (c["c_acctbal"] > source["r_regionkey"] * 1000)
    return change.update_where(c, source, on, {"c_acctbal": F.col("r_regionkey") * 10.0}, ["c_custkey"]).after


def b116_delete_using_joined(spark, d):
    c, n, r = _customers(spark, d), read_table(spark, d, "nation"), read_table(spark, d, "region")
    source = n.join(r, n["n_regionkey"] == r["r_regionkey"]).where("r_regionkey > 2")
    return change.delete_using(c, source, (c["c_nationkey"] == source["n_nationkey"]) & (c["c_acctbal"] < source["n_nationkey"] * 100)).after


def b117_merge_repeated_keys(spark, d):
    """Source keys that repeat, but match nothing, are each inserted; null keys match nothing."""
    t = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("v")).where("k < 5")
    s = read_table(spark, d, "nation").select(F.when(F.col("n_nationkey") < 22, F.col("n_nationkey") % 9).alias("k"), F.lit(50).alias("v")).where("k is null or k >= 5")
    return change.merge(t, s, ["k"], [When("matched", "update", {"v": F.col("s.v")}), When("not matched", "insert", {"k": F.col("s.k"), "v": F.col("s.v")})]).after


def b122_change_over_namespaces(spark, d):
    """A table of one namespace changed by a local frame and a table of another one."""
    here, shop = attach(spark, d, "here", read_only=True), attach(spark, _scratch(spark), "shop")
    shop.create("nation", here.table("nation"))
    local = spark.createDataFrame([(i,) for i in range(0, 25, 4)], "n_nationkey int")
    shop.apply("nation", change.delete_using(shop.table("nation"), local, ["n_nationkey"]))
    region = here.table("region").select((F.col("r_regionkey") + 400).alias("k"), "r_name", "r_regionkey")
    shop.apply("shop.nation", change.insert(shop.table("nation"), region))
    return shop.table("nation")


def b131_view(spark, d):
    """A stored view over a stored view and a table, read after the table has changed."""
    shop = attach(spark, _scratch(spark), "shop")
    shop.create("s.customer", _customers(spark, d))
    shop.create_view("s.rich", "select c_custkey, c_nationkey from {s.customer} where c_acctbal > 5000")
    shop.create_view("by_nation", "select c_nationkey, count(*) as n from {shop.s.rich} group by c_nationkey")
    shop.apply("s.customer", change.delete(shop.table("s.customer"), F.col("c_custkey") % 2 == 0))
    return shop.table("by_nation")


def b132_schema(spark, d):
    """Schemas made and dropped; what may not go stays."""
    shop = attach(spark, _scratch(spark), "shop")
    shop.create_schema("a")
    shop.create_schema("a.b")
    shop.create_schema("A", if_not_exists=True)
    region = read_table(spark, d, "region")
    shop.create("a.b.t", region)
    shop.create("c.t", region)
    said = []
    for name, what in (("again", lambda: shop.create_schema("A.B")), ("no parent", lambda: shop.create_schema("x.y")), ("not empty", lambda: shop.drop_schema("a")), ("no table", lambda: shop.drop("a.b")), ("missing", lambda: shop.drop_schema("z"))):
        try:
            what()
        except CatalogError:
            said.append((name, "error"))
    shop.drop_schema("a", cascade=True)
    shop.drop_schema("a", if_exists=True)
    left = shop.tables().select(F.concat_ws(".", "schema_name", "table_name").alias("name"), F.lit("left").alias("what"))
    return spark.createDataFrame(said, "name string, what string").union(left)


def b139_drop_if_exists(spark, d):
    shop = attach(spark, _scratch(spark), "shop")
    region = read_table(spark, d, "region")
    shop.create("t", region)
    shop.create("T", region.limit(0), if_not_exists=True)
    shop.create("u", region)
    shop.create("u", region.where("r_regionkey = 1"), replace=True)
    shop.drop("U2", if_exists=True)
    rows = shop.table("t").unionByName(shop.table("shop.u"))
    shop.create("both", rows)
    shop.drop("T")
    return shop.table("both")


def b137_search_path(spark, d):
    """An unqualified name found along a search path, and a qualified one."""
    here, shop = attach(spark, d, "here", read_only=True), attach(spark, _scratch(spark), "shop")
    shop.create("s.nation", read_table(spark, d, "nation").where("n_nationkey < 5"))
    found = lookup(spark, "nation", [here, shop], ["shop.s", "here"])
    return found.join(lookup(spark, "region", [here, shop], ["shop.s", "here"]), F.col("n_regionkey") == F.col("r_regionkey")).union(lookup(spark, "here.nation", [here, shop]).crossJoin(here.table("region").where("r_regionkey = 0")).where("n_nationkey = 7"))


def b138_local_first(spark, d):
    """A temporary view hides a table of the same name on the search path."""
    here = attach(spark, d, "here", read_only=True)
    name = "part"
    read_table(spark, d, "part").where("p_size = 1").createOrReplaceTempView(name)
    try:
        local = lookup(spark, name, [here], ["here"])
    finally:
        spark.catalog.dropTempView(name)
    far = lookup(spark, name, [here], ["here"]).where("p_size = 2")
    return local.unionByName(far).select("p_partkey", "p_size")


def b65_numbered_by_order(spark, d):
    """``row_number() over ()`` of a source with an order: numbered by that order, as rows have none of their own."""
    top = read_table(spark, d, "orders").where("o_totalprice > 300000").select("o_orderkey")
    return rows.numbered(top, {"n": [F.col("o_orderkey")]}, _scratch(spark))


_UPSERT = "from (select n_nationkey as k, n_regionkey as v from nation where n_nationkey < 15) t full join (select n_nationkey as k, n_regionkey * 10 as v from nation where n_nationkey >= 10) s on t.k = s.k"
_MERGE = f"""select case when t.k is not null and s.k is not null and s.v > 30 then 'DELETE' when t.k is not null and s.k is not null then 'UPDATE'
    when t.k is null and s.v < 40 then 'INSERT' when s.k is null and t.k < 5 then 'UPDATE' end as merge_action, coalesce(t.k, s.k) as k, t.k is not null as old,
    case when t.k is not null and s.k is not null and s.v > 30 then t.v when s.k is not null then s.v when t.k < 5 then t.v + 1 else t.v end as v {_UPSERT}"""

_ALL: dict[Callable[[SparkSession, str], DataFrame], str] = {
    b110_insert_select: "select * from nation union all select r_regionkey + 100, r_name, r_regionkey from region",
    b111_insert_defaults: "select * from nation union all select r_regionkey + 200, 'unknown', null from region",
    b112_upsert_update: f"select coalesce(t.k, s.k) as k, coalesce(s.v, t.v) as v {_UPSERT}",
    b112_upsert_nothing: f"select coalesce(t.k, s.k) as k, coalesce(t.v, s.v) as v {_UPSERT}",
    b113_update: "select s_suppkey, s_nationkey, case when s_nationkey < 10 then s_acctbal + 100 else s_acctbal end as s_acctbal from supplier",
    b114_update_from: "select s_suppkey, s_nationkey, case when n_regionkey is not null then cast(n_regionkey * 1000 as double) else s_acctbal end as s_acctbal from supplier left join (select * from nation where n_regionkey = 2) on n_nationkey = s_nationkey",
    b115_delete: "select o_orderkey from orders where not (o_totalprice > (select avg(o_totalprice) from orders))",
    b116_delete_using: "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)",
    b117_merge: f"select k, v from ({_MERGE}) where merge_action is distinct from 'DELETE' and (old or merge_action = 'INSERT')",
    b118_merge_returning: f"select merge_action, k, v from ({_MERGE}) where merge_action is not null",
    b120_update_returning: "select p_partkey, p_size * 2 as twice from part where p_size > 45",
    b124_affected_rows: "select count(*) as count from orders where o_totalprice > 300000",
    b56_distinct_on_operator: "select distinct on (o_custkey) o_custkey, o_orderkey from orders order by o_custkey, o_totalprice desc, o_orderkey",
    b73_limit_subquery: "select o_orderkey from orders order by o_totalprice desc, o_orderkey limit (select count(*) from nation) offset (select count(*) from region)",
    b38_join_duplicate_names: "select a.n_nationkey as i, b.n_nationkey as i_1 from nation a join nation b on a.n_nationkey + 1 = b.n_nationkey",
    b39_checked_broadcast_join: "select n_name, count(*) as n from customer join nation on n_nationkey = c_nationkey group by n_name",
    a46_catalog_tables: "select table_name, column_name from information_schema.columns where table_schema = 'main' and table_name in (" + ", ".join(f"'{t}'" for t in TABLES) + ")",
    b120_insert_returning: "select r_regionkey + 300 as n_nationkey, r_name as n_name, cast(7 as integer) as n_regionkey from region",
    b120_delete_returning: "select c_custkey, -c_acctbal as owed from customer where c_acctbal < 0",
    b121_returning_expressions: "select c_custkey, 'customer ' || c_custkey as label, (select max(o_totalprice) from orders) as top from customer where c_acctbal > 9000",
    b101_change_feeds_change: "select c_custkey, case when c_acctbal < 0 then -1 else c_nationkey end as c_nationkey, c_acctbal from customer where c_nationkey = 3",
    b114_update_joined: "select c_custkey, c_nationkey, case when c_acctbal > r_regionkey * 1000 then r_regionkey * 10.0::double else c_acctbal end as c_acctbal from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
    b116_delete_using_joined: "select c_custkey, c_nationkey, c_acctbal from customer join nation on c_nationkey = n_nationkey where not (n_regionkey > 2 and c_acctbal < n_nationkey * 100)",
    b117_merge_repeated_keys: "select n_nationkey as k, n_regionkey as v from nation where n_nationkey < 5 union all select k, 50 from (select case when n_nationkey < 22 then n_nationkey % 9 end as k from nation) where k is null or k >= 5",
    b122_change_over_namespaces: "select * from nation where n_nationkey % 4 <> 0 union all select r_regionkey + 400, r_name, r_regionkey from region",
    b131_view: "select c_nationkey, count(*) as n from customer where c_acctbal > 5000 and c_custkey % 2 = 1 group by c_nationkey",
    b132_schema: "select unnest(['again', 'no parent', 'not empty', 'no table', 'missing']) as name, 'error' as what union all select 'c.t', 'left'",
    b139_drop_if_exists: "select * from region union all select * from region where r_regionkey = 1",
    b137_search_path: "select * from nation join region on n_regionkey = r_regionkey where n_nationkey < 5 union all select * from nation, region where r_regionkey = 0 and n_nationkey = 7",
    b138_local_first: "select p_partkey, p_size from part where p_size in (1, 2)",
    b65_numbered_by_order: "select o_orderkey, row_number() over (order by o_orderkey) as n from orders where o_totalprice > 300000",
    a72_endpoint_parser: "select n_nationkey, lower(n_name) || '.example.org' as host, case when n_nationkey % 2 = 0 then n_nationkey + 9000 else 9494 end as port, 'http://' || lower(n_name) || '.example.org:' || (case when n_nationkey % 2 = 0 then n_nationkey + 9000 else 9494 end) as url from nation",
    b70_null_keys: "select o_orderkey, k, cast(row_number() over (order by k desc nulls last, o_orderkey) as bigint) as at, cast(row_number() over (order by k nulls first, o_orderkey) as bigint) as up from (select o_orderkey, case when o_orderkey % 3 > 0 then o_custkey end as k from orders) order by k nulls last",
    b99_recursive_union: "with recursive r as (select cast(1 as bigint) as k union select unnest([k * 2 % (select count(*) from customer), k * 3 % (select count(*) from customer)]) as k from r) select k from r",
    b140_scalar_function: "select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net from lineitem where l_extendedprice * (1 - l_discount) > 90000",
    b141_table_function: "select n_nationkey, cast(i as integer) as i from nation, (select unnest(range(1, 4)) as i)",
    b19_session_variable: "select o_orderkey from orders where o_totalprice > 300000",
    a86_prepared: "select o_orderkey, o_totalprice from orders where (o_totalprice > 400000 and o_orderstatus = 'F') or (o_totalprice > 450000 and o_orderstatus = 'O')",
    a12_generators: "select i, cast(j as integer) as j from (select unnest(range(3, 12, 2)) as i), (select unnest(range(1, 4)) as j)",
    b40_two_namespaces: "select n_name, r_name from nation join region on n_regionkey = r_regionkey where n_nationkey % 3 = 0",
    b86_set_ops_over_namespaces: "select k from ((select s_nationkey as k from supplier intersect select c_nationkey from customer) except all select cast(unnest(range(0, 25, 5)) as integer)) union all select r_regionkey from region",
    b100_changes_from_subquery: """select k, case when k % 2 = 0 then 0.0 else v end as v from (select c_custkey as k, round(c_acctbal, 2) as v from customer
        union all select -o_custkey, max(o_totalprice) from orders group by o_custkey having max(o_totalprice) > 400000) where not (case when k % 2 = 0 then 0.0 else v end < 0)""",
    b134_alter_table: "select n_nationkey, n_name as name, true as active, n_nationkey as k, n_nationkey * 2 as twice from nation",
    s1_ordered_ingest: "select event_id, user_id, value from events",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: sql for f, sql in _ALL.items()}
