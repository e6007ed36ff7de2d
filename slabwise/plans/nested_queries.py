"""Nested rows to cells: unrolling, flattening, splitting, naming."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabwise.functions import delinearize, linearize
from slabwise.operators import (
    array_member_to_cols,
    compound_to_attrs,
    flatten_compound,
    name_attrs,
    name_dims,
    pack_ragged,
    scalar_array,
    split_attrs,
    unroll,
    unpack_lists,
    unpack_ragged,
    unroll_nested,
    vlen_unwrap,
)
from slabwise.plans.array_queries import CELLS_SQL, cells, frame_schema, frames
from slabwise.plans.registry import query, table


@query("unroll", CELLS_SQL)
def _unroll(spark, sf_dir):
    return cells(spark, sf_dir)


@query("unroll_nested", CELLS_SQL)
def _unroll_nested(spark, sf_dir):
    """The same cells from frames stored as arrays of rows."""
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice(F.col("value"), r * 8 + 1, F.lit(8))
    )
    nested = frames(spark, sf_dir).withColumn("value", rows)
    flat = unroll_nested(nested, ["unnamed0"], "value", 2, "value")
    return flat.withColumn("value", F.col("value").cast("double"))


@query(
    "linearize",
    f"""
    SELECT unnamed0 * 64 + unnamed1 * 8 + unnamed2 AS position, unnamed0 AS back0,
           unnamed1 AS back1, unnamed2 AS back2, value
    FROM ({CELLS_SQL})
    """,
)
def _linearize(spark, sf_dir):
    shape = frame_schema(spark, sf_dir).shape
    coords = [F.col(f"unnamed{i}") for i in range(3)]
    placed = cells(spark, sf_dir).select(linearize(coords, shape).alias("position"), "value")
    back = [c.alias(f"back{i}") for i, c in enumerate(delinearize(F.col("position"), shape))]
    return placed.select("position", *back, "value")


@query(
    "compound_to_attrs",
    "SELECT p_partkey AS unnamed0, p_brand, p_type, p_size, p_retailprice FROM part",
)
def _compound_to_attrs(spark, sf_dir):
    record = F.struct("p_brand", "p_type", "p_size", "p_retailprice")
    records = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("unnamed0"), record.alias("rec"))
    return compound_to_attrs(records, "rec")


@query(
    "flatten_compound",
    """
    SELECT event_id, json_extract(props, '$.k')::INTEGER AS props_k, user_id AS who_id,
           event_type AS who_did_type, value AS who_did_value
    FROM events
    """,
)
def _flatten_compound(spark, sf_dir):
    did = F.struct(F.col("event_type").alias("type"), F.col("value").alias("value"))
    who = F.struct(F.col("user_id").alias("id"), did.alias("did"))
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"), who.alias("who")
    )
    return flatten_compound(nested)


@query(
    "array_member_to_cols",
    f"SELECT vec_id, {', '.join(f'embedding[{i + 1}]::DOUBLE AS m_{i}' for i in range(64))} FROM embeddings",
)
def _array_member_to_cols(spark, sf_dir):
    member = F.col("embedding").cast("array<double>").alias("m")
    return array_member_to_cols(table(spark, sf_dir, "embeddings").select("vec_id", member), "m", 64)


@query(
    "vlen_unwrap",
    """
    SELECT page_id, part AS unnamed1, word AS text, length(word) AS chars FROM (
        SELECT page_id, unnest(range(len(words))) AS part, unnest(words) AS word
        FROM (SELECT page_id, string_split(url, '/') AS words FROM pages))
    """,
)
def _vlen_unwrap(spark, sf_dir):
    """A page's URL as a variable-length list of records."""
    record = F.transform(
        F.split("url", "/"),
        lambda w: F.struct(w.alias("text"), F.length(w).cast("bigint").alias("chars")),
    )
    ragged = table(spark, sf_dir, "pages").select("page_id", record.alias("words"))
    return vlen_unwrap(ragged, ["page_id"], "words", "unnamed1")


@query(
    "split_attrs",
    """
    SELECT l_orderkey, l_linenumber, 'l_quantity' AS attr, l_quantity AS value FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'l_tax' AS attr, l_tax AS value FROM lineitem
    """,
)
def _split_attrs(spark, sf_dir):
    return split_attrs(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])


@query(
    "name_attrs",
    """
    SELECT p_partkey AS unnamed0, p_name AS str1, p_brand AS str2, p_type AS str3,
           p_size AS int4, p_retailprice AS float5 FROM part
    """,
)
def _name_attrs(spark, sf_dir):
    named = name_dims(table(spark, sf_dir, "part"), ["p_partkey"])
    return name_attrs(named, ["unnamed0"])


@query(
    "name_dims",
    f"SELECT unnamed0 AS dim0, unnamed1 AS dim1, unnamed2 AS dim2, value FROM ({CELLS_SQL})",
)
def _name_dims(spark, sf_dir):
    raw = unroll(
        table(spark, sf_dir, "embeddings"), ["vec_id"], "embedding", (8, 8), "value", dims=["row", "col"]
    )
    named = name_dims(raw, ["vec_id", "row", "col"], prefix="dim")
    return named.withColumn("value", F.col("value").cast("double"))


@query("scalar_array", "SELECT 0::BIGINT AS unnamed0, s_suppkey, s_acctbal FROM supplier")
def _scalar_array(spark, sf_dir):
    """Each supplier's balance as a scalar dataset: one cell at coordinate 0."""
    return scalar_array(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"))


RAGGED_SQL = "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) - 1 AS place, l_extendedprice FROM lineitem"


def price_lists(spark, sf_dir):
    """A list of prices per order, orders without lines included."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_extendedprice"))).alias("lines")
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return orders.join(lines, "l_orderkey", "left").select("l_orderkey", F.col("lines.l_extendedprice").alias("price"))


@query(
    "ragged_cells",
    f"SELECT l_orderkey, place AS unnamed1, l_extendedprice AS price FROM ({RAGGED_SQL}) WHERE l_orderkey IN (SELECT o_orderkey FROM orders)",
)
def _ragged_cells(spark, sf_dir):
    """Lists of any length as blocks of a hundred values and offsets, then as cells."""
    offsets, blocks = pack_ragged(price_lists(spark, sf_dir), "l_orderkey", "price", block=100)
    return unpack_ragged(offsets, blocks, "l_orderkey", "price", "unnamed1", block=100)


@query(
    "ragged_lists",
    f"""
    SELECT o_orderkey AS l_orderkey, coalesce(string_agg(floor(l_extendedprice * 100)::BIGINT::VARCHAR, ' ' ORDER BY place), '') AS prices,
           count(place) AS length FROM orders LEFT JOIN ({RAGGED_SQL}) ON o_orderkey = l_orderkey GROUP BY o_orderkey
    """,
)
def _ragged_lists(spark, sf_dir):
    """And back to one list per order, empty ones too."""
    offsets, blocks = pack_ragged(price_lists(spark, sf_dir), "l_orderkey", "price", block=100)
    lists = unpack_lists(offsets, blocks, "l_orderkey", "price", block=100).join(offsets, "l_orderkey")
    text = F.array_join(F.transform("price", lambda v: F.floor(v * 100).cast("string")), " ")
    return lists.select("l_orderkey", text.alias("prices"), "length")
