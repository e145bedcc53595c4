"""The model of the driver tables."""

from __future__ import annotations

from queryset.sources.context import Context
from queryset.sources.model import Collection, EntityType, Model, Reference, Skip

MODEL = Model(
    EntityType("region", "region", ("r_regionkey",), {"nations": Collection("nation", ("n_regionkey",))}),
    EntityType(
        "nation",
        "nation",
        ("n_nationkey",),
        {"region": Reference("region", ("n_regionkey",)), "customers": Collection("customer", ("c_nationkey",)), "suppliers": Collection("supplier", ("s_nationkey",))},
    ),
    EntityType("customer", "customer", ("c_custkey",), {"nation": Reference("nation", ("c_nationkey",)), "orders": Collection("orders", ("o_custkey",))}),
    EntityType(
        "supplier",
        "supplier",
        ("s_suppkey",),
        {"nation": Reference("nation", ("s_nationkey",)), "lines": Collection("lineitem", ("l_suppkey",)), "parts": Skip("part", "lineitem", ("l_suppkey",), ("l_partkey",))},
    ),
    EntityType("part", "part", ("p_partkey",), {"lines": Collection("lineitem", ("l_partkey",)), "suppliers": Skip("supplier", "lineitem", ("l_partkey",), ("l_suppkey",))}),
    EntityType("orders", "orders", ("o_orderkey",), {"customer": Reference("customer", ("o_custkey",)), "lines": Collection("lineitem", ("l_orderkey",))}),
    EntityType("open_orders", "orders", ("o_orderkey",), {"customer": Reference("customer", ("o_custkey",))}, filters={"not_finished": lambda o: o.o_orderstatus != "F"}),
    EntityType(
        "lineitem",
        "lineitem",
        ("l_orderkey", "l_linenumber"),
        {"order": Reference("orders", ("l_orderkey",)), "part": Reference("part", ("l_partkey",)), "supplier": Reference("supplier", ("l_suppkey",))},
    ),
    EntityType("events", "events", ("event_id",)),
    EntityType("click_events", "events", ("event_id",), base="events", discriminator=("event_type", "click")),
    EntityType("documents", "documents", ("doc_id",)),
    EntityType("embeddings", "embeddings", ("vec_id",)),
    EntityType("labels", "labels", ("doc_id",), {"document": Reference("documents", ("doc_id",), required=False)}),
    EntityType("customer_names", "customer", (), defining=lambda ctx: ctx.customer.select(lambda c: _names(c))),
)


def _names(c):
    from queryset.functions.expr import record

    return record(c_name=c.c_name, c_mktsegment=c.c_mktsegment)


def context(spark, folder: str, tables=None) -> Context:
    return Context(spark, folder, MODEL, tables)
