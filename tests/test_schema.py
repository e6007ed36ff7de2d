import pytest
from pyspark.sql import functions as F

from slabwise import ArrayError, ArraySchema, Attr, Dim, chunk_plan
from slabwise.schema import UNLIMITED, chunk_plan_column

PLANS = [
    ((42247, 1024, 1024), (1, 1024, 1024)),
    ((42247,), (42247,)),
    ((4072, 4000), (1, 4000)),
    ((500, 64), (500, 64)),
    ((3, 1000, 500000), (1, 1, 500000)),
    ((2, 1000, 500000), (2, 1, 500000)),
    ((0,), (0,)),
    ((2000000,), (1048576,)),
    ((5, 2000000), (1, 1048576)),
    ((5, 0, 3), (5, 0, 3)),
]


@pytest.mark.parametrize("shape,plan", PLANS)
def test_chunk_plan(shape, plan):
    assert chunk_plan(shape) == plan


def test_chunk_plan_column_agrees(spark):
    rows = spark.createDataFrame([(list(s), list(p)) for s, p in PLANS], "dims array<bigint>, plan array<bigint>")
    wrong = rows.where(chunk_plan_column(F.col("dims")) != F.col("plan"))
    assert wrong.collect() == []


def test_inside_dimensions_are_never_split():
    assert chunk_plan((42247, 1024, 1024), inside=2) == (1, 1024, 1024)
    assert chunk_plan((10, 2000, 1000), inside=2) == (1, 2000, 1000)
    assert chunk_plan((500, 8, 8), inside=2) == (500, 8, 8)


def test_show_matches_published_examples():
    seconds = ArraySchema(
        "frametime",
        (Attr("seconds", "uint32"), Attr("nanoseconds", "uint32")),
        (Dim("unnamed0", 42247, limit=UNLIMITED),),
    ).planned()
    assert seconds.show() == (
        "frametime<seconds:uint32 NOT NULL,nanoseconds:uint32 NOT NULL> [unnamed0=0:9223372036854775807,42247,0]"
    )
    image = ArraySchema("sky", (Attr("unknown", "float"),), (Dim("dim0", 4072), Dim("dim1", 4000)))
    # The last valid coordinate, not the extent, is shown.
    assert image.show() == "sky<unknown:float NOT NULL> [dim0=0:4071,4072,0,dim1=0:3999,4000,0]"


def test_json_round_trip_and_metadata(spark):
    schema = ArraySchema("a", (Attr("v", "int16"),), (Dim("i", 4, inside=False), Dim("j", 3, 2, 9, True)))
    assert ArraySchema.from_json(schema.to_json()) == schema
    df = schema.attach(spark.range(1).select(F.col("id").alias("i")))
    assert ArraySchema.of(df) == schema
    with pytest.raises(ArrayError):
        ArraySchema.of(spark.range(1))
