"""Spaces and rows shared by the tests: a small harbour register."""

from stowage import Field, Index, SpaceSpec

VESSELS = SpaceSpec(
    (
        Field("imo", "unsigned"),
        Field("name", "string"),
        Field("berth_shard", "unsigned"),
        Field("flag", "string"),
        Field("tonnes", "number"),
        Field("in_port", "boolean", True),
        Field("holds", "array", True),
        Field("papers", "any", True),
        Field("radio", "map", True),
    ),
    (Index("imo", ("imo",)), Index("by_flag", ("flag",), unique=False), Index("by_name", ("name",))),
    bucket_field="berth_shard",
    shards=3,
)

VESSEL_COLUMNS = "imo int, name string, berth_shard int, flag string, tonnes double"
VESSEL_ROWS = [
    (11, "Amber Tide", None, "NO", 900.5),
    (12, "Quiet Sound", None, "DK", 120.0),
    (13, "Long Reach", None, "FI", 4400.25),
]


def vessels(spark):
    return spark.createDataFrame(VESSEL_ROWS, VESSEL_COLUMNS).coalesce(1)


def harbour(store):
    """``store`` with a space of three vessels."""
    store.create("vessels", VESSELS)
    store.write(vessels(store.spark), "vessels")
    return store


def ids(df, name="imo"):
    return sorted(r[0] for r in df.select(name).collect())
