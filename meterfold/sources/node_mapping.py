"""Assignment of one plant's meters to the nodes of its reporting tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Node and device, by group. A device written with a comma is one composite id.
NODE_OF_DEVICE = {
    "electricity": """
        10041000000 1-8L
        10041000002 2-1L
        10041000003 2-4L
        10041000004 2-3L
        10041000006 1-3L
        10041000007 1-5L
        10041000008 1-6L
        10041000010 2-5L
        10041000011 2-2L
        10041000013 3-1L
        10041000058 1-10L
        10041000060 4-7L
        10041000061 4-8L
        10041000063 23-1L
        10041000054 9-11L
        10041000055 9-12L
        10041000056 9-13L
        10041000057 9-14L
        10041000065 11-9L
        10041000050 22-1L
        10041000051 22-4L
        10041000052 22-2L
        10041000053 22-3L
        10041000049 18-4L
    """,
    "water": """
        10051000000 18-3L
        10051000003 6-8L,6-9L
        10051000004 6-7L
        10051000005 6-10L
        10051000006 6-12L
        10051000007 6-11L
        10051000008 6-3L
        10051000009 6-4L
        10051000010 6-1L
        10051000011 6-2L
        10051000012 6-5L
        10051000030 19-1L
        10051000031 19-2L
        10051000013 6-13L
        10051000018 22-5L
        10051000019 18-5L
        10051000015 6-6L
        10051000016 14-1L
        10051000020 12-2L
        10051000021 12-3L
        10051000022 12-4L
        10051000023 12-5L
        10051000024 12-6L
        10051000025 12-7L
        10051000026 12-8L
        10051000027 12-10L
        10051000028 12-11L
    """,
    "air": """
        10071000001 8-1L
        10071000003 8-3L
        10071000004 8-4L
        10071000005 8-5L
        10071000006 8-6L
        10071000007 8-7L
        10071000008 8-8L
        10071000009 8-9L
        10071000010 8-15L
        10071000012 8-11L
        10071000013 8-12L
        10071000014 8-13L
        10071000015 8-14L
        10071000016 6-14L
        10071000017 6-15L
        10071000018 6-16L
        10071000019 6-20L
        10071000020 6-17L
        10071000021 6-19L
        10071000022 6-18L
        10071000002 8-2L
        10071000011 8-10L
    """,
    "nitrogen": """
        10141000002 24-2L
        10141000003 24-3L
    """,
    "steam": """
        10061000000 18-1L
        10061000001 13-11L
        10061000002 13-12L
        10061000003 13-13L
        10061000004 13-14L
        10061000005 13-15L
        10061000006 13-16L
        10061000007 13-17L
        10061000008 13-18L
        10061000009 13-19L
        10061000010 10-7L
        10061000011 14-6L
        10061000013 13-20L
        10061000014 2-7L
        10061000015 2-8L
        10061000012 18-2L
    """,
    "key equipment": """
        10081000055 15-1L
        10081000056 15-2L
        10081000057 15-3L
        10081000058 15-4L
        10081000059 15-5L
        10081000060 15-6L
        10081000061 15-7L
        10081000062 15-8L
        10081000063 15-9L
        10081000064 16-10L
        10081000065 16-11L
        10081000066 15-12L
        10081000067 16-13L
        10081000068 16-14L
        10081000069 15-15L
        10081000070 16-16L
        10081000071 16-17L
        10081000072 16-18L
        10081000073 17-19L
        10081000074 17-20L
        10081000075 17-21L
        10081000076 14-22L
    """,
    "environmental": """
        10121000001 21-1L
        10121000002 21-2L,27-1L
        10121000003 21-3L
        10121000004 20-1L
        10121000005 20-2L
        10121000006 20-3L
        10121000007 1-9L
        10121000008 3-2L
        10121000009 10-6L
        10121000010 3-3L
        10121000011 25-1L
        10121000012 9-16L
        10121000013 9-18L
        10121000014 9-19L
        10121000015 9-20L
        10121000016 9-21L
        10121000017 9-17L
        10121000018 16-19L
        10121000019 16-20L
        10121000020 16-21L
        10121000021 16-22L
        10121000022 16-23L
        10121000023 16-24L
        10121000024 17-1L
        10121000025 17-2L
        10121000026 17-3L
        10121000027 17-4L
        10121000028 26-1L
        10121000029 26-2L
    """,
}


def node_mapping(spark: SparkSession) -> DataFrame:
    """The assignment as ``device_id, node_id``."""
    pairs = [line.split() for group in NODE_OF_DEVICE.values() for line in group.strip().splitlines()]
    rows = ", ".join(f"('{device}', '{node}')" for node, device in pairs)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(device_id, node_id)")
