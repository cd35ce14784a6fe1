"""Connected components of rows that share keys, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.session import release, stored


def connected(members: DataFrame) -> DataFrame:
    """(id, label) of members (id, key): the smallest id that each one reaches over shared keys.

    A round hands every key the smallest label of its members and back. Who finds
    a smaller one passes it to its old label as well, and each label then takes
    over its label's label. So labels jump over what is already joined, and a
    chain of n members takes some log(n) rounds. A key is folded on the map side.
    """
    keys = stored(members.select("id", "key").distinct())
    labels = stored(members.select("id").distinct().withColumn("label", F.col("id")))
    while True:
        lowest = keys.join(labels, "id").groupBy("key").agg(F.min("label").alias("low"))
        found = keys.join(lowest, "key").groupBy("id").agg(F.min("low").alias("low"))
        met = labels.join(found, "id").where("low < label").select("id", "label", "low")
        told = met.select("id", "low").unionByName(met.select(F.col("label").alias("id"), "low")).groupBy("id").agg(F.min("low").alias("low"))
        new = stored(labels.join(told, "id", "left").select("id", F.least("label", F.coalesce("low", "label")).alias("label"), F.col("low").isNotNull().alias("moved")))
        release(labels)
        if new.where("moved").isEmpty():
            release(keys)
            return new.select("id", "label")
        above = new.select(F.col("id").alias("label"), F.col("label").alias("top"))
        labels = stored(new.drop("moved").join(above, "label").select("id", F.least("label", "top").alias("label")))
        release(new)
