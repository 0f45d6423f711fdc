"""Schema versions: v and one to three numbers without leading zeros."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATTERN = r"^v(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){0,2}$"


def parse(version: Column) -> Column:
    """array<int> of major, minor, patch; null if the version is malformed. Arrays compare in order."""
    parts = F.split(F.substring(version, 2, 1000), r"\.").cast("array<int>")
    padded = F.slice(F.concat(parts, F.array(F.lit(0), F.lit(0))), 1, 3)
    return F.when(version.rlike(PATTERN), padded)


def compatible(source: Column, target: Column) -> Column:
    """Whether target has source's major version and is not below it; null if either is malformed."""
    a, b = parse(source), parse(target)
    return (a[0] == b[0]) & (b >= a)


def resolve(requests: DataFrame, registered: DataFrame, *, lowest: bool, out: str = "resolved") -> DataFrame:
    """requests(event_type, version, ...) with the version that serves each, null if none.

    lowest: the least registered version of the same major not below the request (for producers);
    otherwise the greatest not above it (for consumers). An exact match is either's answer. registered
    (event_type, version) is grouped to one small array for each type, so requests are joined once on
    the type, however many versions there are.
    """
    own = registered.select("event_type", "version").distinct().where(parse(F.col("version")).isNotNull())
    lists = own.groupBy("event_type").agg(F.array_sort(F.collect_list(F.struct(parse(F.col("version")).alias("k"), F.col("version").alias("v")))).alias("__all"))
    asked = parse(F.col("version"))
    joined = requests.withColumn("__k", asked).join(lists, "event_type", "left")
    same = F.filter("__all", lambda x: (x["k"][0] == F.col("__k")[0]) & ((x["k"] >= F.col("__k")) if lowest else (x["k"] <= F.col("__k"))))
    exact = F.filter(F.col("__all"), lambda x: x["v"] == F.col("version"))
    best = F.coalesce(F.get(exact, F.lit(0))["v"], F.element_at(F.col("__same"), 1 if lowest else -1)["v"])
    return joined.withColumn("__same", same).withColumn(out, F.when(F.size("__same") > 0, best)).drop("__all", "__same", "__k")
