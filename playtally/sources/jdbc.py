"""JDBC table scans, in both reader styles.

``style="options"`` is ``spark.read.format("jdbc").option(...).load()``;
``style="method"`` is ``spark.read.jdbc(url, table, properties=...)``. Both
give the same lazy DataFrame; its schema is read from the database.

At scale a single-connection read is one task: pass ``partition_column``
with ``lower_bound``, ``upper_bound`` and ``num_partitions`` so every task
reads one stride of the key range over its own connection. Filters and
projections applied to the result are pushed into the database query by
Catalyst (``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int | None = 10_000,
                 extra: dict[str, str] | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    elif num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    opts.update(extra or {})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, style: str = "options", **kwargs) -> DataFrame:
    opts = jdbc_options(url, table, **kwargs)
    if style == "options":
        return spark.read.format("jdbc").options(**opts).load()
    if style == "method":
        props = {k: v for k, v in opts.items() if k not in ("url", "dbtable", "partitionColumn",
                                                              "lowerBound", "upperBound", "numPartitions")}
        if "partitionColumn" in opts:
            return spark.read.jdbc(url, table, column=opts["partitionColumn"],
                                   lowerBound=int(opts["lowerBound"]), upperBound=int(opts["upperBound"]),
                                   numPartitions=int(opts["numPartitions"]), properties=props)
        return spark.read.jdbc(url, table, properties=props)
    raise ValueError(f"unknown style {style!r}")
