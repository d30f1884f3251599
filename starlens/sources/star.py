"""The star schema as a mapping of table name to DataFrame.

Four ways to obtain it, all lazy:

* ``Star.from_fixtures``: views over the TPC-H-like test tables;
* ``Star.from_parquet``: the tables written by the ingest sink
  (``<root>/<table>/``, one folder per table, read with the declared schema;
  a table that has no folder yet is empty);
* ``Star.from_jdbc``: the same tables in a relational database (filters are
  pushed down by Spark's JDBC source, facts are read in key ranges);
* ``Star.from_catalog``: catalog tables, such as those of ``sources.layout``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.plans.joins import Measure, small_tables
from starlens.sources.schemas import DIMENSIONS, FACTS, KEYS, SCHEMAS
from starlens.sources.versions import version_root

NOTE = "starlens.measure"  # property of a catalog view: what was counted over its table
# Bounds of the key ranges of a partitioned database read (ids begin with these).
RANGE_STARTS = "123456789abcdefghijklmnopqrstuvwxyz"


def stored_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One table under ``path``, with the sink's partition columns if any; empty where nothing is stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], SCHEMAS[table])
        raise


def key_ranges(key: str, parts: int) -> list[str]:
    """Predicates that cut a table into ``parts`` ranges of ``key``: every row
    meets exactly one (null keys the first), under any collation."""
    starts = [RANGE_STARTS[len(RANGE_STARTS) * k // parts] for k in range(1, parts)] if parts <= len(RANGE_STARTS) else list(RANGE_STARTS)
    if not starts:
        return ["1 = 1"]
    inner = [f"{key} >= '{a}' AND {key} < '{b}'" for a, b in zip(starts, starts[1:])]
    return [f"({key} < '{starts[0]}' OR {key} IS NULL)", *inner, f"{key} >= '{starts[-1]}'"]


class Star(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 known: Callable[[str], Measure | None] = lambda name: None):
        missing = set(SCHEMAS) - set(tables)
        if missing:
            raise ValueError(f"star tables missing: {sorted(missing)}")
        self.spark = spark
        self._tables = dict(tables)
        self._known = known
        self._small: dict[str, bool] = {}
        self._lock = threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if callable(self._tables[name]):
                self._tables[name] = self._tables[name]()
            return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def check_dimensions(self, *names: str) -> None:
        """Check the sizes of these dimensions (all by default) in one job, once for this star."""
        with self._lock:
            new = [n for n in names or DIMENSIONS if n not in self._small]
            known = {n: m for n in new if (m := self._known(n))}
            self._small |= small_tables({n: self[n] for n in new}, KEYS, known)

    def broadcast(self, df: DataFrame, *made_of: str) -> DataFrame:
        """``df``, a filter, projection or key join of the named dimensions, hinted if all of them are small."""
        self.check_dimensions(*made_of)
        return F.broadcast(df) if all(self._small[n] for n in made_of) else df

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Star":
        """Views over read-only fixture tables; a source table is read when a view of it is first used."""
        from starlens.sources.fixtures import star_views

        return cls(spark, star_views(spark, sf_dir))

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "Star":
        root = version_root(spark, root)

        def read(name: str) -> DataFrame:
            stored = stored_table(spark, f"{root}/{name}", name)
            return stored.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields])

        return cls(spark, {name: lambda n=name: read(n) for name in SCHEMAS})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: Mapping[str, str], partitions: int = 16) -> "Star":
        """Facts are read over ``partitions`` connections, each a range of the key; dimensions over one."""

        def read(name: str) -> DataFrame:
            ranges = key_ranges(KEYS[name], partitions) if name in FACTS else ["1 = 1"]
            return spark.read.jdbc(url, name, predicates=ranges, properties=dict(properties)).select(*SCHEMAS[name].names)

        return cls(spark, {name: lambda n=name: read(n) for name in SCHEMAS})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "Star":
        """Catalog tables, e.g. the layout of ``sources.layout``, whose views carry what was counted over dimensions."""

        def known(name: str) -> Measure | None:
            for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{name}").collect():  # a few rows
                if r["key"] == NOTE:
                    return Measure.noted(r["value"])
            return None

        return cls(spark, {name: lambda n=name: spark.table(f"{database}.{n}").select(*SCHEMAS[n].names) for name in SCHEMAS}, known)
