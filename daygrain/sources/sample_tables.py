"""The sample star schema seen as the five generic sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions.storage import reliable
from daygrain.names import GENERIC
from daygrain.operators.aggregates import build_entity_day, enrich_incident
from daygrain.operators.clean import CLEANERS
from daygrain.operators.lineage import add_lineage, record_hash

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
MEASURE_TYPES = ("view", "click", "purchase")
BATCH, EXTRACTED = "B20240201T000000Z", "2024-02-01T00:00:00+00:00"


SOURCES = ("registry", "measure", "typed", "incident", "context")


class OnDemand(Mapping):
    """Tables built when first asked for, so a query pays only for what it reads."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


class SampleTables:
    """Views over one data folder, made when asked for. Stored tables, size checks and model fits run jobs when they are."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int")
        return self.read("events").withColumn("k", k)

    @cached_property
    def registry_raw(self) -> DataFrame:
        customer, nation, region = self.read("customer"), self.read("nation"), self.read("region")
        return (
            customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("entity_id"),
                F.col("r_name").alias("region"),
                F.col("n_name").alias("city"),
                F.col("c_mktsegment").alias("kind"),
                F.col("c_acctbal").alias("capacity"),
            )
        )

    @cached_property
    def measure_raw(self) -> DataFrame:
        """Some speeds missing and some volumes out of range, so that cleaning matters."""
        return self.events.where(F.col("event_type").isin(*MEASURE_TYPES)).select(
            F.col("event_id").alias("sensor_id"),
            "ts",
            F.col("user_id").alias("entity_id"),
            (F.col("k") * 10 - 100).alias("volume"),
            F.when(F.col("k") % 10 != 9, F.col("value")).alias("speed"),
        )

    @cached_property
    def typed_raw(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("typed_id"),
            "ts",
            F.col("user_id").alias("entity_id"),
            "event_type",
            F.col("value").alias("amount"),
        )

    @cached_property
    def incident_raw(self) -> DataFrame:
        value, k = F.col("value"), F.col("k")
        severity = (
            F.when(value <= 10, "Minor")
            .when(value <= 40, "Moderate")
            .when(value <= 90, "Severe")
            .otherwise("Fatal")
        )
        return self.events.where("event_type = 'error'").select(
            F.col("event_id").alias("incident_id"),
            "ts",
            F.col("user_id").alias("entity_id"),
            (1 + k % 5).alias("vehicles"),
            F.when(k % 7 != 0, k % 4).alias("injuries"),
            (k >= 85).cast("int").alias("fatalities"),
            F.when(F.hour("ts").between(6, 17), "Day").otherwise("Night").alias("lighting"),
            severity.alias("severity"),
        )

    @cached_property
    def context_raw(self) -> DataFrame:
        k = F.col("k")
        mode = F.when(k % 4 == 0, "Clear").when(k % 4 == 1, "Dust").when(k % 4 == 2, "Rain").otherwise("Fog")
        places = self.registry_raw.select("entity_id", "region", "city")
        return (
            self.events.where("event_type = 'signup'")
            .join(places, F.col("user_id") == F.col("entity_id"))
            .select(
                F.col("event_id").alias("context_id"),
                "ts",
                "region",
                "city",
                mode.alias("mode"),
                (F.col("value") / 10).alias("visibility"),
                ((k % 7).cast("double") / 2).alias("precip"),
                (20 + k % 15).cast("double").alias("temp"),
            )
        )

    @cached_property
    def raw(self) -> Mapping[str, DataFrame]:
        return OnDemand({name: partial(getattr, self, f"{name}_raw") for name in SOURCES})

    def _stage(self, name: str) -> DataFrame:
        df = self.raw[name]
        hashed = [c for c, t in df.dtypes if t in ("string", "int", "bigint")]
        return record_hash(add_lineage(df, f"{name}_feed", BATCH, EXTRACTED), hashed)

    @cached_property
    def staged(self) -> Mapping[str, DataFrame]:
        """Raw tables with lineage; the hash covers the columns both engines print alike."""
        return OnDemand({name: partial(self._stage, name) for name in SOURCES})

    def _clean(self, name: str) -> DataFrame:
        df = CLEANERS[name](self.staged[name], GENERIC)
        return df.withColumn("ts", F.col("ts").cast("timestamp_ntz")) if "ts" in df.columns else df

    @cached_property
    def clean(self) -> Mapping[str, DataFrame]:
        return OnDemand({name: partial(self._clean, name) for name in SOURCES})

    @cached_property
    def incident(self) -> DataFrame:
        """Cleaned incidents with registry attributes and hourly context."""
        return enrich_incident(self.clean, GENERIC)

    @cached_property
    def entity_day(self) -> DataFrame:
        return build_entity_day(self.clean, GENERIC)

    @cached_property
    def stored_incident(self) -> DataFrame:
        """Stored: for work that reads the table several times."""
        return reliable(self.incident)

    @cached_property
    def stored_day(self) -> DataFrame:
        return reliable(self.entity_day)

    @cached_property
    def governed(self) -> Mapping[str, DataFrame]:
        """The tables that quality rules and profiles look at."""
        return OnDemand(
            {
                "registry": lambda: self.clean["registry"],
                "incident": lambda: self.stored_incident,
                "typed": lambda: self.clean["typed"],
                "measure": lambda: self.clean["measure"],
                "entity_day": lambda: self.stored_day,
            }
        )
