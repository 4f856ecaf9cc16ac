"""The three layers of a lakehouse, each a job that can be run again at any time."""

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.decode import (
    decode_value,
    decode_with,
    payload_of,
    prefix_envelope,
    split_by_schema,
)
from lakeops.functions.decode import schema_id as decode_schema_id
from lakeops.functions.time import epoch_seconds
from lakeops.operators.impute import KeyMean, WindowMean, impute
from lakeops.operators.sinks import (
    BATCH,
    EPOCH,
    INGESTED_AT,
    RUN_ID,
    append_batch,
    append_table,
    compact,
    create_schema,
    ensure_partitioned,
    ingested_schema,
    last_run,
    overwrite_table,
    publish,
    read_layout,
    rows_of_runs,
)
from lakeops.plans.datasets import BRONZE, GOLD, SILVER, FileSource
from lakeops.sources.files import drain_files, read_file_stream
from lakeops.sources.kafka import read_kafka_stream
from lakeops.sources.tables import date_range, read_table
from lakeops.streaming.ingest import drain_batches
from lakeops.streaming.state import Run, StateTable, hand_over


def _lookup(specs: Mapping[str, Any], name: str, layer: str) -> Any:
    if name not in specs:
        raise ValueError(f"no {layer} dataset named {name!r}; there are {sorted(specs)}")
    return specs[name]


@dataclass(frozen=True)
class Lake:
    """Where the layers are. Paths must be visible to every executor.

    `prefix` stands before the names of the catalog schemas `bronze`, `silver`, `gold`.
    `sum_type` names a decimal type to sum in, so that tables do not depend on the order in
    which rows arrive. Days and hours are those of UTC: the session is set to that zone.
    """

    spark: SparkSession
    landing: str
    root: str
    fmt: str = "parquet"
    prefix: str = ""
    sum_type: str | None = None

    def __post_init__(self) -> None:
        self.spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, layer: str, name: str) -> str:
        return f"{self.prefix}{layer}.{name}"

    def _create_schema(self, layer: str) -> None:
        create_schema(self.spark, f"{self.prefix}{layer}", f"{self.root}/{layer}")

    def read_source(
        self,
        dataset: str,
        kafka: Mapping[str, str] | None = None,
        avro_schema: str | None = None,
        records: DataFrame | None = None,
        options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """The stream of a bronze dataset, decoded and with its metadata columns.

        `kafka` are the options of the broker. `records` takes the place of the topic:
        any stream with the columns of the Kafka source. `options` are more options of
        the file stream, such as `maxFilesPerTrigger`.
        """
        spec = _lookup(BRONZE, dataset, "bronze")
        if isinstance(spec, FileSource):
            return read_file_stream(
                self.spark,
                *self._files(dataset, spec),
                {**spec.options, **(options or {})},
                spec.hints,
            )
        return decode_value(
            self.read_records(dataset, kafka, records), spec.value_format, spec.ddl, avro_schema
        )

    def read_records(
        self,
        dataset: str,
        kafka: Mapping[str, str] | None = None,
        records: DataFrame | None = None,
    ) -> DataFrame:
        """The stream of a topic as it is, or `records` in its place."""
        if records is not None:
            return records
        return read_kafka_stream(self.spark, _lookup(BRONZE, dataset, "bronze").topic, kafka or {})

    def ingest(
        self,
        dataset: str,
        schema_id: int | None = None,
        payload: Callable[[Column], Column] | None = None,
        **source: Any,
    ) -> None:
        """Landing files or topic to bronze; takes the arguments of `read_source`.

        With `schema_id`, records that are not framed with that id go to the table
        `<dataset>_rejects` as they came, and only the others are decoded, by `payload` if it is
        given. Both tables get a batch under its number, so one that is cut off between them and
        done again adds nothing twice.
        """
        spec = _lookup(BRONZE, dataset, "bronze")
        self._create_schema("bronze")
        path = f"{self.root}/bronze/{spec.datasource}/{dataset}"
        table, name = self.table("bronze", dataset), f"{spec.datasource} {dataset}"

        def write(rows: DataFrame, batch: int) -> None:
            first = rows.select(F.unix_micros("_ingestion_time")).first()
            if first is None:
                return
            at = EPOCH + dt.timedelta(microseconds=first[0])
            if schema_id is not None:
                rows, others = split_by_schema(rows.drop("_ingestion_time"), schema_id)
                others = prefix_envelope(others).withColumn("_schema_id", decode_schema_id(F.col("_value")))
                append_batch(others, f"{table}_rejects", f"{path}_rejects", batch, at, self.fmt)
                rows = decode_with(rows, decoder, F.lit(at))
            append_batch(rows, table, path, batch, at, self.fmt)

        if isinstance(spec, FileSource):
            schema = drain_files(
                self.spark, *self._files(dataset, spec), f"{path}_checkpoint", write, name,
                {**spec.options, **(source.get("options") or {})}, spec.hints,
            )
        else:
            if schema_id is None and payload is None:
                df = self.read_source(dataset, **source)
            else:
                decoder = payload or payload_of(spec.value_format, spec.ddl, source.get("avro_schema"))
                df = self.read_records(dataset, source.get("kafka"), source.get("records"))
            if schema_id is not None:
                df = df.withColumn("_ingestion_time", F.current_timestamp())
            elif payload is not None:
                df = decode_with(df, payload)
            drain_batches(df, write, f"{path}_checkpoint", name)
            schema = df.schema if schema_id is None else None
        if schema is not None and self.fmt != "delta":
            # A table even if nothing has come yet.
            parts = (INGESTED_AT, BATCH)
            ensure_partitioned(self.spark, table, path, ingested_schema(schema), parts, self.fmt)

    def _files(self, dataset: str, spec: FileSource) -> tuple[str, str, str]:
        """Folder, format and place of the schema of a dataset that comes as files."""
        schema = f"{self.root}/bronze/{spec.datasource}/{dataset}_schema"
        return f"{self.landing}/{spec.datasource}/{dataset}", spec.fmt, schema

    def process(
        self, dataset: str, run_ts: dt.datetime | None = None, across_runs: bool = False
    ) -> bool:
        """Bronze to silver: the rows ingested since the last run, cleaned and imputed.

        The runs are in a table of their own, `<dataset>_runs`; the silver table is a view of it,
        which `compact` switches. A Delta table needs no such view.

        As in the original jobs the means of a run see its own rows alone. With `across_runs`
        trailing means see the readings of earlier runs too, and means by key all that came so
        far, each run once. Filled fields are noted in `_imputed` then, as they are no readings:
        it works on what was processed with it from the start.
        """
        spec = _lookup(SILVER, dataset, "silver")
        view, table, path = self._silver(dataset)
        self._create_schema("silver")

        def write(rows: DataFrame, run: Run) -> None:
            cleaned = spec.clean(rows, F.lit(run.time))
            if across_runs:
                silver = self._imputed_across_runs(dataset, cleaned, run)
            else:
                silver = impute(cleaned, spec.rules, sum_type=self.sum_type)
            if self.fmt == "delta":
                append_table(silver, view, path, run.run_id, fmt=self.fmt)
                return
            append_table(silver, table, path, run.run_id, fmt=self.fmt)
            publish(self.spark, view, table, read_layout(self.spark, view))

        return hand_over(self._state(dataset), self.table("bronze", dataset), write, run_ts)

    def _imputed_across_runs(self, dataset: str, cleaned: DataFrame, run: Run) -> DataFrame:
        """The rules with context, and the names of the fields that they filled as `_imputed`."""
        spec, view = SILVER[dataset], self.table("silver", dataset)
        fields = [r.field for r in spec.rules if isinstance(r, (WindowMean, KeyMean))]
        keys = ["timestamp", *{r.key for r in spec.rules if isinstance(r, WindowMean)}]

        def earlier(low: int, high: int) -> DataFrame | None:
            """Readings of other runs by their days, then their time; filled fields are null."""
            if not self.spark.catalog.tableExists(view):
                return None
            first, last = (dt.datetime.fromtimestamp(s, dt.timezone.utc).date() for s in (low, high))
            rows = date_range(read_table(self.spark, view), first, last).filter(F.col(RUN_ID) != run.run_id)
            rows = rows.filter(epoch_seconds("timestamp").between(low, high))
            filled = [F.coalesce(F.array_contains("_imputed", f), F.lit(False)) for f in fields]
            rows = rows.select(*keys, *[F.when(~x, F.col(f)).alias(f) for f, x in zip(fields, filled)])
            # Written apart: a table cannot be read by what is written to it.
            context = f"{self._silver(dataset)[2]}_context"
            rows.write.mode("overwrite").parquet(context)
            return self.spark.read.schema(rows.schema).parquet(context)

        def totals(own: DataFrame, key: str, of: Sequence[str]) -> DataFrame:
            """Totals are kept by run, so a run that is done again does not count twice."""
            name = f"{view}_totals_{key}_{'_'.join(of)}"
            path = f"{self.root}/silver/{spec.datasource}/{name.rsplit('.', 1)[1]}"
            append_table(own, name, path, run.run_id, [], self.fmt)
            return read_table(self.spark, name).filter(F.col(RUN_ID) <= run.run_id)

        # A reading that is no number is a gap too.
        gaps = {r.field: F.col(r.field).isNull() | (F.isnan(r.field) if r.nan else F.lit(False))
                for r in spec.rules if isinstance(r, WindowMean)}
        gaps |= {r.field: F.col(r.field).isNull() for r in spec.rules if isinstance(r, KeyMean)}
        names = [F.when(gap, F.lit(f)) for f, gap in gaps.items()]
        noted = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
        df = cleaned.withColumn("_imputed", noted)
        return impute(df, spec.rules, sum_type=self.sum_type, earlier=earlier, totals=totals)

    def _silver(self, dataset: str) -> tuple[str, str, str]:
        view = self.table("silver", dataset)
        return view, f"{view}_runs", f"{self.root}/silver/{SILVER[dataset].datasource}/{dataset}"

    def _state(self, dataset: str) -> StateTable:
        table = self.table("silver", f"{dataset}_state")
        return StateTable(self.spark, table, f"{self.root}/silver/pipeline_state/{dataset}")

    def compact(self, dataset: str, at_least: int = 2) -> bool:
        """Pack the small files of the finished runs of a silver table by day.

        Waits for nobody: a run that is not done stays as it is. One writer of a dataset at a
        time, as for `process`.
        """
        _lookup(SILVER, dataset, "silver")
        view, table, path = self._silver(dataset)
        finished = self._state(dataset).last_done()
        if finished is None:
            return False
        if self.fmt == "delta":
            self.spark.sql(f"OPTIMIZE {view}")
            return True
        return compact(self.spark, view, table, path, finished, at_least=at_least)

    def aggregate(self, name: str, by_parts: bool = False) -> None:
        """Silver to gold: the whole table anew.

        With `by_parts` only the runs of silver that came since the last time are read. What they
        add is kept by run, in tables of its own, and the gold table is what all of it makes.
        """
        spec = _lookup(GOLD, name, "gold")
        self._create_schema("gold")
        path, sums = f"{self.root}/gold/{name}", {"sum_type": self.sum_type} if self.sum_type else {}
        if by_parts:
            if spec.merge is None or self.fmt == "delta":
                raise ValueError(f"{name} is not made of parts of runs")
            parts = [self._parts(name, t, make, sums) for t, make in zip(spec.inputs, spec.parts)]
            overwrite_table(spec.merge(*parts), self.table("gold", name), path, self.fmt)
            return
        inputs = [read_table(self.spark, self.table("silver", t)) for t in spec.inputs]
        more = sums if spec.sums else {}
        overwrite_table(spec.aggregate(*inputs, **more), self.table("gold", name), path, self.fmt)

    def _parts(self, name: str, dataset: str, make: Callable[..., DataFrame], sums: Mapping[str, str]):
        """The parts of all runs of an input, those of new runs made first.

        A run of parts has the id of the last silver run in it and is replaced as a whole, so one
        that is cut off is made again, and none counts twice.
        """
        table = self.table("gold", f"{name}_{dataset}_parts")
        done, upto = last_run(self.spark, table), self._state(dataset).last_done()
        if upto is not None and (done is None or upto > done):
            rows = rows_of_runs(read_table(self.spark, self.table("silver", dataset)), done, upto)
            location = f"{self.root}/gold/{name}_{dataset}_parts"
            append_table(make(rows, **sums), table, location, upto, [], self.fmt)
        return read_table(self.spark, table)
