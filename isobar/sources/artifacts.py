"""The folder of one or more trained models, written and read as typed tables.

A run's tables go to ``<root>/<model>/run=<time>-<id>/<kind>/``. Its manifest is written last: a small file that
names the model, the run, and the kinds with their row counts. Readers look at manifests, take the latest
run of each model, the same for all kinds, and read the folders it names. A run that dies halfway has no manifest
and does not exist for them.

Tables of other makers, ``<model>/<kind>/`` anywhere below the root, are read too: columns go by name and in
their known spellings, the model's name comes from the path where no column has it. They count as older than any
manifest; among themselves by ``run_at`` where they have it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar import schema as S
from isobar.operators import metrics, results
from isobar.sources import tables

# Folder names of the artifact kinds.
CV = "cv_results_csv"
CURVE = "learning_curve_csv"
IMPORTANCE = "feature_importances_csv"
COEFFICIENTS = "coefficients_csv"
PLOT = "plot_data_csv"
METRICS = "metrics.json"
MODEL = "model"

RUN = [T.StructField("run_id", T.StringType()), T.StructField("run_at", T.StringType())]
# Maps have no CSV form: parameters are stored as JSON text.
STORED = {
    CV: T.StructType([
        T.StructField("model", T.StringType()), T.StructField("grid_idx", T.IntegerType()),
        T.StructField("params", T.StringType()), T.StructField("avg_rmse", T.DoubleType()), *RUN,
    ]),
    CURVE: T.StructType([*S.LEARNING_CURVE_SCHEMA.fields, *RUN]),
    IMPORTANCE: T.StructType([*S.IMPORTANCE_SCHEMA.fields, *RUN]),
    COEFFICIENTS: T.StructType([*S.COEFFICIENT_SCHEMA.fields, *RUN]),
    PLOT: T.StructType([
        T.StructField("Predicted_Temperature_C", T.DoubleType()),
        T.StructField("Actual_Temperature_C", T.DoubleType()),
        T.StructField("model", T.StringType()), *RUN,
    ]),
}
METRICS_STORED = T.StructType([*S.METRICS_SCHEMA.fields, *RUN])
MANIFEST = "manifest.json"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), *RUN, T.StructField("folder", T.StringType()),
    T.StructField("kinds", T.MapType(T.StringType(), T.LongType())),
])
RUN_FOLDER = "/run="  # in the path of every table of a run


def now() -> str:
    """A time stamp whose text order is its time order."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def typed(df: DataFrame, kind: str) -> DataFrame:
    """A text table of any accepted spelling in the stored form of its kind, with its path."""
    if "model" not in df.columns:
        df = df.withColumn("model", F.regexp_extract("path", f"([^/]+)/{re.escape(kind)}/", 1))
    fixed = ["model", "path", "run_id", "run_at"]
    if kind == CV and "params" not in df.columns:
        named = [c for c in df.columns if c not in (*fixed, "grid_idx", "avg_rmse")]
        df = df.withColumn("params", F.to_json(F.struct(*named)) if named else F.lit("{}"))
        if "grid_idx" not in df.columns:  # the settings in file order, a handful of rows per model
            line = df.withColumn("_line", F.monotonically_increasing_id())
            order = Window.partitionBy("model").orderBy("_line")
            df = line.withColumn("grid_idx", (F.row_number().over(order) - 1).cast("string")).drop("_line")
    if kind == CURVE:
        df = results.spelled(df)
    if kind == PLOT and "Predicted_Temperature_C" not in df.columns:
        kept = [c for c in fixed if c in df.columns]
        pairs = metrics.resolve_prediction_columns(df, kept)
        if pairs is None:
            return df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in STORED[kind].fields], "path").limit(0)
        df = pairs.withColumnsRenamed({"prediction": "Predicted_Temperature_C", "label": "Actual_Temperature_C"})
    if kind == COEFFICIENTS and "abs_coeff" not in df.columns:
        df = df.withColumn("abs_coeff", F.abs(F.col("coefficient").try_cast("double")))
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in STORED[kind].fields
    ], "path")


class Run:
    """The tables of one run of one model; readers see none of them before ``publish``."""

    def __init__(self, spark: SparkSession, root: str, model: str, run_id: str, run_at: str | None = None):
        self.spark, self.root, self.model, self.run_id, self.run_at = spark, root, model, run_id, run_at or now()
        self.folder = f"{model}/run={re.sub('[^0-9A-Za-z.-]', '_', f'{self.run_at}-{run_id}')}"
        self.kinds: dict[str, int] = {}

    def path(self, kind: str) -> str:
        return f"{self.root}/{self.folder}/{kind}"

    def write(self, df: DataFrame, kind: str) -> None:
        """One table of the run; its rows are counted as they are written."""
        seen = Observation()
        stamped = df.withColumns({"run_id": F.lit(self.run_id), "run_at": F.lit(self.run_at)})
        if kind == CV:  # maps have no CSV form
            stamped = stamped.withColumn("params", F.to_json("params"))
        columns = [f.name for f in (METRICS_STORED if kind == METRICS else STORED[kind]).fields]
        counted = stamped.select(*columns).observe(seen, F.count(F.lit(1)).alias("n"))
        (tables.write_json if kind == METRICS else tables.write_csv)(counted, self.path(kind))
        self.kinds[kind] = seen.get["n"]

    def save_model(self, model) -> None:
        tables.save_model(model, self.path(MODEL))
        self.kinds[MODEL] = 1

    def publish(self) -> None:
        """Writes the manifest; from then on the run exists."""
        row = [(self.model, self.run_id, self.run_at, self.folder, self.kinds)]
        results.small_table(self.spark, row, MANIFEST_SCHEMA).write.json(self.path(MANIFEST))


@dataclass(frozen=True)
class ArtifactStore:
    spark: SparkSession
    root: str

    def run(self, model: str, run_id: str, run_at: str | None = None) -> Run:
        return Run(self.spark, self.root, model, run_id, run_at)

    def published(self) -> dict[str, dict]:
        """The manifest of each model's last run; the driver gets one row per model."""
        path = F.col("_metadata.file_path")
        found = self.spark.read.schema(MANIFEST_SCHEMA).json(self.root, recursiveFileLookup=True, pathGlobFilter="*.json")
        own = found.filter(path.contains(RUN_FOLDER) & path.contains(f"/{MANIFEST}/") & F.col("folder").isNotNull())
        row = F.struct(*[f.name for f in MANIFEST_SCHEMA.fields])
        last = own.groupBy("model").agg(F.max_by(row, F.struct("run_at", "run_id")).alias("m"))
        return {r["model"]: r["m"].asDict() for r in last.collect()}

    def path(self, model: str, kind: str) -> str:
        """Where the last run of ``model`` keeps ``kind``."""
        return f"{self.root}/{self.published()[model]['folder']}/{kind}"

    def own(self, kind: str) -> DataFrame:
        """Rows of a kind from the last run of each model that has a manifest, with ``model`` and ``path``."""
        folders = [f"{self.root}/{m['folder']}/{kind}" for m in self.published().values() if m["kinds"].get(kind)]
        schema = METRICS_STORED if kind == METRICS else STORED[kind]
        if not folders:
            fields = [*schema.fields, *[T.StructField("model", T.StringType())] * (kind == METRICS), T.StructField("path", T.StringType())]
            return self.spark.createDataFrame([], T.StructType(fields))
        reader = self.spark.read.schema(schema)
        rows = reader.json(folders) if kind == METRICS else reader.option("header", True).csv(folders)
        rows = rows.select("*", F.col("_metadata.file_path").alias("path"))
        return rows.withColumn("model", F.col("model_name")) if kind == METRICS else rows

    def foreign_files(self) -> DataFrame:
        """(path) of tables that belong to no run."""
        listed = tables.files_under(self.spark, self.root, "*.{csv,json}")
        return listed.filter(~F.col("path").contains(RUN_FOLDER) & ~F.col("path").contains(f"/{MODEL}/"))

    def foreign(self, kind: str) -> DataFrame | None:
        """All rows of a kind in tables that belong to no run, in the stored form; None if there are none."""
        if kind == METRICS:
            rows = tables.read_json_under(self.spark, self.root, METRICS_STORED, single=True)
            rows = rows.filter(~F.col("path").contains(RUN_FOLDER))
            named = F.coalesce("model_name", F.regexp_extract("path", "([^/]+)/[^/]*metrics", 1))
            return rows.withColumn("model", named).withColumn("model_name", F.col("model"))
        parts = [typed(t, kind) for t in tables.read_csv_under(self.spark, self.root, f"/{kind}/", RUN_FOLDER)]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def foreign_runs(self) -> DataFrame:
        """(model, run_id) of the last run of each model among tables that belong to no run: one row per model."""
        parts = [self.foreign(k) for k in (METRICS, CV, CURVE, IMPORTANCE, COEFFICIENTS)]
        runs = [p.select("model", "run_id", "run_at") for p in parts if p is not None]
        order = F.struct(F.coalesce("run_at", F.lit("")), F.coalesce("run_id", F.lit("")))
        last = F.max_by(F.struct("run_id"), order)
        return reduce(DataFrame.unionByName, runs).groupBy("model").agg(last["run_id"].alias("_run"))

    def latest(self, kind: str) -> DataFrame:
        """The rows of each model's last run. A join without a hint: plans see how small one side is."""
        own = self.own(kind)
        if self.foreign_files().isEmpty():
            return own
        rows = self.foreign(kind)
        if rows is None:
            return own
        last = self.foreign_runs().withColumnRenamed("model", "_model")
        same = (F.col("model") == F.col("_model")) & F.col("run_id").eqNullSafe(F.col("_run"))
        older = rows.filter(~F.col("model").isin(list(self.published()))).join(last, same, "left_semi")
        return own.unionByName(older)

    def read(self, kind: str) -> DataFrame:
        """Last run of every model that has this kind; empty if none does."""
        found = self.latest(kind)
        if kind == METRICS:
            return found.drop("path", "run_id", "run_at", "model")
        if kind == CV:
            found = found.withColumn("params", F.from_json("params", "map<string,string>"))
        return found.drop("path", "run_id", "run_at")

    def catalogue(self) -> DataFrame:
        """(model, kind, n_files, n_rows): what is there for each model's section."""
        parts = [self.latest(k).select("model", F.lit(k).alias("kind"), "path") for k in (*STORED, METRICS)]
        union = reduce(DataFrame.unionByName, parts)
        return union.groupBy("model", "kind", "path").agg(F.count(F.lit(1)).alias("n")).groupBy(
            "model", "kind"
        ).agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows"))
