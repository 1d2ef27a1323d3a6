"""Shared pieces of the model bake-offs on Spark ML."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import Imputer, ImputerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.sinks import materialize
from .forest import Grown, grow

VECTOR = "features"
ROW = "_row"


@dataclass(frozen=True)
class TreeSettings:
    """Limits of every forest.

    Trees grow until their leaves reach the smallest allowed size; ``depth`` is
    as deep as Spark ML goes, ``bins`` its own number of split points.
    ``memory_mb`` holds the statistics of one pass per task.
    """

    depth: int = 30
    bins: int = 32
    memory_mb: int = 512

    def params(self) -> dict:
        return {
            "maxDepth": self.depth,
            "maxBins": self.bins,
            "maxMemoryInMB": self.memory_mb,
            # Deep trees: rows remember their node instead of walking each tree again.
            "cacheNodeIds": True,
        }


@dataclass(frozen=True)
class Featurizer:
    """Median imputation and vector assembly, fitted on one frame.

    Medians are exact to a thousandth of the rows' ranks; snapshot features are
    zero-filled, so they only matter for frames from elsewhere.
    """

    imputer: ImputerModel
    assembler: VectorAssembler
    columns: tuple[str, ...]

    @classmethod
    def fit(cls, frame: DataFrame, columns: list[str]) -> Featurizer:
        filled = [f"{c}_filled" for c in columns]
        imputer = Imputer(
            strategy="median", relativeError=0.001, inputCols=list(columns), outputCols=filled
        ).fit(frame)
        return cls(imputer, VectorAssembler(inputCols=filled, outputCol=VECTOR), tuple(columns))

    def transform(self, frame: DataFrame, *keep: str) -> DataFrame:
        """``keep`` columns plus the feature vector."""
        return self.assembler.transform(self.imputer.transform(frame)).select(*keep, VECTOR)

    def pipeline(self, *stages: Transformer) -> PipelineModel:
        """A saveable model that starts from the raw feature columns."""
        return PipelineModel([self.imputer, self.assembler, *stages])


# Linear fits read small tables by few tasks.  A forest of a small table is held
# in parts, which are loaded side by side.
ROWS_PER_TASK = 100_000
MOST_PARTS = 4


def keep_in_memory(df: DataFrame) -> DataFrame:
    """Reused by several fits; spills to disk where memory is short."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def training_rows(df: DataFrame) -> DataFrame:
    """``df`` kept in memory, in as many partitions as its rows need.

    Node ids of deep trees are cut from their lineage in the shared folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return keep_in_memory(df.coalesce(tasks_for(df.count())))


def forest_parts(rows: int, trees: int) -> list[int]:
    """Trees of each part.  Rows alone decide, so every cluster grows the same forest."""
    parts = max(1, min(MOST_PARTS // tasks_for(rows), trees))
    return [trees * (k + 1) // parts - trees * k // parts for k in range(parts)]


@dataclass(frozen=True)
class Forest:
    """A forest of Spark ML models whose trees weigh the same, parts of one.

    ``column`` gets the mean of the trees: a value, or the probability of
    class 1.
    """

    models: tuple
    column: str

    @property
    def stages(self) -> tuple:
        """What a saved pipeline holds."""
        return self.models

    @property
    def sizes(self) -> list[int]:
        return [m.getNumTrees for m in self.models]

    def transform(self, df: DataFrame) -> DataFrame:
        total = F.lit(0.0)
        for model, size in zip(self.models, self.sizes):
            df = model.transform(df)
            if hasattr(model, "numClasses"):
                value = positive_probability(model.getProbabilityCol())
            else:
                value = F.col(model.getPredictionCol())
            total = total + value * size
        return df.withColumn(self.column, total / sum(self.sizes))

    @property
    def importances(self) -> list[float]:
        """Mean over the parts by their trees; sums to 1 unless no tree has a split."""
        found = [m.featureImportances.toArray() * n for m, n in zip(self.models, self.sizes)]
        total = sum(found)
        return (total / (total.sum() or 1.0)).tolist()


@dataclass(frozen=True)
class TableForest:
    """The same, scored from the stored table of its trees.

    ``load`` gives the Spark ML models of its parts, for who asks for them; the
    driver holds these.
    """

    grown: Grown
    column: str
    load: Callable[[], tuple]
    stages: tuple = ()

    @property
    def models(self) -> tuple:
        return self.load()

    @property
    def sizes(self) -> list[int]:
        return [m.getNumTrees for m in self.models]

    @property
    def importances(self) -> list[float]:
        return self.grown.importances

    def transform(self, df: DataFrame) -> DataFrame:
        return with_forests(df, self)


def with_forests(df: DataFrame, *forests: Forest | TableForest) -> DataFrame:
    """``df`` with the column of each forest.

    Rows are stored with a number first, by which those scored from tables come
    back to them.
    """
    tables = [f for f in forests if isinstance(f, TableForest)]
    if tables:
        numbered = df.withColumn(ROW, F.monotonically_increasing_id())
        df = materialize(numbered, "rows")
        rows = df.select(F.col(ROW).alias("id"), VECTOR)
        for f in tables:
            df = df.join(f.grown.scores(rows, f.column).withColumnRenamed("id", ROW), ROW, "left")
        df = df.drop(ROW)
    for f in forests:
        if f not in tables:
            df = f.transform(df)
    return df


def fit_forest(
    estimator: Callable[[int, int, str], object], data: DataFrame, rows: int, trees: int, seed: int, column: str
) -> TableForest:
    """Grow a forest at once and hold it in parts.

    ``estimator`` gives one for a number of trees, a seed and a suffix of its
    output columns.
    """
    sizes = forest_parts(rows, trees)
    parts = grow([estimator(n, seed + 7919 * k, f"_{k}") for k, n in enumerate(sizes)], data)
    return TableForest(parts[0].grown, column, lambda: tuple(p.model for p in parts), tuple(parts))


def fit_together(spark: SparkSession, *fits: Callable[[], object]) -> list:
    """Run independent fits as concurrent Spark jobs, as cross-validation does.

    One fit's driver-side split selection then overlaps another's tasks.
    """
    with ThreadPoolExecutor(len(fits)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(f)) for f in fits]
        return [r.result() for r in running]


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def balanced_weight(label: Column, rows: int, positives: int) -> Column:
    """n / (2 n_c): both classes weigh the same in total."""
    return F.when(label == 1, rows / (2 * positives)).otherwise(rows / (2 * (rows - positives)))


def importance_table(frame: DataFrame, columns: tuple[str, ...], model: Forest | TableForest) -> DataFrame:
    """(feature, importance) of a forest; one row per feature."""
    rows = [(c, float(v)) for c, v in zip(columns, model.importances)]
    return frame.sparkSession.createDataFrame(rows, "feature string, importance double")
