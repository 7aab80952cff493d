"""Feature encoders fitted on the training fold and applied anywhere."""

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions.skew import BROADCAST_ROWS, broadcast_if_small, lookup_join
from claimloom.functions.storage import as_table
from claimloom.operators.profile import frequency_table, scaler_statistics


class TableWriter(MLWriter):
    """Saves a model's parameters and its side table."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/table")


class TableReader(MLReader):
    """Loads a model saved by :class:`TableWriter`."""

    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(self.sparkSession.read.parquet(f"{path}/table"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TableModel(Model, MLReadable, MLWritable):
    """A model whose fitted state is a table."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self.table = table

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)


class _FrequencyParams(HasInputCols, HasOutputCols):
    normalize = Param(
        Params._dummy(), "normalize", "share of rows instead of counts", TypeConverters.toBoolean
    )


class FrequencyEncoder(Estimator, _FrequencyParams, DefaultParamsReadable, DefaultParamsWritable):
    """Encode categories by how often they occur in the training rows.

    A category absent from training gets the least training frequency, never zero.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, normalize=True):
        super().__init__()
        self._setDefault(normalize=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "FrequencyEncoderModel":
        names = self.getInputCols()
        found = frequency_table(dataset, names, self.getOrDefault(self.normalize))
        table = as_table(found.select("column_name", "value", "frequency"), "frequencies")
        facts = {
            r.column_name: r
            for r in table.groupBy("column_name")
            .agg(F.min("frequency").alias("least"), F.count(F.lit(1)).alias("entries"))
            .collect()
        }
        model = FrequencyEncoderModel(table)
        model._set(
            inputCols=names,
            outputCols=self.getOutputCols()
            if self.isSet(self.outputCols)
            else [f"{c}_freq" for c in names],
            normalize=self.getOrDefault(self.normalize),
            unseen=[float(facts[c].least) if c in facts else 0.0 for c in names],
            entries=[int(facts[c].entries) if c in facts else 0 for c in names],
        )
        return model


class FrequencyEncoderModel(TableModel, _FrequencyParams):
    """Fitted frequencies: a table of column, value and frequency."""

    unseen = Param(Params._dummy(), "unseen", "fallback per column", TypeConverters.toListFloat)
    entries = Param(Params._dummy(), "entries", "fitted values per column", TypeConverters.toListInt)

    def frequencies(self, column: str) -> DataFrame:
        return self.table.filter(F.col("column_name") == column).select("value", "frequency")

    def _measured(self, column: str, fitted: DataFrame) -> DataFrame:
        known = self.__dict__.setdefault("_joined", {})
        if column not in known:
            known[column] = broadcast_if_small(fitted)
        return known[column]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        plan = zip(
            self.getInputCols(),
            self.getOutputCols(),
            self.getOrDefault(self.unseen),
            self.getOrDefault(self.entries),
        )
        for name, output, unseen, entries in plan:
            fitted = self.frequencies(name).withColumnsRenamed({"value": name, "frequency": output})
            # The number of entries was counted when fitting; their bytes are measured once per model.
            if entries <= BROADCAST_ROWS:
                dataset = dataset.join(self._measured(name, fitted), name, "left")
            else:
                dataset = lookup_join(dataset, fitted, [name], "left")
            dataset = dataset.withColumn(output, F.coalesce(F.col(output), F.lit(unseen)))
        return dataset


class _ScalerParams(HasInputCols, HasOutputCols):
    pass


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise columns by training mean and population deviation."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        names = self.getInputCols()
        facts = {r.column_name: r for r in scaler_statistics(dataset, names).collect()}
        model = PopulationScalerModel()
        model._set(
            inputCols=names,
            outputCols=self.getOutputCols(),
            means=[float(facts[c]["mean"] or 0.0) for c in names],
            scales=[float(facts[c]["scale"] or 1.0) for c in names],
        )
        return model


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted means and scales."""

    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "scale per column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        plan = zip(
            self.getInputCols(),
            self.getOutputCols(),
            self.getOrDefault(self.means),
            self.getOrDefault(self.scales),
        )
        return dataset.withColumns(
            {out: (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale) for c, out, mean, scale in plan}
        )


FLAG_INDEX, FLAG_VECTOR, FEATURE_VECTOR = "__flag_index", "__flag_vector", "features"


def build_preprocessor(
    codes: Sequence[str] = tuple(S.CODE_COLUMNS),
    flag: str = S.FLAG_COLUMN,
    numbers: Sequence[str] = tuple(S.NUMERIC_COLUMNS),
) -> Pipeline:
    """Frequencies, one-hot flag and scaled numbers, assembled in that order.

    The indexer's extra slot for unknown values is the one the encoder drops, so
    every training level has its own feature and an unknown flag is all zeros.
    """
    codes, numbers = list(codes), list(numbers)
    frequencies = [f"{c}_freq" for c in codes]
    scaled = [f"__scaled_{c}" for c in numbers]
    return Pipeline(
        stages=[
            FrequencyEncoder(inputCols=codes, outputCols=frequencies),
            StringIndexer(
                inputCol=flag, outputCol=FLAG_INDEX, handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCol=FLAG_INDEX, outputCol=FLAG_VECTOR, dropLast=True),
            PopulationScaler(inputCols=numbers, outputCols=scaled),
            VectorAssembler(
                inputCols=[*frequencies, FLAG_VECTOR, *scaled], outputCol=FEATURE_VECTOR
            ),
        ]
    )


def feature_names(fitted: PipelineModel) -> list[str]:
    """Readable names of the assembled features, in vector order."""
    codes, index, _, scaler = fitted.stages[:4]
    levels = [f"{index.getInputCol()}_{v}" for v in index.labels]
    return [*codes.getOutputCols(), *levels, *scaler.getInputCols()]


def one_hot(frame: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """Explicit 0/1 columns for the given levels; other values are all zero."""
    return frame.withColumns(
        {
            f"{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int")
            for v in levels
        }
    )


def values_only_in_test(folds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values seen in the test fold but never in the training fold, per column."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        folds.select("fold", F.inline(pairs))
        .groupBy("column_name", "value")
        .agg(
            F.count_if(F.col("fold") == "train").alias("train_rows"),
            F.count_if(F.col("fold") == "test").alias("test_rows"),
        )
        .filter("train_rows = 0 AND test_rows > 0")
        .select("column_name", "value", "test_rows")
    )


def leaked_values(table: DataFrame, test_only: DataFrame) -> DataFrame:
    """Test-only values that a fitted frequency table nevertheless knows."""
    return test_only.join(
        table.select("column_name", "value"), ["column_name", "value"], "left_semi"
    )


def with_class_weights(
    frame: DataFrame, label: str, classes: Sequence, output: str = "weight"
) -> DataFrame:
    """Inverse-frequency class weights with mean one.

    A class of ``n_c`` rows out of ``n``, with ``k`` classes present, weighs
    ``n / (k * n_c)``; the mean over all rows is then one already. The classes are
    counted in one pass and the weights become constants of the plan.
    """
    counts = frame.agg(
        *[F.count_if(F.col(label) == F.lit(c)).alias(f"n_{i}") for i, c in enumerate(classes)]
    ).first()
    present = {c: counts[f"n_{i}"] for i, c in enumerate(classes) if counts[f"n_{i}"]}
    mean = sum(present.values()) / len(present) if present else 0.0
    weight = F.lit(None).cast("double")
    for c, n in present.items():
        weight = F.when(F.col(label) == F.lit(c), F.lit(mean / n)).otherwise(weight)
    return frame.withColumn(output, weight)
