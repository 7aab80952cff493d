"""Claims-shaped views over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimloom import settings as S
from claimloom.functions import clean
from claimloom.functions.storage import as_table, spread
from claimloom.operators import enrich, quality, rollup, splits
from claimloom.sources import tables as sources

# Tables already written in this application, by application, folder and name.
_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}
_SCHEMAS: dict[tuple[str, str], StructType] = {}

# What makes a line inpatient (1) or outpatient (0): a condition on the line and one on its order.
_TYPES = {
    1: ("l_returnflag = 'R'", "o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    0: ("l_returnflag <> 'R'", "o_orderpriority = '5-LOW'"),
}


class Tables:
    """The given tables of one folder and the claims views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once per application."""
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)

    def raw(self, patient_type: int | None = None) -> DataFrame:
        """Line items seen as raw claims; ids are negative on purpose.

        With a ``patient_type`` only its rows: what decides the type is filtered before the joins, so that the other
        rows are never shuffled.
        """
        lines = self.read("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus",
        )
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        if patient_type is not None:
            returned, priority = _TYPES[patient_type]
            lines, orders = lines.filter(returned), orders.filter(priority)
        # A single small file would be one task for everything that follows.
        lines = spread(lines)
        customers = self.read("customer").select("c_custkey", "c_nationkey")
        parts = self.read("part").select("p_partkey", "p_type", "p_brand", "p_size")
        # Orders are fewer than lines, so customers join them first.
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
            parts, F.col("l_partkey") == F.col("p_partkey")
        )
        digit = F.col("p_size") % 10
        code = F.concat(
            F.substring("p_type", 1, 1),
            F.lpad(F.expr("substr(p_brand, 7)"), 2, "0"),
            digit.cast("string"),
        )
        factor = F.expr(
            "CASE p_size % 10 WHEN 0 THEN 20.00BD WHEN 1 THEN 0.01BD WHEN 2 THEN 0.01BD "
            "WHEN 3 THEN 0.05BD ELSE 1.00BD END"
        ).cast("decimal(4,2)")
        return joined.select(
            (-F.col("o_custkey")).alias("BENE_ID"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("CLM_ID"),
            (F.col("c_nationkey") + 1).alias("PRVDR_STATE_CD"),
            F.when((F.col("l_tax") == 0.0) & (F.col("l_linenumber") == 3), F.lit(None).cast("string"))
            .when((F.col("l_linenumber") == 7) & (F.col("p_size") == 50), F.lit("0FB43ZZ"))
            .otherwise(code)
            .alias("PRNCPAL_DGNS_CD"),
            F.when((F.col("l_linenumber") == 5) & (F.col("l_discount") == 0.0), F.lit(None).cast("string"))
            .when(F.col("l_linestatus") == "F", F.lit("Y"))
            .otherwise(F.lit("U"))
            .alias("CLM_E_POA_IND_SW1"),
            (F.col("l_extendedprice").cast("decimal(18,2)") * factor)
            .cast("decimal(18,2)")
            .alias("CLM_TOT_CHRG_AMT"),
            F.when(F.expr(f"{_TYPES[1][0]} AND {_TYPES[1][1]}"), F.lit(1))
            .when(F.expr(f"{_TYPES[0][0]} AND {_TYPES[0][1]}"), F.lit(0))
            .alias("PATIENT_TYPE"),
        )

    def raw_inpatient(self) -> DataFrame:
        return self.raw(1).filter("PATIENT_TYPE = 1").drop("PATIENT_TYPE")

    def raw_outpatient(self) -> DataFrame:
        return self.raw(0).filter("PATIENT_TYPE = 0").drop("PATIENT_TYPE")

    def income_text(self) -> DataFrame:
        """Income as text, one value with currency marks, one state missing."""
        key = F.col("n_nationkey")
        text = F.when(key == 7, F.lit("$52,000\u00a0")).otherwise(
            (F.lit(45000) + key * 1000).cast("string")
        )
        return (
            self.read("nation")
            .filter(key != 24)
            .select((key + 1).alias(S.STATE_KEY), F.col("n_name").alias("STATE"), text.alias(S.INCOME))
        )

    def income(self) -> DataFrame:
        return sources.clean_income(self.income_text())

    def rolled_up(self) -> tuple[DataFrame, DataFrame]:
        """Inpatient and outpatient roll-ups, before they are joined."""
        return rollup.rolled_up(rollup.prepare(self.raw_inpatient(), 1), rollup.prepare(self.raw_outpatient(), 0))

    def claims(self) -> DataFrame:
        """Merged claims, the ingestion boundary: written once, then scanned."""
        return self._stored(
            "claims", lambda: rollup.merged_claims(self.raw_inpatient(), self.raw_outpatient())
        )

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _WRITTEN:
            _WRITTEN[key] = as_table(build(), name, split=True)
        return _WRITTEN[key]

    def modeling(self) -> DataFrame:
        return enrich.modeling_frame(self.claims(), self.income())

    def model_rows(self) -> DataFrame:
        """Modeling rows that pass the modeling rules."""
        return quality.accepted(self.modeling(), quality.modeling_schema().rules)

    def folds(self) -> DataFrame:
        """Model rows with the grouped train/test fold, written once."""
        return self._stored("folds", lambda: splits.group_split(self.model_rows()))

    def train_test(self) -> tuple[DataFrame, DataFrame]:
        folds = self.folds()
        return folds.filter("fold = 'train'"), folds.filter("fold = 'test'")

    def rule_scores(self) -> DataFrame:
        """Tier scores from the inpatient charge alone: a model-free prediction."""
        x = F.col(S.CHARGE_INP).cast("double") / 10000
        centres = {1: 0.05, 2: 0.5, 3: 5.0, 4: 50.0, 5: 500.0}
        rows = self.model_rows().withColumns(
            {f"s{t}": F.lit(1.0) / (F.lit(1.0) + F.abs(x - c)) for t, c in centres.items()}
        )
        total = F.col("s1") + F.col("s2") + F.col("s3") + F.col("s4") + F.col("s5")
        return rows.select(
            *rows.columns[:-5],
            F.col(S.TIER).alias("label"),
            clean.tier_of(F.col(S.CHARGE_INP)).alias("prediction"),
            *[F.round(F.col(f"s{t}") / total, 6).alias(f"p{t}") for t in centres],
            F.ln(F.col(S.CHARGE_INP).cast("double") * 2).alias("predicted_log"),
        )
