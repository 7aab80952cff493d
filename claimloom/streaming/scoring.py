"""Score claims as they arrive, with the same functions as the batch job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimloom import settings as S
from claimloom.operators import quality, scoring
from claimloom.operators.scoring import Bundle

# Any text is accepted on input; rules decide, so a bad row never stops the stream.
INPUT_SCHEMA = (
    "request_id string, PRNCPAL_DGNS_CD_inp string, PRNCPAL_DGNS_CD_out string, "
    "CLM_E_POA_IND_SW1 string, Number_of_Claims_inp string, Number_of_Claims_out string, "
    "Median_Income string"
)


def read_requests(spark: SparkSession, path: str, kind: str = "json", **options) -> DataFrame:
    """Stream of requests from files that appear in a folder."""
    reader = spark.readStream.schema(INPUT_SCHEMA).options(**options)
    return reader.format(kind).load(path)


def check_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: typed rows to score, and rows with every reason."""
    types = {f.name: f.dataType.simpleString() for f in S.FEATURE_SCHEMA}
    cast, lost = quality.coerce(requests, types)
    checked = quality.with_errors(cast, [*lost, *quality.scoring_rules()]).drop(
        *[f"__lost_{c}" for c in types]
    )
    good = checked.filter(F.size("errors") == 0).drop("errors")
    return good, checked.filter(F.size("errors") > 0)


def score_requests(bundle: Bundle, accepted: DataFrame, explain: bool = True) -> DataFrame:
    """Tier and charge of accepted rows in one table."""
    tiers = scoring.predict_tier(bundle, accepted, explain).withColumnRenamed("model_name", "tier_model")
    return scoring.predict_charge(bundle, tiers).withColumnRenamed("model_name", "charge_model")


def start_scoring(
    requests: DataFrame,
    bundle: Bundle,
    output: str,
    checkpoint: str,
    explain: bool = True,
    **trigger,
) -> StreamingQuery:
    """Write scores and rejected rows per micro-batch below ``output``.

    Each batch has its own folder and replaces it when the batch is repeated after
    a failure, so no row is lost or written twice. The models are loaded once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # One scan of the input serves both outputs; nothing of a batch is kept after it.
        batch = batch.persist()
        accepted, rejected = check_requests(batch)
        score_requests(bundle, accepted, explain).write.mode("overwrite").parquet(
            f"{output}/scores/batch_id={batch_id}"
        )
        rejected.write.mode("overwrite").parquet(f"{output}/rejected/batch_id={batch_id}")
        batch.unpersist()

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
