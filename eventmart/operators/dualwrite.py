"""Writing a batch to two targets."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators.load import LoadPolicy
from eventmart.operators.tables import BatchTable
from eventmart.schemas import INGEST_LOG
from eventmart.session import materialize

SUCCESS_MESSAGE = "inserted into {target} Redshift"  # fixed value


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def append_log(df: DataFrame, path: str, batch_id: str, target: str) -> None:
    """One log folder per batch and target, replaced on replay."""
    (
        df.drop("batch_id", "target")
        .withColumns({"batch_id": F.lit(batch_id), "target": F.lit(target)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", "target")
        .parquet(path)
    )


def dual_write(
    df: DataFrame,
    primary: BatchTable,
    secondary: BatchTable | None,
    batch_id: str,
    policy: LoadPolicy,
    loaded_at: datetime,
    log_path: str | None = None,
    worker_id: str = "loader",
) -> dict[str, int]:
    """Load a batch into both targets on their own. The result is the primary's, and its
    failure fails the batch; the secondary's failure is only logged. Each target knows the
    batches it holds, so a retry does not repeat rows in the one that had succeeded."""
    spark = primary.spark
    outcome: dict[str, dict[str, int]] = {}
    errors: dict[str, Exception] = {}
    if secondary is not None:
        # read and parse the input once for both targets, in the shared folder
        df = materialize(df, "dual-write")
    for target, table in (("primary", primary), ("secondary", secondary)):
        if table is None:
            continue
        started = _now()
        try:
            outcome[target] = table.load(df, batch_id, policy, loaded_at)
        except Exception as e:  # one target's failure must not stop the other
            errors[target] = e
        if log_path is not None:
            error = errors.get(target)
            counts = outcome.get(target, {"ok": 0, "reject": 0})
            message = SUCCESS_MESSAGE.format(target=target)
            row = (
                batch_id, worker_id, target, message if error is None else "load failed",
                started, _now(), counts["ok"], counts["reject"] if error is None else 1,
                type(error).__name__ if error is not None else None,
            )
            append_log(spark.createDataFrame([row], INGEST_LOG), log_path, batch_id, target)
    if "primary" in errors:
        raise errors["primary"]
    return outcome["primary"]
