"""The hops as temporary views, for users who work in SQL."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from paywarden.functions import notification as note
from paywarden.operators.hops import parse_records, refine, to_bronze
from paywarden.operators.enrich import join_members


def register_views(
    spark: SparkSession,
    raw: DataFrame,
    members: DataFrame | None = None,
    model: PipelineModel | None = None,
    prefix: str = "",
    history: DataFrame | None = None,
) -> list[str]:
    """Views over a raw text frame, batch or streaming, and the status function.

    With a model there is a view of the scored rows, so that notification reads
    ``SELECT *, notify_status(prediction, userid, webhook_url) FROM transactions_scored``.
    Views are visible in the whole session: give each pipeline its own prefix.
    `history` is a batch frame to find hot accounts in when the raw frame is a stream.
    """
    bronze = to_bronze(raw)
    parsed = parse_records(bronze)
    refined = refine(parsed)
    frames = {
        "transactions_raw": raw,
        "transactions_bronze": bronze,
        "transactions_parsed": parsed,
        "transactions_refined": refined,
    }
    if members is not None:
        frames["members"] = members
        frames["transactions_enriched"] = join_members(refined, members, history=history)
    if model is not None:
        frames["transactions_scored"] = model.transform(frames.get("transactions_enriched", refined))
    for name, frame in frames.items():
        frame.createOrReplaceTempView(prefix + name)
    note.register_status(spark, f"{prefix}notify_status")
    return [prefix + name for name in frames]
