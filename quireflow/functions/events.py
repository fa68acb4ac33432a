"""Model-registry event messages: parsing, defaults, routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quireflow.contracts import EVENT_MESSAGE

# Fixed values of the event format and of the two targets it can start.
TRANSITION_EVENT = "MODEL_VERSION_TRANSITIONED_STAGE"
TARGET_BY_STAGE = {"Staging": 4, "Production": 3}


def parse_message(message: Column) -> Column:
    """JSON text to struct; fields are null where the text does not parse."""
    return F.from_json(message, EVENT_MESSAGE)


def resolve_transition(
    parsed: Column,
    default_name: Column,
    default_version: Column,
    default_stage: Column,
) -> Column:
    """Which model, version and stage a message is about.

    A message without name or version (or one that is not JSON) falls back to the
    defaults. A message with both but without a stage is an invalid trigger.
    """
    usable = (parsed["model_name"].isNotNull() & parsed["version"].isNotNull())
    usable = F.coalesce(usable, F.lit(False))
    return F.struct(
        F.when(usable, parsed["model_name"]).otherwise(default_name).alias("model_name"),
        F.when(usable, parsed["version"]).otherwise(default_version).alias("version"),
        F.when(usable, parsed["to_stage"]).otherwise(default_stage).alias("stage"),
        F.when(~usable, "defaults")
        .when(parsed["to_stage"].isNull(), "invalid")
        .otherwise("payload")
        .alias("origin"),
    )


def route(parsed: Column) -> Column:
    """Target number for a stage transition, or the reason why there is none."""
    is_move = F.coalesce(parsed["event"] == TRANSITION_EVENT, F.lit(False))
    target = F.lit(None).cast("int")
    for stage, number in TARGET_BY_STAGE.items():
        target = F.when(parsed["to_stage"] == stage, F.lit(number)).otherwise(target)
    target = F.when(is_move, target)
    reason = (
        F.when(parsed.isNull() | parsed["event"].isNull(), "no event")
        .when(~is_move, "other event")
        .when(parsed["to_stage"].isNull(), "no stage")
        .when(target.isNull(), "stage without target")
        .otherwise("accepted")
    )
    return F.struct(target.alias("target"), reason.alias("reason"))
