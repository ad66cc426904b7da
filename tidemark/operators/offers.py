"""Stored assistant responses to offer payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.offers import bind

BLOCKS = "array<struct<type string, id string, name string, input variant>>"
CHOICES = (
    "array<struct<finish_reason string, message struct<tool_calls array<"
    "struct<id string, function struct<name string, arguments string>>>>>>"
)


def response_calls(df: DataFrame, response: str) -> DataFrame:
    """Adds ``stop_reason`` and ``calls`` of ``(id, name, input)``.

    Reads both response layouts: content blocks of type ``tool_use``, and the
    first choice's ``tool_calls``, whose arguments are JSON text and count only
    when the choice finished for them. Rows that are neither have null ``calls``.
    """
    parsed = F.from_json(
        response, f"stop_reason string, content {BLOCKS}, choices {CHOICES}"
    )

    def read(p):
        blocks = F.transform(
            F.filter(p["content"], lambda b: b["type"] == "tool_use"),
            lambda b: F.struct(
                b["id"].alias("id"),
                b["name"].alias("name"),
                F.to_json(b["input"]).alias("input"),
            ),
        )
        choice = F.get(p["choices"], 0)
        asked = choice["finish_reason"] == "tool_calls"
        made = F.transform(
            choice["message"]["tool_calls"],
            lambda c: F.struct(
                c["id"].alias("id"),
                c["function"]["name"].alias("name"),
                F.to_json(F.try_parse_json(c["function"]["arguments"])).alias("input"),
            ),
        )
        none = F.array().cast("array<struct<id string, name string, input string>>")
        from_choice = F.when(asked, F.coalesce(made, none)).otherwise(none)
        return F.struct(
            F.when(
                p["content"].isNotNull(),
                F.when(
                    p["stop_reason"].isin("tool_use", "pause_turn", "max_tokens"),
                    p["stop_reason"],
                ).otherwise("end_turn"),
            )
            .when(asked, "tool_use")
            .when(choice.isNotNull(), "end_turn")
            .alias("stop_reason"),
            F.when(p["content"].isNotNull(), blocks)
            .when(choice.isNotNull(), from_choice)
            .alias("calls"),
        )

    others = [c for c in df.columns if c != response]
    bound = bind(parsed, read).alias("_read")
    return df.select(*others, bound).select(*others, "_read.*")


def tool_calls(df: DataFrame, response: str) -> DataFrame:
    """One row per call: ``stop_reason``, ``id``, ``name``, ``input`` as JSON text."""
    read = response_calls(df, response)
    others = [c for c in read.columns if c != "calls"]
    return read.select(*others, F.inline("calls"))


def saved_payloads(calls: DataFrame) -> DataFrame:
    """Payload text of the calls that save offers, as ``payload``."""
    return calls.where(F.col("name") == fixed.SAVE_CALL).withColumn(
        "payload", F.get_json_object("input", f"$.{fixed.SAVE_FIELD}")
    )
