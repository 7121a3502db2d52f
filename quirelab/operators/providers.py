"""The boundary to models and services: requests as rows, recorded answers joined to them, settings by stage. Nothing here calls out."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import uncertain_readings

# What the message of a passing failure contains, attempts, and the note of an unread region.
RETRYABLE = (
    "429", "500", "502", "503", "504", "resource_exhausted", "unavailable", "internal", "deadline", "overloaded", "timeout", "timed out", "connection", "connect error",
    "max retries", "getaddrinfo", "remote end closed", "temporarily unavailable", "broken pipe", "reset by peer", "read error", "network",
)
ATTEMPTS, ATTEMPTS_PASSING, BACKOFF = 3, 5, 1.5
OPPOSITE_NOTE = "Bleedthrough from opposite folio — not transcribed."


@dataclass(frozen=True)
class Settings:
    """Model and thinking level, with overrides by stage."""

    model: str = "recorded"
    thinking: str = "medium"
    concurrency: int = 8
    stages: dict[str, dict[str, str]] = field(default_factory=dict)

    def of(self, stage: str) -> tuple[str, str]:
        own = self.stages.get(stage, {})
        return own.get("model") or self.model, own.get("thinking") or self.thinking

    @classmethod
    def from_env(cls, prefix: str, env: dict[str, str] | None = None) -> Settings:
        """Settings from variables <prefix>MODEL, <prefix>THINKING, <prefix>CONCURRENCY; blank or malformed ones keep the default."""
        env, s = os.environ if env is None else env, cls()
        for name, kind in (("model", str), ("thinking", str), ("concurrency", int)):
            raw = (env.get(prefix + name.upper()) or "").strip()
            try:
                s = replace(s, **{name: kind(raw)}) if raw else s
            except ValueError:
                pass
        return s


def is_retryable(message: Column) -> Column:
    """True if an error message speaks of a passing failure; false for null."""
    low = F.lower(F.coalesce(message, F.lit("")))
    hit = F.lit(False)
    for t in RETRYABLE:
        hit = hit | low.contains(t)
    return hit


def attempts_left(attempt: Column, message: Column) -> Column:
    """Whether a call that failed for the `attempt`-th time is tried again."""
    return attempt < F.when(is_retryable(message), ATTEMPTS_PASSING).otherwise(ATTEMPTS)


def backoff_seconds(attempt: Column, jitter: Column) -> Column:
    """Pause before the next try: it doubles each time; jitter lies between 0 and 1."""
    return F.lit(BACKOFF) * F.pow(F.lit(2.0), attempt - 1) + jitter


def answered(requests: DataFrame, recorded: DataFrame, default: str = "[]") -> DataFrame:
    """Requests (request, ...) with `answer`, the JSON text of the last recorded reply that parses, else the default, and `ok`.

    Recorded replies: request, ord, reply. Replies to no request are ignored."""
    parsed = recorded.withColumn("_json", F.try_parse_json("reply")).filter("_json is not null")
    last = parsed.groupBy("request").agg(F.max_by("reply", "ord").alias("_reply"))
    j = requests.join(last, "request", "left")
    return j.withColumn("ok", F.col("_reply").isNotNull()).withColumn("answer", F.coalesce("_reply", F.lit(default))).drop("_reply")


def prompt_rows(df: DataFrame, *columns: str) -> DataFrame:
    """page_id, rows: the columns a stage shows to a model, as one JSON array in region order."""
    row = F.struct("region_index", "region_id", F.to_json(F.struct(*columns)).alias("j"))
    return df.groupBy("page_id").agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["j"]), ","), F.lit("]")).alias("rows"))


def reconstruct(detections: DataFrame, reads: DataFrame) -> DataFrame:
    """Regions from detections (page_id, region_index, region_type, has_text, marginal_position, bbox) and reads (page_id, region_index, content, languages, is_visual, editorial_note).

    Without a read a region is empty and visual if it is a sketch or has no text; the facing page's margins are
    never read and carry a fixed note."""
    r = reads.select("page_id", "region_index", F.struct("content", "languages", "is_visual", "editorial_note").alias("_r")).groupBy("page_id", "region_index").agg(F.min("_r").alias("_r"))
    j = detections.join(r, ["page_id", "region_index"], "left")
    opposite = F.coalesce(F.col("marginal_position") == "opposite", F.lit(False))
    content = F.when(opposite, "").otherwise(F.coalesce("_r.content", F.lit("")))
    visual = F.when(opposite, False).otherwise(F.coalesce("_r.is_visual", (F.col("region_type") == "sketch") | ~F.coalesce("has_text", F.lit(True))))
    none = F.array().cast("array<string>")
    return j.select(
        "page_id", "region_index", "region_type", "bbox", "marginal_position", content.alias("content"), content.alias("region_reading"), visual.alias("is_visual"),
        F.when(opposite, none).otherwise(F.coalesce("_r.languages", none)).alias("languages"), F.when(opposite, OPPOSITE_NOTE).otherwise(F.col("_r.editorial_note")).alias("editorial_note"), uncertain_readings(content).alias("uncertain_readings"),
    )
