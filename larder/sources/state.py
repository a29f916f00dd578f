"""How far each workflow has read: kept in the warehouse, written after the data."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.readers import FIRST_ID, FIRST_TS
from larder.sources.store import Store

ID = "latest_loaded_id"
TS = "latest_loaded_ts"
DEFAULTS = {ID: FIRST_ID, TS: FIRST_TS}


def settings_value(settings: DataFrame, workflow: str, kind: str) -> DataFrame:
    """The stored watermark of a workflow as text, or the default of its kind."""
    stored = settings.filter(F.col("workflow_key") == F.lit(workflow)).agg(
        F.max(F.get_json_object("workflow_settings", f"$.{kind}")).alias("value")
    )
    return stored.select(
        F.lit(workflow).alias("workflow_key"),
        F.coalesce("value", F.lit(str(DEFAULTS[kind]))).alias("value"),
    )


def batch_watermark(batch: DataFrame, kind: str, column: str) -> DataFrame:
    """The highest id or timestamp of a batch, NULL if it is empty."""
    return batch.agg(F.max(column).cast("string").alias(kind))


class LoadState:
    def __init__(self, store: Store, table: str = "stg.srv_wf_settings"):
        self.store = store
        self.table = table
        self._one_writer = Lock()

    def get(self, workflow: str, kind: str) -> int | str:
        row = settings_value(self.store.read(self.table), workflow, kind).first()
        return int(row["value"]) if kind == ID else row["value"]

    def save(self, workflow: str, kind: str, value: int | str | None) -> None:
        """Keep a watermark; an empty batch (``None``) leaves the old one."""
        if value is not None:
            self.save_all({workflow: value}, kind)

    def save_all(self, values: Mapping[str, int | str], kind: str) -> None:
        """Keep the watermarks of several workflows in one write."""
        rows = [(workflow, json.dumps({kind: value}, ensure_ascii=False)) for workflow, value in values.items()]
        frame = self.store.spark.createDataFrame(rows, "workflow_key string, workflow_settings string")
        with self._one_writer:
            self.store.upsert(self.table, frame, order=["workflow_settings"])

    def get_all(self, workflows: Sequence[str], kind: str) -> dict[str, int | str]:
        """The watermarks of several workflows, read at once."""
        value = F.get_json_object("workflow_settings", f"$.{kind}").alias("value")
        stored = self.store.read(self.table).filter(F.col("workflow_key").isin(*workflows))
        known = {row["workflow_key"]: row["value"] for row in stored.select("workflow_key", value).collect()}
        found = {name: DEFAULTS[kind] if known.get(name) is None else known[name] for name in workflows}
        return {name: int(value) if kind == ID else value for name, value in found.items()}

    def advance(self, workflow: str, kind: str, watermark: str | None) -> None:
        """Keep the watermark a load has reached (text, as in its result)."""
        if watermark is not None:
            self.save(workflow, kind, int(watermark) if kind == ID else watermark)
