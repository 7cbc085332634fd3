"""Bronze layer: raw tables kept up to date from the landing files."""

from __future__ import annotations

from datetime import timedelta

from starlift.operators.policies import (
    after_watermark,
    dated_or_unseen,
    insert_only,
    late_or_after,
    unseen_pairs,
    within_range,
)
from starlift.operators.staging import discard, new_folder, stage
from starlift.sources.landing import read_landing
from starlift.sources.schemas import KEYS
from starlift.sources.tables import Lake


def load_entity(lake: Lake, entity: str) -> None:
    """First load when the table is missing, else the entity's own rule.

    Order lines are compared with the stored ones of their own range of ids only.
    """
    config = lake.config
    source = read_landing(
        lake.spark, config.landing_dir, entity, null_marker=config.null_marker, multiline=config.multiline
    )
    if entity == "stocks":
        lake.overwrite(source, "bronze", entity)
    elif not lake.exists("bronze", entity):
        lake.append(source, "bronze", entity)
    elif entity in KEYS:
        lake.append_new(insert_only(source, lake.read("bronze", entity), KEYS[entity]), "bronze", entity)
    elif entity == "order_items":
        folder = new_folder(lake.spark, "extract")
        try:  # parsed once, and looked at for its ids before its rows are compared
            source = stage(source, entity, folder)
            stored = within_range(lake.read("bronze", entity), source, config.item_key[0])
            lake.append_new(unseen_pairs(source, stored, config.item_key), "bronze", entity)
        finally:
            discard(lake.spark, folder)
    elif entity == "orders":
        mark = lake.watermark("bronze", entity)
        if mark is not None and config.late_days:
            stored = lake.read("bronze", entity, above=mark - timedelta(days=config.late_days))
            rows = late_or_after(source, stored, "order_date", mark, config.late_days, ["order_id"])
        elif mark is None and config.empty_watermark == "all" and not lake.is_empty("bronze", entity):
            rows = dated_or_unseen(source, lake.read("bronze", entity), "order_date", ["order_id"])
        else:
            rows = after_watermark(source, "order_date", mark, config.empty_watermark)
        lake.append_new(rows, "bronze", entity)
    else:
        raise ValueError(f"no load rule for {entity}")
