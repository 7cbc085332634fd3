from starlift.operators.joins import not_in, rows_not_in
from starlift.operators.keys import dense_keys
from starlift.operators.policies import (
    after_watermark,
    dated_or_unseen,
    dated_snapshot,
    insert_only,
    late_or_after,
    merged,
    unseen_pairs,
    watermark,
    within_range,
)
from starlift.operators.staging import discard, new_folder, stage
from starlift.operators.together import together

__all__ = [
    "after_watermark",
    "dated_or_unseen",
    "dated_snapshot",
    "dense_keys",
    "discard",
    "insert_only",
    "late_or_after",
    "merged",
    "new_folder",
    "not_in",
    "rows_not_in",
    "stage",
    "together",
    "unseen_pairs",
    "watermark",
    "within_range",
]
