"""Settings of one lake: where it lives and which load rules it follows."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

# Range of the calendar dimension.
CALENDAR_START = date(2010, 1, 1)
CALENDAR_END = date(2030, 12, 31)


@dataclass(frozen=True)
class LakeConfig:
    """Defaults are the re-runnable rules; ``parity()`` gives the strict ones.

    root            shared folder for the databases; None = the session's warehouse
    landing         folder of the landing CSV files; None = ``{root}/landing``
    prefix          put before each database name, to keep several lakes apart
    table_format    any format the session can write with ``saveAsTable``
    name_separator  between first and last name
    sk_mode         'offset': new keys follow the highest stored key (unique);
                    'rank': new keys are the rank among all current members
    null_aware      True: one NULL id in a dimension stops all new members (NOT IN)
    snapshot_mode   'replace_day': a re-run replaces the day; 'append': it adds to it
    rebuild_stocks  True: rebuild the stock fact on every run
    empty_watermark 'all': an empty target takes everything; 'none': it takes nothing
    late_days       also take unseen rows up to this many days behind the watermark
    new_sales_only  look for new members only in sales the facts do not hold yet
    item_key        columns that tell a stored order line from a new one
    null_marker     text that stands for NULL in the landing CSV; None = keep it as text
    multiline       True: a CSV file is read by one task from end to end; else files are split,
                    also where there are line breaks inside quotes
    skip_unchanged  an extract that has not changed is neither copied nor loaded again
    """

    root: str | None = None
    landing: str | None = None
    prefix: str = ""
    table_format: str = "parquet"
    calendar_start: date = CALENDAR_START
    calendar_end: date = CALENDAR_END
    name_separator: str = " "
    sk_mode: str = "offset"
    null_aware: bool = False
    snapshot_mode: str = "replace_day"
    rebuild_stocks: bool = False
    empty_watermark: str = "all"
    late_days: int = 0
    new_sales_only: bool = True
    item_key: tuple[str, ...] = ("order_id", "product_id")
    null_marker: str | None = None
    multiline: bool = False
    skip_unchanged: bool = True

    def __post_init__(self):
        allowed = {
            "sk_mode": ("offset", "rank"),
            "snapshot_mode": ("replace_day", "append"),
            "empty_watermark": ("all", "none"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")
        if self.root is None and self.landing is None:
            raise ValueError("set root or landing")
        # A rank is only meaningful among all members.
        if self.sk_mode == "rank" and self.new_sales_only:
            object.__setattr__(self, "new_sales_only", False)

    def parity(self) -> LakeConfig:
        """The strict rules: ranked keys, NOT IN, snapshots that pile up on re-runs."""
        return replace(
            self,
            sk_mode="rank",
            null_aware=True,
            snapshot_mode="append",
            rebuild_stocks=True,
            empty_watermark="none",
            late_days=0,
            new_sales_only=False,
            skip_unchanged=False,
        )

    @property
    def landing_dir(self) -> str:
        return (self.landing or f"{self.root}/landing").rstrip("/")

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"
