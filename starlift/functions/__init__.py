from starlift.functions.calendar import calendar, calendar_between
from starlift.functions.expressions import date_id, full_name, moment, month_of

__all__ = ["calendar", "calendar_between", "date_id", "full_name", "moment", "month_of"]
