"""Named return periods and the dates they start on."""

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# The periods offered by name. Other counts of W, M and Y work too.
PERIODS = ("1W", "2W", "1M", "3M", "6M", "9M", "1Y", "2Y", "3Y", "5Y", "YTD", "MTD", "SI")


@dataclass(frozen=True)
class Period:
    label: str
    unit: str
    count: int = 0

    @property
    def since_inception(self) -> bool:
        return self.unit == "SI"

    @property
    def trailing(self) -> bool:
        """Counted back from the anchor, whose boundary day lies outside the window."""
        return self.unit in ("W", "M", "Y")

    def start(self, anchor: Column) -> Column:
        """Boundary date for an anchor date; null for SI, which each fund sets itself."""
        if self.unit == "W":
            return F.date_sub(anchor, 7 * self.count)
        if self.unit == "M":
            return F.add_months(anchor, -self.count)
        if self.unit == "Y":
            return F.add_months(anchor, -12 * self.count)
        if self.unit == "YTD":
            return F.trunc(anchor, "year")
        if self.unit == "MTD":
            return F.trunc(anchor, "month")
        return F.lit(None).cast("date")


def parse_period(text: str) -> Period:
    label = text.strip().upper()
    if label in ("YTD", "MTD", "SI"):
        return Period(label, label)
    counted = re.fullmatch(r"([0-9]+)([WMY])", label)
    if counted is None:
        # Fixed value: error text.
        raise ValueError(
            f"Unrecognised period '{text}'. Valid values: {', '.join(sorted(PERIODS))}"
        )
    return Period(label, counted[2], int(counted[1]))


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The date that counts as today; results repeat only when it is given."""
    if as_of is None:
        return F.current_date()
    return F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)
