"""Everything that ties the jobs to one data set, in one place."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Landing column -> header in the source file.
LANDING_HEADERS = {
    "app": "App",
    "category": "Category",
    "rating": "Rating",
    "reviews": "Reviews",
    "size": "Size",
    "installs": "Installs",
    "type": "Type",
    "price": "Price",
    "content_rating": "Content Rating",
    "genres": "Genres",
    "last_updated": "Last Updated",
    "current_ver": "Current Ver",
    "android_ver": "Android Ver",
}

# The landing column that feeds each single-valued master table.
MASTER_SOURCES = {
    "category": "category",
    "app_type": "type",
    "content_rating": "content_rating",
    "app": "app",
}


@dataclass(frozen=True)
class Config:
    """Sentinels, tokens and tolerances; the defaults are those of the original catalogue."""

    # Cell contents that mark a malformed row, per master (exact spelling).
    app_sentinels: tuple[str, ...] = ("Life Made WI-Fi Touchscreen Photo Frame",)
    # Starts of names that the check after the load looks for; None means the sentinels.
    app_sentinel_prefixes: tuple[str, ...] | None = ("Life Made WI-Fi",)
    category_sentinels: tuple[str, ...] = ("1.9",)
    app_type_sentinels: tuple[str, ...] = ("0",)
    content_rating_sentinels: tuple[str, ...] = ("0",)

    # Multi-valued cells.
    list_separator: str = ";"
    date_like: str = r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{2}\z"

    # Texts that mean "missing"; assessment knows fewer of them than cleaning.
    size_varies: str = "varies with device"
    assess_null_tokens: tuple[str, ...] = ("nan", "null")
    clean_null_tokens: tuple[str, ...] = ("nan", "null", "n/a", "na")

    # Normalised names the masters should (not) hold after the load.
    bad_categories: tuple[str, ...] = ("1.9", "nan", "null", "0", "")
    bad_content_ratings: tuple[str, ...] = ("nan", "null", "0", "")
    bad_genres: tuple[str, ...] = ("nan", "null", "")
    free_type: str = "free"
    paid_type: str = "paid"

    # Tolerances and totals of the verification.
    preview_weight_tolerance: float = 0.0001
    weight_tolerance: float = 0.000001
    measure_tolerance: int = 100
    # None means what the source delivered, and the landing rows with a name to load.
    expected_raw_rows: int | None = None
    expected_snapshot_rows: int | None = None

    # Dimensions whose missing members map to one technical "Unknown" row: masters and the date.
    unknown_members: tuple[str, ...] = ("app_type",)

    # Day the timeliness metrics compare with; None means the day of the run.
    as_of_date: dt.date | None = None
    # Name of the source as it appears in the accuracy row of the scorecard.
    source_name: str = "Catalogue"

    def __post_init__(self):
        other = set(self.unknown_members) - {*MASTER_SOURCES, "last_updated_date"}
        if other:
            raise ValueError(f"no Unknown member for {sorted(other)}")

    def sentinels(self, master: str) -> tuple[str, ...]:
        return getattr(self, f"{master}_sentinels")
