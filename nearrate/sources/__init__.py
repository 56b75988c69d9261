from nearrate.sources.ratings import (
    RATING_SCHEMA, parse_ratings, parse_personal, personal_ratings, load_ratings, load_personal, load_item_names, ratings_from_orders,
    split_train_test, dedupe, new_user_ratings,
)
from nearrate.sources.report import write_report, report_row

__all__ = [
    "RATING_SCHEMA", "parse_ratings", "parse_personal", "personal_ratings", "load_ratings", "load_personal", "load_item_names", "ratings_from_orders",
    "split_train_test", "dedupe", "new_user_ratings", "write_report", "report_row",
]
