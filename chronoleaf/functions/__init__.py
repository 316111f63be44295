from chronoleaf.functions.flags import flag01, ratio, threshold
from chronoleaf.functions.geo import distance_miles, geodesic_miles, haversine_miles
from chronoleaf.functions.strings import clean_user_name, current_user_name
from chronoleaf.functions.time import as_timestamp, day_of_week, day_stamp, epoch_seconds, to_date

__all__ = [
    "as_timestamp", "clean_user_name", "current_user_name", "day_of_week", "day_stamp",
    "distance_miles", "epoch_seconds", "flag01", "geodesic_miles", "haversine_miles",
    "ratio", "threshold", "to_date",
]
