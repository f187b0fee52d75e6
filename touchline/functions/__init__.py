from touchline.functions.columns import (  # noqa: F401
    avg_tenths, clamp, count_where, dist2, doc_id, iso_utc, latest, pct, time_order_key,
    position_group, safe_int, tenths, zone_of, zone_relative,
)
