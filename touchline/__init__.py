"""touchline — Spark-native football match analytics.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, so the same code runs in batch jobs and inside a
Structured Streaming query. The most used entry points are re-exported here:

    from touchline import parse_events, player_metrics, dashboards
    metrics = player_metrics(parse_events(raw_messages))
    dashboards.top_scorers(metrics).show()
"""

from touchline.operators.metrics import player_metrics, with_zone  # noqa: F401
from touchline.operators.roster import clean_roster, union_rosters  # noqa: F401
from touchline.plans import dashboards  # noqa: F401
from touchline.sources.events import encode_events, parse_events  # noqa: F401
from touchline.sources.roster import read_roster_csv  # noqa: F401
from touchline.streaming.sinks import latest_from_history, read_history, read_latest  # noqa: F401

__version__ = "0.1.0"
