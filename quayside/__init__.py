"""quayside: order ingestion and data quality on Spark.

Raw CSV landing (batch or file stream) into an append-only raw table, a daily gold
run (typing, duplicate marking, eight row checks, routing to gold or quarantine,
check log), reporting queries and a raw defect profile, all as DataFrame plans.
"""

from quayside.plans.gold_run import run_gold
from quayside.plans.ingest import ingest_csv
from quayside.plans.views import register_views, report
from quayside.session import Lakehouse, build_session
from quayside.streaming.ingest_stream import start_ingest_stream

__version__ = "0.1.0"

__all__ = [
    "Lakehouse",
    "build_session",
    "ingest_csv",
    "run_gold",
    "start_ingest_stream",
    "register_views",
    "report",
]
