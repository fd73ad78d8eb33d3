"""tracewise — user-behaviour analytics on Spark.

Log scans, a bronze/silver/gold medallion over user-activity logs, a graph of
users, shares and folders, per-user features and anomaly scores, all written as
DataFrame jobs.
"""

from tracewise.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
