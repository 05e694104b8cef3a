"""corpusprep: corpus-preparation jobs for line-delimited JSON articles on Spark.

Every public operator takes and returns a DataFrame, so one job is one
Catalyst plan.  Field names are parameters (see :class:`Fields`); fields the
operator does not touch travel unchanged in the raw JSON line.
"""

from corpusprep.fields import Fields
from corpusprep.session import get_session, scratch_path

__all__ = ["Fields", "get_session", "scratch_path"]
