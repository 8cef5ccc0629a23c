"""tidewatch — Spark-native analytics for intrusion-sensor event logs and labelled flow data.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``) function built
from the DataFrame / SQL / ML / Structured Streaming API, so the same code runs on a
laptop in ``local[*]`` and on a large cluster.
"""

__all__ = ["session", "schemas"]
