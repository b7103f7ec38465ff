"""emporium: a Spark-native retail lakehouse.

Bronze (raw, string-typed) -> Silver (typed, validated, deduplicated, audited)
-> Gold (star schema: order fact, item fact, date / product / geography /
customer-SCD2 dimensions) -> marts, data-quality reports and clickstream
metrics (batch and Structured Streaming).

Every transform is a plain function from DataFrame(s) to a DataFrame; nothing
is collected to the driver and no Python UDF is used.
"""

from emporium.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
