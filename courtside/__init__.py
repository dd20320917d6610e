"""courtside: layered (bronze / silver / gold) sports-statistics analytics on PySpark.

Every operator is a function from DataFrames to DataFrames with column names as
parameters; planning and execution are left to Catalyst, AQE and Tungsten.
"""

from courtside.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
