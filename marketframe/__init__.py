"""Market-data analytics as Spark DataFrame operators."""

from marketframe.session import tune, work_dir

__all__ = ["tune", "work_dir"]
