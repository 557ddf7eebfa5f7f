"""Bronze and data-vault processing of market data, written as Spark DataFrame jobs."""

from pricevault.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
