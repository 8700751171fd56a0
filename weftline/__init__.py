"""weftline: a PySpark-native analytics engine (DataFrame in, DataFrame out)."""

from weftline.session import get_session

__all__ = ["get_session"]
