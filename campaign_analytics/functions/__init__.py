from . import dates, identity, nulls, text, urls

__all__ = ["dates", "identity", "nulls", "text", "urls"]
