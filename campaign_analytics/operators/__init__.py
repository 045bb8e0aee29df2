from . import aggregates, filters, joins, numbering, payloads, sets, windows

__all__ = ["aggregates", "filters", "joins", "numbering", "payloads", "sets", "windows"]
