from . import jobs, reports, sinks

__all__ = ["jobs", "reports", "sinks"]
