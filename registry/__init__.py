"""The library's jobs bound to the driver's tables, each next to the SQL it must agree with."""

from . import attribution, experiments, feeds, links, people, recommend, reports, streams

AREAS = [recommend, reports, attribution, links, experiments, people, feeds, streams]


def queries() -> dict:
    return {key: fn for area in AREAS for key, fn in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: sql for area in AREAS for key, sql in area.ORACLE.items()}
