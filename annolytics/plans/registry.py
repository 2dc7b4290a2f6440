"""The core's queries and the SQL each is compared with."""

from annolytics.plans import annotation, exchange, operations, p5, reports

MODULES = (annotation, operations, p5, reports, exchange)


def queries():
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in MODULES for k, s in m.ORACLE.items()}
