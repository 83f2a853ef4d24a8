"""Table plans and the registered queries."""


def all_catalogs():
    from arenalake.plans import queries_flow, queries_gold, queries_relational, queries_stats

    return [queries_flow.CATALOG, queries_relational.CATALOG, queries_gold.CATALOG, queries_stats.CATALOG]
