"""Every registered query with its DuckDB twin: query(name, sql) registers a function of (spark, sf_dir)."""

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def FLAGSHIP(spark, sf_dir):
    return QUERIES["h6_search"](spark, sf_dir)


from figloom.plans import box_queries, caption_queries, page_queries, table_queries, evaluation_queries  # noqa: E402, F401
