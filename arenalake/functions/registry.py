"""The five scalar functions under their SQL names, for `spark.sql` users."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SQL_FUNCTIONS = [
    ("pascal_to_title_case", "raw_value STRING", "STRING",
     "initcap(trim(regexp_replace(raw_value, '([a-z])([A-Z])', '$1 $2')))"),
    ("safecast_to_int", "raw_value STRING", "INT",
     "try_cast(round(try_cast(raw_value AS DOUBLE), 0) AS INT)"),
    ("valid_num_range", "num_val DOUBLE, num_min DOUBLE, num_max DOUBLE", "DOUBLE",
     "if(num_val BETWEEN num_min AND num_max, num_val, NULL)"),
    ("valid_ts_range", "ts_val TIMESTAMP, ts_min TIMESTAMP, ts_max TIMESTAMP", "TIMESTAMP",
     "if(ts_val BETWEEN ts_min AND ts_max, ts_val, NULL)"),
    ("nullify_caplen", "raw_value STRING, max_len INT", "STRING",
     "if(length(raw_value) <= max_len, raw_value, NULL)"),
]


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary functions and return their names."""
    for name, params, result, body in _SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {result} RETURN {body}")
    return [name for name, *_ in _SQL_FUNCTIONS]
