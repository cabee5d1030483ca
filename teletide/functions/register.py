"""The scalar functions as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# name -> (parameters, result type, SQL expression)
SQL_FUNCTIONS = {
    "json_get_str": (
        "j STRING, k STRING", "STRING",
        "get_json_object(j, concat('$[''', k, ''']'))"),
    "canonical_json": ("j STRING", "STRING", "to_json(try_parse_json(j))"),
    "hex_lower": ("b BINARY", "STRING", "lower(hex(b))"),
    "time_bucket": ("t BIGINT, step BIGINT", "BIGINT", "t - pmod(t, step)"),
    "matches": (
        "txt STRING, query STRING", "BOOLEAN",
        r"size(array_except(filter(split(lower(query), '[^\\p{L}\\p{N}]+'), w -> w <> ''), "
        r"split(lower(txt), '[^\\p{L}\\p{N}]+'))) = 0"),
    "histogram_quantile": (
        "q DOUBLE, bounds ARRAY<DOUBLE>, counts ARRAY<BIGINT>", "DOUBLE",
        """(
          SELECT CASE WHEN total <= 0 OR size(bounds) = 0 THEN NULL
                      WHEN i >= size(bounds) THEN get(bounds, size(bounds) - 1)
                      ELSE low + (get(bounds, i) - low) * (q * total - (get(running, i) - get(counts, i)))
                           / get(counts, i) END
          FROM (SELECT *, CASE WHEN i > 0 THEN get(bounds, i - 1)
                               WHEN get(bounds, 0) > 0 THEN 0D ELSE get(bounds, 0) END AS low
                FROM (SELECT *, greatest(size(filter(running, r -> r < q * total)),
                                         size(filter(running, r -> r = 0))) AS i
                      FROM (SELECT aggregate(counts, 0L, (a, c) -> a + c) AS total,
                                   transform(counts, (c, p) ->
                                     aggregate(slice(counts, 1, p + 1), 0L, (a, n) -> a + n)) AS running)))
        )"""),
}


def register_functions(spark: SparkSession) -> None:
    """Create the temporary SQL functions; they are plain expressions to Catalyst."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
                  f"RETURNS {result} RETURN {body}")
