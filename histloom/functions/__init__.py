"""Scalar building blocks (native Column expressions, no Python UDFs)."""

from .keys import (NULL_TOKEN, SEPARATOR, composite_id, hash_key, hash_uuid,
                   nullable_hash, prehash_value, row_checksum)
from .text import (as_text, blank, clean_string, col_, flatten_whitespace,
                   int_text, is_flag, join_text, normalise)
from .validity import (OPEN_END, UNKNOWN_BEGIN, bounds, date_lit, expired,
                       is_open, to_boolean, to_date, to_dtm, yes_no_to_boolean)

__all__ = [
    "NULL_TOKEN", "SEPARATOR", "OPEN_END", "UNKNOWN_BEGIN",
    "as_text", "blank", "bounds", "clean_string", "col_", "composite_id",
    "date_lit", "expired", "flatten_whitespace", "hash_key", "hash_uuid",
    "int_text", "is_flag", "is_open", "join_text", "normalise", "nullable_hash",
    "prehash_value", "register_sql_functions", "row_checksum", "to_boolean",
    "to_date", "to_dtm", "yes_no_to_boolean",
]


def register_sql_functions(spark) -> None:
    """Expose the one-argument helpers to ``spark.sql`` users as temporary SQL
    functions (inlined by the analyzer, so they stay in codegen).  The
    variadic ``prehash_value`` has no SQL form; write ``concat_ws`` there."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION clean_string(s STRING) "
              "RETURNS STRING RETURN nullif(trim(s), '')")
    for name in ("hash_gen", "uuid_gen"):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN "
            "concat(substr(md5(s),1,8),'-',substr(md5(s),9,4),'-',substr(md5(s),13,4),'-',"
            "substr(md5(s),17,4),'-',substr(md5(s),21,12))")
