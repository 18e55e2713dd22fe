"""Lookups: party cross-reference, code translation, product translation.

No join here carries a hint: Spark picks the plan from sizes, and AQE turns a
join with a small side into a broadcast from the bytes seen at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ColumnLike, clean_string, col_, normalise

def xref_subset(xref: DataFrame, id_type: str) -> DataFrame:
    """Live (not logically deleted) ``(party_id, sor_party_id)`` pairs of one
    id type, de-duplicated."""
    return (xref.filter((F.col("party_id_type_cde") == id_type)
                        & (F.col("logical_delete_ind") == F.lit(False)))
                .select("party_id", "sor_party_id").distinct())


def resolve_party(df: DataFrame, xref: DataFrame, id_type: str, sor_key: Column,
                  clean_xref_side: bool = False, how: str = "inner") -> DataFrame:
    """Join ``df`` to the cross-reference of ``id_type`` on ``sor_party_id = sor_key``;
    adds ``party_id`` (with ``how="left"`` NULL where there is no party).  The key expression is
    computed once per side so the join stays an equi hash/sort-merge join."""
    x = xref_subset(xref, id_type)
    xk = clean_string("sor_party_id") if clean_xref_side else F.col("sor_party_id")
    x = x.select(F.col("party_id"), xk.alias("_sor_key"))
    left = df.withColumn("_sor_key", sor_key)
    return left.join(x, "_sor_key", how).drop("_sor_key")


MATCH_MODES = ("upper_trim", "clean", "exact")


def _match_expr(c: ColumnLike, mode: str) -> Column:
    if mode == "upper_trim":
        return normalise(c)
    if mode == "clean":
        return clean_string(c)
    return col_(c)


def translation_subset(translations: DataFrame, filters: Mapping[str, str],
                       exact: Sequence[str] = ()) -> DataFrame:
    """Translation rows whose filter columns equal the given values, compared
    as ``upper(trim(col))`` unless listed in ``exact``."""
    cond = F.lit(True)
    for col, value in filters.items():
        lhs = F.col(col) if col in exact else normalise(col)
        cond = cond & (lhs == F.lit(value))
    return translations.filter(cond).select("src_fld_val", "trnslt_fld_val")


def duplicate_translations(translations: DataFrame, filters: Mapping[str, str], match: str = "upper_trim",
                           exact: Sequence[str] = ()) -> DataFrame:
    """(key, n) of source values that have more than one translation; empty if
    ``translate_code`` with the same arguments multiplies no row."""
    t = translation_subset(translations, filters, exact)
    return (t.select(_match_expr("src_fld_val", match).alias("key")).where("key IS NOT NULL")
            .groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def translate_code(df: DataFrame, value: ColumnLike, translations: DataFrame,
                   filters: Mapping[str, str], out: str, match: str = "upper_trim",
                   exact: Sequence[str] = ()) -> DataFrame:
    """Left-join a code translation: ``out`` = translated value of ``value``
    (NULL when untranslated).  Duplicate translation rows multiply the row,
    exactly like the SQL join they replace."""
    if match not in MATCH_MODES:
        raise ValueError(f"match must be one of {MATCH_MODES}")
    t = translation_subset(translations, filters, exact)
    t = t.select(_match_expr("src_fld_val", match).alias("_tr_key"),
                 F.col("trnslt_fld_val").alias(out))
    left = df.withColumn("_tr_key", _match_expr(value, match))
    return left.join(t, "_tr_key", "left").drop("_tr_key")


def product_subset(products: DataFrame, out: str, trim_code: bool = True) -> DataFrame:
    """Distinct (_prod_key, ``out``) of the product translator: upper-cased (and
    trimmed) plan type code and product id."""
    code = F.upper(F.trim("knd_min_cde")) if trim_code else F.upper("knd_min_cde")
    return (products.filter(normalise("admn_sys_cde") == "TRAC")
                    .select(code.alias("_prod_key"), F.col("prod_id").alias(out)).distinct())


def product_lookup(df: DataFrame, plan_type: ColumnLike, products: DataFrame, out: str,
                   trim_code: bool = True) -> DataFrame:
    """Left-join the product translator on the upper-cased plan type code."""
    key = F.upper(F.trim(col_(plan_type))) if trim_code else F.upper(col_(plan_type))
    return (df.withColumn("_prod_key", key).join(product_subset(products, out, trim_code), "_prod_key", "left")
            .drop("_prod_key"))
