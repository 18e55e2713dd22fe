from histloom.functions import register_sql_functions


def test_sql_functions_match_column_helpers(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT clean_string('  a ') AS c, clean_string('  ') AS b, "
                  "hash_gen('a|b') AS h, uuid_gen('a|b') AS u").collect()[0]
    assert (r.c, r.b) == ("a", None)
    assert r.h == r.u == "d0726241-0206-76b1-4aa6-298ce6a18b21"
