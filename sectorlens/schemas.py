"""Explicit schemas of the data model (no inference on wide text data)."""

from pyspark.sql import types as T

COMPANIES = T.StructType([
    T.StructField("company_id", T.LongType()),
    T.StructField("org_nr", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("postal_city", T.StringType()),
    T.StructField("municipality_code", T.StringType()),
    T.StructField("municipality", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("branch_codes", T.ArrayType(T.StringType())),
    T.StructField("url", T.StringType()),
])

SNI_CODES = T.StructType([
    T.StructField("sni_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("count", T.IntegerType()),
])

CODE_NAME = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("name", T.StringType()),
])

SCRAPED_PAGE_JSON = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("raw_html", T.StringType()),
])

FRONTIER = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("depth", T.IntegerType()),
])

# Extracted pages in long form: one row per page of a company run.
EXTRACTED_PAGES = T.StructType([
    T.StructField("company_id", T.LongType()),
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("method", T.ArrayType(T.BooleanType())),
    T.StructField("data", T.StringType()),
    T.StructField("branch_codes", T.ArrayType(T.StringType())),
])

CATEGORY_TABLES = T.ArrayType(T.StructType([
    T.StructField("Id_Kategori_JE", T.StringType()),
    T.StructField("VardeLista", T.ArrayType(T.StructType([
        T.StructField("Varde", T.StringType()),
        T.StructField("Text", T.StringType()),
    ]))),
]))
